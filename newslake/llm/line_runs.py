"""Line deduplication over levelled sorted runs of line hashes, in DataFrame expressions alone.

Documents come in batches of falling ids. A batch's line keys are counted and merged
against the runs so far: keys that a run has already settled, as found in enough
documents, are anti-joined away, the rest become a new run of level 0. When a level
holds ``FAN`` runs, they are compacted into one of the next level, so there are few runs
however many batches came, and a key is rewritten once per level. Runs are tables
bucketed and sorted by key: a batch is dealt to the buckets of the runs, and two runs
are merged or compacted without another shuffle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake import scratch

MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 4
FAN = 2
#: Lines from which a bucket is worth a file of its own; tables of fewer have a few buckets only.
BUCKET_LINES = 20_000
_FEW_BUCKETS = 16

_BLANKS = " \t\n\u000b\u000c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KEY = ["h1", "h2"]


class LineRuns:
    """Levelled sorted runs (h1, h2, n, top): documents that hold a key, and the largest id among them.

    Batches hold disjoint ids and come in falling order of id, rows without an id last.
    ``lines`` is about how many lines will come. It decides on the layout alone: as many buckets
    as shuffle partitions, so that a batch's exchange is also its deal to the buckets, or a few
    for a table that would fill them with next to nothing.
    """

    def __init__(self, spark: SparkSession, root: str, lines: int, min_docs: int = MIN_DOCS, fan: int = FAN):
        self.spark, self.root, self.min_docs, self.fan = spark, root, min_docs, fan
        self.levels: list[list[str]] = [[]]
        self._tables: list[str] = []
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.full = lines >= parts * BUCKET_LINES
        self.buckets = parts if self.full else max(1, -(-_FEW_BUCKETS * lines // (parts * BUCKET_LINES)))

    def packed(self, rows: DataFrame) -> DataFrame:
        """``rows`` in as many tasks as there are buckets."""
        return rows if self.full else rows.coalesce(self.buckets)

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        writer = self.packed(rows).write.bucketBy(self.buckets, *_KEY).sortBy(*_KEY).option("path", f"{self.root}/{name}")
        writer.saveAsTable(name)
        self._tables.append(name)
        return name

    def _merged(self, names: list[str]) -> DataFrame:
        """Runs as one. Two bucketed runs meet by merge join, without a shuffle."""
        rows = self.spark.table(names[0])
        for name in names[1:]:
            other = self.spark.table(name).withColumnsRenamed({"n": "n2", "top": "top2"})
            both = rows.join(other.hint("merge"), _KEY, "full")
            n = F.coalesce("n", F.lit(0)) + F.coalesce("n2", F.lit(0))
            rows = both.select(*_KEY, n.alias("n"), F.greatest("top", "top2").alias("top"))
        return rows

    def add(self, lines: DataFrame) -> None:
        """Add a batch of rows (doc_id, h1, h2, ...)."""
        held = lines.select("doc_id", *_KEY).distinct()
        own = held.groupBy(*_KEY).agg(F.count("*").alias("n"), F.max("doc_id").alias("top"))
        for name in [n for level in self.levels for n in level]:
            settled = self.spark.table(name).filter(F.col("n") >= self.min_docs).select(*_KEY)
            own = own.join(settled.hint("merge"), _KEY, "left_anti")
        self.levels[0].append(self._write(own))
        depth = 0
        while len(self.levels[depth]) >= self.fan:
            if depth + 1 == len(self.levels):
                self.levels.append([])
            self.levels[depth + 1].append(self._write(self._merged(self.levels[depth])))
            self.levels[depth] = []
            depth += 1

    def settled(self) -> DataFrame:
        """(h1, h2, n, top) of the keys found in enough documents; ``n`` counts until a run settled the key."""
        return self._merged([n for level in self.levels for n in level]).filter(F.col("n") >= self.min_docs)

    def drop(self) -> None:
        """Forget and delete all runs."""
        for name in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        scratch.drop_dir(self.spark, self.root)


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(_BLANKS))
    # The built-in lower case is much faster and the same where no other letters occur.
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def keyed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, t, pos, h1, h2) of the lines of (doc_id, text) whose key is long enough.

    ``t`` hashes the text, which tells rows of one id apart; a key is known by 128 bits.
    """
    lines = docs.select("doc_id", F.xxhash64("text").alias("t"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    key = line_key(F.col("line"))
    lines = lines.filter(F.length(F.btrim("line", F.lit(_BLANKS))) >= min_chars)
    return lines.select("doc_id", "t", "pos", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2"))


def _batches(lines: DataFrame, docs: DataFrame, batches: int) -> list[DataFrame]:
    """The lines by ranges of falling ids with about equal numbers of rows; rows without an id come last."""
    shares = [1 - k / batches for k in range(1, batches)]
    cuts = docs.agg(F.percentile_approx("doc_id", shares, 1000)).first()[0] if shares else None
    cuts = sorted(set(cuts or []), reverse=True)
    id_ = F.col("doc_id")
    ranges = [id_ > cut for cut in cuts[:1]] + [(id_ <= a) & (id_ > b) for a, b in zip(cuts, cuts[1:])]
    ranges.append((id_ <= cuts[-1]) | id_.isNull() if cuts else F.lit(True))
    return [lines.filter(r) for r in ranges]


def _dropped_places(lines: DataFrame, settled: DataFrame, every: int) -> DataFrame:
    """(doc_id, t, pos) of lines whose key is settled and held by a larger id.

    A key with at least one in P of all lines, P the number of shuffle partitions, would fill more than
    its share of a join. There are at most P such keys; they are sent to the lines, whichever
    way the others go.
    """
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = F.col("n") * parts >= every
    other = ~F.col("doc_id").eqNullSafe(F.col("top"))
    hot = settled.filter(counted).select(F.col("h1").alias("hot1"), F.col("h2").alias("hot2"), F.col("top").alias("hot_top"))
    is_hot = (F.col("h1") == F.col("hot1")) & (F.col("h2") == F.col("hot2"))
    marked = lines.join(F.broadcast(hot), is_hot, "left")
    from_hot = marked.filter(F.col("hot1").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("hot_top")))
    rest = marked.filter(F.col("hot1").isNull()).join(settled.filter(~counted).select(*_KEY, "top"), _KEY)
    return from_hot.select("doc_id", "t", "pos").unionByName(rest.filter(other).select("doc_id", "t", "pos"))


def dedup_lines(
    docs: DataFrame, work: str, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped) of every row: its lines but those that a larger id also holds.

    A line's key of at least ``min_chars`` code points that is found in ``min_docs`` documents stays in
    the largest id holding it alone, there in all its lines. Null and empty texts are one
    empty line. Rows of one id are one document; rows without an id together are one that
    comes before all others. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    lines = scratch.stored(keyed_lines(rows, min_chars), f"{work}/lines")
    every = lines.count()
    runs = LineRuns(spark, f"{work}/runs", every, min_docs)
    try:
        for batch in _batches(lines, rows, batches):
            runs.add(batch)
        settled = scratch.stored(runs.packed(runs.settled()), f"{work}/settled")
    finally:
        runs.drop()
    places = _dropped_places(lines, settled, every).groupBy(F.col("doc_id").alias("_doc"), F.col("t").alias("_t"))
    places = places.agg(F.array_sort(F.collect_set("pos")).alias("places"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.xxhash64("text") == F.col("_t"))
    found = rows.join(places, same, "left").select("doc_id", F.split("text", "\n").alias("lines"), F.coalesce("places", F.expr("array()").cast("array<int>")).alias("places"))
    # Lines between one dropped place and the next, as slices: linear in lines and places.
    ends = F.concat("places", F.array(F.size("lines")))
    found = found.select("doc_id", "lines", "places", ends.alias("ends"))
    between = lambda end, k: F.slice(
        F.col("lines"), F.coalesce(F.get("ends", k - 1) + 2, F.lit(1)), end - F.coalesce(F.get("ends", k - 1) + 1, F.lit(0))
    )
    kept = F.when(F.size("places") > 0, F.flatten(F.transform("ends", between))).otherwise(F.col("lines"))
    return found.select(
        "doc_id", F.array_join(kept, "\n").alias("text"), F.size("lines").cast("long").alias("n_lines"), F.size("places").cast("long").alias("n_dropped")
    )
