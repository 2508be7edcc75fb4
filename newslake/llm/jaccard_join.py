"""Jaccard self-join of word shingles with adaptive multi-match prefixes.

Two documents link when their shingle sets have a Jaccard similarity of at least
3/4. Sets are ordered by one global order, rarest shingle first. A pair with overlap
``o`` shares ``l`` of the first ``size - o + l`` shingles of both sets, for any ``l``.
Each document picks its own ``l`` (1 to ``MAX_MATCHES``) by the estimated cost of its
candidates: a longer prefix looks up more lists but asks for more shared shingles before
a pair is verified. Shorter sets of a pair are indexed for every ``l``, so each longer
set can use its own.

Work never meets all pairs of a group of copies:

1. equal sets become one node (a 64-bit hash of the set);
2. in rounds, every component found so far is verified against two hubs that share much of
   a member's prefix; groups of near copies grow together by a few comparisons per member.
   Rounds go on while they find links and many pairs are left to meet;
3. only pairs from different components found so far go through the multi-match
   count and the exact check, and their links complete the components. An entry counts
   for a pair only where its place in both sets leaves room for a link, so members that
   differ too much are not paired though they share the passage of their group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newslake import scratch
from newslake.llm.components import components
from newslake.llm.words import mix, pieces, shingles

MAX_MATCHES = 4
ORDER_SLOTS = 1 << 22
FREQUENT = 4
#: Meetings of sets per prefix shingle at which the exact pairing starts.
MEETINGS = 2
_VERIFY_COST = 1 / 16
# Ids are spread over the slots of a filter by their low bits; what stands above them, such as the
# file in a row key, moves them by a stride.
_LOW_BITS, _STRIDE = 40, 2_654_435
_LOW = (1 << _LOW_BITS) - 1

U = np.uint64


def _set_id(values: np.ndarray) -> np.int64:
    return mix(np.array([values.sum(dtype=np.uint64) ^ U(len(values))]))[0].view(np.int64)


_SETS = pa.schema([("doc_id", pa.int64()), ("sid", pa.int64()), ("size", pa.int64()), ("part", pa.int32()), ("codes", pa.binary())])


def _packed(codes: np.ndarray) -> bytes:
    """Sorted 32-bit codes as steps, byte by byte: about a byte and a half for each."""
    steps = np.diff(codes, prepend=np.uint32(0)).astype("<u4")
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes())


def _unpacked(body: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4")[:, 0], dtype=np.uint32)


def _sets(part_bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document rows (id, set, size) and packed 32-bit codes of all shingles by range.

    Equal sets of a split count once; what else repeats is repeated in the codes.
    """
    seen: set[int] = set()
    pending: list[np.ndarray] = []
    held = 0

    def counts() -> pa.RecordBatch:
        codes = np.sort(np.concatenate(pending)) if pending else np.zeros(0, np.uint32)
        pending.clear()
        edges = np.searchsorted(codes, np.arange((1 << part_bits) + 1, dtype=np.uint64) << U(32 - part_bits))
        parts = np.flatnonzero(np.diff(edges))
        none = pa.nulls(len(parts), pa.int64())
        bodies = [_packed(codes[edges[i] : edges[i + 1]]) for i in parts]
        return pa.RecordBatch.from_arrays([none, none, none, pa.array(parts.astype(np.int32)), pa.array(bodies, pa.binary())], schema=_SETS)

    for batch in batches:
        sids, sizes = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        for piece in pieces(batch.column(1)):
            for row, values in shingles(piece):
                if not len(values):
                    continue
                values = np.unique(values)
                sids[row], sizes[row] = _set_id(values), len(values)
                if (sid := int(sids[row])) not in seen:
                    seen.add(sid)
                    pending.append((values >> U(32)).astype(np.uint32))
                    held += len(values)
            if held > 8_000_000:
                yield counts()
                held = 0
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sids), pa.array(sizes), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], schema=_SETS
        )
    yield counts()


def _frequent(table: pa.Table) -> pa.Table:
    """(code, n) of the codes of one range that occur FREQUENT times or more."""
    codes, n = np.unique(np.concatenate([_unpacked(b) for b in table["codes"].to_pylist()]), return_counts=True)
    often = n >= FREQUENT
    return pa.table({"code": pa.array(codes[often].astype(np.int64)), "n": pa.array(n[often])})


def order_levels(packed: DataFrame, path: str) -> np.ndarray:
    """Logarithm of each slot's largest shingle count over all documents; 0 for the rest.

    The table has a fixed size (a byte for each of ORDER_SLOTS), so it may go to every task.
    It starts at the lowest power of two that leaves it seven eighths empty. Any content keeps
    the join exact: it only ranks shingles.
    """
    counted = packed.groupBy("part").applyInArrow(_frequent, "code long, n long")
    counted = counted.select(F.pmod("code", F.lit(ORDER_SLOTS)).cast("int").alias("slot"), F.floor(F.log2("n")).cast("int").alias("level"))
    slots = scratch.stored(counted.groupBy("slot").agg(F.max("level").alias("level")), path)
    least, room = 1, ORDER_SLOTS // 8
    for level, n in sorted(slots.groupBy("level").count().collect(), reverse=True):
        if n > room:
            least = level + 1
            break
        room -= n
    table = slots.filter(F.col("level") >= least).toArrow()
    levels = np.zeros(ORDER_SLOTS, np.uint8)
    levels[table["slot"].to_numpy()] = table["level"].to_numpy()
    return levels


def least_overlap(size: int) -> int:
    """Shared shingles that a set of this size needs with any partner."""
    return -(-3 * size // 4)


def least_overlap_as_shorter(size: int) -> int:
    """The same when no partner is shorter."""
    return -(-6 * size // 7)


def choose_matches(levels: np.ndarray, size: int) -> int:
    """The number of shared prefix shingles with the least estimated cost.

    ``levels`` are those of the set in prefix order. Looking up the lists of the first
    k shingles costs the sum S of their estimated other entries. At most S / l
    candidates can match l times; each costs a share of the set's size to verify.
    """
    need = least_overlap(size)
    lists = np.cumsum(np.exp2(levels.astype(np.float64)) - 1)
    best, cost = 1, np.inf
    for matches in range(1, min(MAX_MATCHES, need) + 1):
        reach = lists[min(size, size - need + matches) - 1]
        if (total := reach * (1 + _VERIFY_COST * size / matches)) < cost:
            best, cost = matches, total
    return best


def _postings(levels_of, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shingle, set, size, position, matches) of each set's prefix, once per split."""
    schema = pa.schema([("token", pa.int64()), ("sid", pa.int64()), ("size", pa.int32()), ("pos", pa.int32()), ("matches", pa.int8())])
    levels = levels_of.value
    seen: set[int] = set()
    for batch in batches:
        for piece in pieces(batch.column(0)):
            token, sid, size, pos, matches = [], [], [], [], []
            for _, values in shingles(piece):
                if not len(values):
                    continue
                values = np.unique(values)
                own, n = int(_set_id(values)), len(values)
                if own in seen:
                    continue
                seen.add(own)
                level = levels[(values >> U(32) & U(ORDER_SLOTS - 1)).astype(np.int64)]
                order = np.argsort(level, kind="stable")
                m = choose_matches(level[order], n)
                length = min(n, max(n - least_overlap(n) + m, n - least_overlap_as_shorter(n) + MAX_MATCHES))
                token.append(values[order[:length]].view(np.int64))
                sid.append(np.full(length, own))
                size.append(np.full(length, n, np.int32))
                pos.append(np.arange(length, dtype=np.int32))
                matches.append(np.full(length, m, np.int8))
            if token:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (token, sid, size, pos, matches)], schema=schema)


def parity_bits(values: np.ndarray) -> np.ndarray:
    """Parity of how many shingles fall on each of about four to eight bits per shingle.

    Two sets differ in at least as many shingles as their bits do. The bits of a table of
    half the size are the two halves' exclusive or.
    """
    size = max(64, 1 << int(4 * len(values) - 1).bit_length())
    odd = np.bincount((values & U(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows)))


def _arrays(wanted_of, whole: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(set, size, parity bits, shingles if ``whole``) of the documents whose bit is on and of those without an id."""
    bits = wanted_of.value
    for batch in batches:
        ids = batch.column(0)
        value = ids.fill_null(0).to_numpy()
        on = bits[((value & _LOW) + (value >> _LOW_BITS) * _STRIDE) & (len(bits) - 1)]
        batch = batch.filter(pa.array(on | ids.is_null().to_numpy(zero_copy_only=False)))
        for piece in pieces(batch.column(1)):
            rows = [np.unique(values) for _, values in shingles(piece) if len(values)]
            if rows:
                columns = [pa.array([_set_id(r) for r in rows], pa.int64()), pa.array([len(r) for r in rows], pa.int32()), _lists([parity_bits(r) for r in rows])]
                columns += [_lists([r.view(np.int64) for r in rows])] if whole else []
                yield pa.RecordBatch.from_arrays(columns, names=["sid", "size", "parity", "shingles"][: len(columns)])


def _slots(ids: DataFrame, slots: int = 1 << 22) -> np.ndarray:
    """A bit per slot, on for the ids given: a filter of fixed size ahead of an exact join."""
    place = F.expr(f"(id & {_LOW}L) + shiftright(id, {_LOW_BITS}) * {_STRIDE}L")
    slotted = ids.select(place.bitwiseAND(F.lit(slots - 1)).cast("int").alias("slot"))
    words = slotted.groupBy(F.col("slot").bitwiseAND(slots - 64).alias("first")).agg(
        F.bit_or(F.expr("shiftleft(1L, slot % 64)")).alias("bits")
    ).toArrow()
    table = np.zeros(slots // 64, np.uint64)
    table[words["first"].to_numpy() // 64] = words["bits"].to_numpy().view(np.uint64)
    return np.unpackbits(table.view(np.uint8), bitorder="little").view(bool)


def _read_sets(sids: DataFrame, texts: DataFrame, rows: DataFrame, path: str, whole: bool = True) -> DataFrame:
    """(set, size, parity bits, shingles if ``whole``) of the sets asked for, read again from one document of each.

    All other texts are passed over by a filter of fixed size; the join is exact.
    """
    wanted = rows.groupBy("sid").agg(F.min("doc_id").alias("id")).join(sids, "sid").filter("id IS NOT NULL")
    bits = sids.sparkSession.sparkContext.broadcast(_slots(wanted.select("id")))
    schema = "sid long, size int, parity array<long>" + ", shingles array<long>" * whole
    found = texts.mapInArrow(lambda b: _arrays(bits, whole, b), schema).join(sids, "sid", "left_semi")
    return scratch.stored(found.dropDuplicates(["sid"]), path)


def _folded(bits: str, other: str) -> str:
    """SQL for ``bits`` at the size of ``other``, if that is half of its own."""
    half = f"cast(size({bits}) / 2 as int)"
    return (
        f"CASE WHEN size({bits}) > size({other}) THEN "
        f"zip_with(slice({bits}, 1, {half}), slice({bits}, {half} + 1, {half}), (x, y) -> x ^ y) ELSE {bits} END"
    )


def _possible(pairs: DataFrame, brief: DataFrame) -> DataFrame:
    """The pairs (a, b) that parity bits do not rule out.

    A pair links if its sets differ in at most a seventh of their summed sizes. Parity bits
    show at least part of the difference and cost a sixteenth of the shingles.
    """
    left, right = (brief.select(F.col("sid").alias(x), F.col("parity").alias(f"{x}_bits"), F.col("size").alias(f"{x}_size")) for x in "ab")
    differ = F.expr(f"aggregate(zip_with({_folded('a_bits', 'b_bits')}, {_folded('b_bits', 'a_bits')}, (x, y) -> bit_count(x ^ y)), 0, (n, x) -> n + x)")
    return pairs.join(left, "a").join(right, "b").filter(7 * differ <= F.col("a_size") + F.col("b_size")).select("a", "b")


def _verified(pairs: DataFrame, arrays: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity, compared shingle by shingle."""
    left, right = (arrays.select(F.col("sid").alias(x), F.col("shingles").alias(f"{x}_set")) for x in "ab")
    both = F.size(F.array_intersect("a_set", "b_set")).cast("long")
    total = F.size("a_set") + F.size("b_set")
    return pairs.join(left, "a").join(right, "b").filter(100 * both >= 75 * (total - both)).select("a", "b")


def _central(met: DataFrame) -> DataFrame:
    """(sid, size, component, weight): weight is the mean logarithm of how often a prefix shingle of the set is held."""
    return met.groupBy("sid").agg(
        F.max("size").cast("long").alias("size"), (F.sum(F.log2("held")) / F.max("size")).alias("weight")
    ).select("sid", "size", F.col("sid").alias("component"), "weight")


def _hub_pairs(met: DataFrame, parts: DataFrame, turn: int) -> DataFrame:
    """(a, b): for each component its best pairs with hubs elsewhere.

    A shingle has two hubs: the set of most weight, which is near the middle of its group,
    and one by the hash of the turn; weights waver by turn, so that other middles come up. A pair
    counts if it shares a quarter of a prefix at least and the sizes allow a link.
    """
    draw = lambda salt: F.pmod(F.xxhash64("sid", F.lit(2 * turn + salt)), F.lit(1 << 20)) / (1 << 20)
    own = parts.withColumns({"h": F.col("weight") * (1 - (0.3 if turn else 0.0) * draw(0)), "r": draw(1)})
    now = met.select("token", "sid").join(own.select("sid", "size", "component", "h", "r"), "sid")
    ends = now.groupBy("token").agg(
        F.max_by("sid", "h").alias("middle"), F.max_by("sid", "r").alias("other"), F.min("component").alias("c0"), F.max("component").alias("c1")
    ).filter("c0 < c1").select("token", "middle", "other")
    shared = now.join(ends, "token").select("sid", "size", "component", F.posexplode(F.array("middle", "other")).alias("side", "b"))
    shared = shared.groupBy("sid", "size", "component", "side", "b").agg(F.count("*").alias("n"))
    hubs = own.select(F.col("sid").alias("b"), F.col("size").alias("b_size"), F.col("component").alias("b_component"))
    fit = shared.filter("16 * n >= size").join(hubs, "b").filter("component <> b_component AND 4 * least(size, b_size) >= 3 * greatest(size, b_size)")
    best = fit.groupBy("component", "side").agg(F.max(F.struct(F.col("n") / F.col("size"), "sid", "b")).alias("x"))
    return best.select(F.col("x.sid").alias("a"), F.col("x.b").alias("b")).distinct()


def _meetings(met: DataFrame, parts: DataFrame) -> int:
    """Pairs of sets in ``parts`` from different components that meet on a shingle, counted by shingle."""
    each = met.join(parts.select("sid", "component"), "sid").groupBy("token", "component").agg(F.count("*").alias("n")).groupBy("token").agg(
        ((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("pairs"))
    return int(each.agg(F.sum("pairs")).first()[0] or 0)


def _moves(parts: DataFrame, links: DataFrame, work: str) -> DataFrame:
    """(component, to) of the components that further links join; a set not in ``parts`` is its own component."""
    for x in "ab":
        own = parts.select(F.col("sid").alias(x), F.col("component").alias(f"c{x}"))
        links = links.join(own, x, "left").withColumn(f"c{x}", F.coalesce(f"c{x}", x))
    moves = components(links.select(F.col("ca").alias("a"), F.col("cb").alias("b")), work)
    return moves.select(F.col("node").alias("component"), F.col("component").alias("to"))


def _merged(parts: DataFrame, links: DataFrame, work: str) -> DataFrame:
    """Components after further links between them."""
    moves = _moves(parts, links, work)
    return parts.join(moves, "component", "left").withColumn("component", F.coalesce("to", "component")).select(*parts.columns)


def _apart(met: DataFrame, parts: DataFrame) -> DataFrame:
    """Prefix entries whose shingle is in two components, with their component, ``before``, ``lead`` and ``last``.

    ``before`` counts such entries ahead in the set's prefix, up to MAX_MATCHES - 1: no more shingles
    ahead are shared with a set of another component. Take a link of sets r and s that share a shingle,
    their k-th in order, at places i and j. Ahead of it i - (k - 1) shingles of r and j - (k - 1)
    of s are not shared, behind it as many as the rests differ in size. All are at most a seventh of
    the sizes, which gives 14 (i - k + 1) - 8 |r| + 6 |s| <= 0, and the same with r and s swapped.
    ``lead`` is the first two terms with ``before`` for k - 1, so none is larger for a link.
    ``last`` holds the shingles of up to MAX_MATCHES such entries right ahead.
    """
    apart = met.join(parts.select("sid", "component"), "sid", "left").withColumn("component", F.coalesce("component", "sid")).repartition("token")
    mixed = apart.groupBy("token").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), *[F.max(c).alias(f"top_{c}") for c in ("sid", "size", "pos", "matches")]
    ).filter("low < high AND (top_sid IS NOT NULL AND top_size + top_pos + top_matches > 0)")
    ahead = Window.partitionBy("sid").orderBy("pos")
    apart = apart.join(mixed.select("token"), "token").withColumns({
        "before": F.least(F.row_number().over(ahead) - 1, F.lit(MAX_MATCHES - 1)),
        "last": F.collect_list("token").over(ahead.rowsBetween(-MAX_MATCHES, -1)),
    })
    return apart.withColumn("lead", F.expr("14 * (pos - before) - 8 * size"))


def _shared_entries(apart: DataFrame) -> DataFrame:
    """(r_sid, s_sid, r_matches): pairs of sets from different components, once for each prefix shingle that counts for them.

    Components that meet on a shingle are joined first, by the least lead and size of their sets, then
    the sets of each; so no set is paired within its component, and a set joins a component only where
    its place leaves room for a link. Components, and a set and a component, go on only where they meet
    on as many shingles as a pair of them needs. A pair that shares as many shingles as it needs right ahead of an
    entry does not meet there again: it is counted by its first ones.
    """
    probe = apart.filter("pos < size - ceil(3 * size / 4) + matches").select(
        "token", "component", *[F.col(c).alias(f"r_{c}") for c in ("sid", "size", "matches", "pos", "before", "lead", "last")])
    index = apart.filter(f"pos < size - ceil(6 * size / 7) + {MAX_MATCHES}").select(
        "token", F.col("component").alias("other"), *[F.col(c).alias(f"s_{c}") for c in ("sid", "size", "pos", "before", "lead", "last")],
        F.expr("pos - size + ceil(6 * size / 7)").alias("beyond"))
    one = probe.groupBy("token", "component").agg(F.min("r_lead").alias("c_lead"), F.min("r_size").alias("c_size"), F.min("r_matches").alias("c_matches"))
    two = index.groupBy("token", "other").agg(F.min("s_lead").alias("o_lead"), F.min("s_size").alias("o_size"))
    room = lambda r, s: F.expr(f"{r}_lead + 6 * {s}_size <= 0 AND {s}_lead + 6 * {r}_size <= 0")
    meet = one.join(two, "token").filter("component <> other").filter(room("c", "o"))
    both = Window.partitionBy("component", "other")
    meet = meet.withColumns({"n": F.count("*").over(both), "least": F.min("c_matches").over(both)}).filter("n >= least")
    met = meet.select("token", "component", "other", "o_lead", "o_size").join(probe, ["token", "component"]).filter(room("r", "o"))
    met = met.withColumn("n", F.count("*").over(Window.partitionBy("r_sid", "other"))).filter("n >= r_matches").drop("n", "o_lead", "o_size")
    shared = "least(r_before, s_before, r_matches - 1)"
    return (
        met.drop("component").join(index, ["token", "other"])
        .filter("(s_size < r_size OR (s_size = r_size AND s_sid < r_sid)) AND 4 * s_size >= 3 * r_size AND beyond < r_matches")
        .filter(f"14 * (r_pos - {shared}) - 8 * r_size + 6 * s_size <= 0 AND 14 * (s_pos - {shared}) - 8 * s_size + 6 * r_size <= 0")
        .filter("size(array_intersect(r_last, s_last)) < r_matches").select("r_sid", "s_sid", "r_matches")
    )


def _candidates(apart: DataFrame) -> DataFrame:
    """(a, b): pairs of sets from different components that share as many prefix shingles as the longer one asks for."""
    matched = _shared_entries(apart).groupBy(F.col("r_sid").alias("a"), F.col("s_sid").alias("b"), "r_matches").agg(F.count("*").alias("matched"))
    return matched.filter("matched >= r_matches").select("a", "b")


def shingle_components(docs: DataFrame, work: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row.

    A-Z is lower-cased; a set holds the distinct 5-word shingles, or the whole sequence
    when the text is shorter. The component is named by its smallest id. Null and empty
    texts have no shingles, link with nothing and form components of their own. Repeated
    rows keep one row each. A row without an id takes part in links but cannot name a
    component; alone, its component is null. Needs ``work``, a folder shared by all executors.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    part_bits = max(6, int(spark.conf.get("spark.sql.shuffle.partitions")).bit_length())
    schema = "doc_id long, sid long, size long, part int, codes binary"
    found = scratch.stored(texts.mapInArrow(lambda b: _sets(part_bits, b), schema), f"{work}/sets")
    levels = spark.sparkContext.broadcast(order_levels(found.filter("part IS NOT NULL").select("part", "codes"), f"{work}/slots"))
    rows = scratch.stored(found.filter("part IS NULL").select("doc_id", "sid", "size"), f"{work}/rows")
    for old in ("sets", "slots"):
        scratch.drop_dir(spark, f"{work}/{old}")
    scratch.release(spark)

    # Prefixes meet by shingle in one exchange; only those of two sets or more are stored.
    # The aggregate names every column, so that both branches use the same exchange.
    postings = texts.select("text").mapInArrow(
        lambda b: _postings(levels, b), "token long, sid long, size int, pos int, matches byte"
    ).repartition("token")
    shared = postings.groupBy("token").agg(
        F.min("sid").alias("low"), F.max("sid").alias("top"), F.count("*").alias("held"), *[F.max(c).alias(f"top_{c}") for c in ("size", "pos", "matches")]
    ).filter("low < top AND top_size + top_pos + top_matches > 0")
    met = scratch.stored(
        postings.join(shared.select("token", F.col("held").cast("int").alias("held")), "token").dropDuplicates(["token", "sid"]), f"{work}/met"
    )

    del postings, shared
    scratch.release(spark)

    # Sets that share much with a hub grow together in rounds.
    sizes = scratch.stored(_central(met), f"{work}/central")
    suspects = _hub_pairs(met, sizes, 0).select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    parts = scratch.stored(sizes.join(suspects, "sid"), f"{work}/parts")
    arrays = _read_sets(parts.select("sid"), texts, rows, f"{work}/arrays")
    near = scratch.stored(met.select("token", "sid").join(parts.select("sid"), "sid"), f"{work}/near")
    turn, met_rows = 0, met.count()
    while True:
        pairs = scratch.stored(_hub_pairs(near, parts, turn), f"{work}/pairs-{turn}")
        found = scratch.stored(_verified(_possible(pairs, arrays), arrays), f"{work}/links-{turn}")
        tried, good = pairs.count(), found.count()
        if good:
            parts = scratch.stored(_merged(parts, found, f"{work}/merge-{turn}"), f"{work}/parts-{turn}")
            for old in (f"merge-{turn}", "parts" if turn == 0 else f"parts-{turn - 1}"):
                scratch.drop_dir(spark, f"{work}/{old}")
        scratch.drop_dir(spark, f"{work}/pairs-{turn}")
        scratch.release(spark)
        if 50 * good < tried or not good or _meetings(near, parts) <= MEETINGS * met_rows:
            break
        turn += 1

    # Prefixes of sets that are still apart. The last pairs are ruled out by parity bits as far as
    # possible, so shingles are read for few.
    scratch.drop_dir(spark, f"{work}/arrays")
    apart = scratch.stored(_apart(met.drop("held"), parts), f"{work}/apart")
    for old in ("met", "near", "central"):
        scratch.drop_dir(spark, f"{work}/{old}")
    scratch.release(spark)
    pairs = scratch.stored(_candidates(apart), f"{work}/pairs")
    scratch.drop_dir(spark, f"{work}/apart")
    scratch.release(spark)
    ends = lambda p: p.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    brief = _read_sets(ends(pairs), texts, rows, f"{work}/brief", whole=False)
    open_ = scratch.stored(_possible(pairs, brief), f"{work}/open")
    rest = _read_sets(ends(open_), texts, rows, f"{work}/more-arrays")
    links = scratch.stored(_verified(open_, rest), f"{work}/links")
    for old in ("pairs", "brief", "open", "more-arrays"):
        scratch.drop_dir(spark, f"{work}/{old}")
    scratch.release(spark)
    moves = _moves(parts, links, f"{work}/whole")

    # Names: the smallest id of each set, then of each component; sets alone keep their own.
    by_set = rows.filter("size > 0").groupBy("sid").agg(F.min("doc_id").alias("low"))
    by_set = by_set.join(parts.select("sid", "component"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    by_set = by_set.join(moves, "component", "left").withColumn("component", F.coalesce("to", "component"))
    named = by_set.groupBy("component").agg(F.min("low").alias("component_id"))
    by_set = scratch.stored(by_set.join(named, "component").select("sid", "component_id"), f"{work}/named")
    full = rows.filter("size > 0").join(by_set, "sid").select("doc_id", F.col("size").alias("n_shingles"), "component_id")
    bare = rows.filter("size = 0").select("doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.union(bare)
