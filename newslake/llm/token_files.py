"""Token files: every text encoded once, one wavelet matrix per shard, read back per document."""

from __future__ import annotations

import itertools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newslake import scratch
from newslake.llm.wavelet import WaveletMatrix, from_bytes, to_bytes
from newslake.llm.words import cut, text_buffers

SHARD_TOKENS = 2_000_000
SHARDS_PER_TASK = 4
MANIFEST_TASKS = 64
PIECE_BYTES = 6 << 20
_CACHE = 600_000
_SHARD = pa.schema([("part", pa.int32()), ("path", pa.string()), ("start", pa.int64()), ("tokens", pa.int64()), ("docs", pa.int64())])


def _open(uri: str):
    uri = re.sub(r"^file:/+", "/", uri)
    return fs.FileSystem.from_uri(os.path.abspath(uri) if "://" not in uri else uri)


class ChunkEncoder:
    """Encodes texts through their distinct chunks, as the whole text is encoded.

    Added tokens of the tokenizer's file, such as marks of a text's end, are chunks of
    their own wherever their literal stands and keep their id. Other chunks end where the byte-level pre-tokenizer always ends a piece: before a blank
    or line break that follows a visible character, and between a Latin letter and a visible
    ASCII character that is none. A chunk's ids therefore do not depend on what stands
    around it, and each distinct chunk goes through the tokenizer once. The memory of
    past chunks starts anew at ``_CACHE`` entries.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.lstrip or t.rstrip or t.single_word for t in added):
            raise ValueError("added tokens that take in blanks or whole words alone are not supported")
        literals = sorted((t.content.encode() for t in added), key=len, reverse=True)
        self.added = re.compile(b"|".join(map(re.escape, literals))) if literals else None
        # A chunk of letters alone, with a blank at most before them, is one piece: no pattern need run.
        self.bare, self.full = ByteLevel(add_prefix_space=False, use_regex=False), self.tokenizer.pre_tokenizer
        self.one_piece = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
        # In the byte-level alphabet a token has one character per byte.
        vocabulary = self.tokenizer.get_vocab()
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes_of[i] = len(token)
        self._forget()

    def _forget(self):
        self.place, self.lengths, self.begins, self.pool = {}, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _learn(self, chunks: list[str]) -> None:
        """Encode new chunks, a thousand to a call; byte lengths tell which ids are whose."""
        whole = [self.one_piece(c) is not None for c in chunks]
        bare, rest = list(itertools.compress(chunks, whole)), [c for c, w in zip(chunks, whole) if not w]
        for way, own in ((self.bare, bare), (self.full, rest)):
            if not own:
                continue
            self.tokenizer.pre_tokenizer = way
            calls = [own[i : i + 1000] for i in range(0, len(own), 1000)]
            found = self.tokenizer.encode_batch_fast(calls, is_pretokenized=True, add_special_tokens=False)
            flat = np.concatenate([np.array(e.ids, np.uint32) for e in found])
            upto = np.cumsum([len(c.encode()) for c in own])
            ends = np.searchsorted(np.cumsum(self.bytes_of[flat]), upto) + 1
            lengths = np.diff(ends, prepend=0)
            self.place.update(zip(own, range(len(self.place), len(self.place) + len(own))))
            self.begins = np.concatenate([self.begins, len(self.pool) + ends - lengths])
            self.lengths, self.pool = np.concatenate([self.lengths, lengths]), np.concatenate([self.pool, flat])

    def _literals(self, raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
        """Byte ranges of added tokens, the leftmost first; none spans two documents."""
        body, at = raw.tobytes(), 0
        while self.added and (m := self.added.search(body, at)):
            a, b = m.span()
            inside = np.searchsorted(offsets, a, "right") == np.searchsorted(offsets, b, "left")
            if inside:
                yield a, b
            at = b if inside else a + 1

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the documents in a row, and how many each has."""
        begin = chunk_begins(raw, offsets)
        for a, b in self._literals(raw, offsets):
            begin[a : b + 1] = False
            begin[[a, b]] = True
        starts = np.flatnonzero(begin[:-1])
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        ends = np.concatenate([starts, [len(raw)]]).astype(np.int64)
        chunks = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(raw)))
        coded = chunks.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.place) > _CACHE:
            self._forget()
        if missing := list(itertools.filterfalse(self.place.__contains__, distinct)):
            self._learn(missing)
        # Positions fit 32 bits: a piece is far smaller, and so are the ids of past chunks.
        places = np.fromiter(map(self.place.__getitem__, distinct), np.int64, len(distinct))
        own, begins, indices = self.lengths[places].astype(np.int32), self.begins[places].astype(np.int32), coded.indices.to_numpy()
        lengths = own[indices]
        total = np.cumsum(lengths, dtype=np.int64)
        first = begins[indices] - (total - lengths).astype(np.int32)
        spot = np.repeat(first, lengths)
        spot += np.arange(len(spot), dtype=np.int32)
        ids = self.pool[spot]
        upto = np.concatenate([[0], total])
        return ids, np.diff(upto[np.searchsorted(starts, offsets)])


def chunk_begins(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte, and the end, whether a chunk begins there."""
    begin = np.zeros(len(raw) + 1, bool)
    begin[offsets] = True
    if len(raw) > 1:
        before, now = raw[:-1], raw[1:]
        letter = ((raw | 32) >= 97) & ((raw | 32) <= 122)
        # The second byte of a Latin letter with a mark; the two signs among them are none.
        letter[1:] |= (before == 0xC3) & (now != 0x97) & (now != 0xB7)
        visible = (before > 32) & (before < 127) | letter[:-1]
        # Bytes of other scripts count as visible only where no wide blank occurs.
        wide = (before == 0xC2) & ((now == 0x85) | (now == 0xA0)) | (before == 0xE1) & (now == 0x9A)
        wide |= (before == 0xE2) & ((now == 0x80) | (now == 0x81)) | (before == 0xE3) & (now == 0x80)
        if not wide.any():
            visible |= before >= 128
        begin[1:-1] |= ((now == 32) | (now == 10)) & visible
        begin[1:-1] |= letter[:-1] & ~letter[1:] & (now > 32) & (now < 127)
    return begin


def _write_shards(root: str, tokenizer: str, end_id: int, levels: int, shard_tokens: int, batches: Iterator[pa.RecordBatch]):
    encoder, files, task = ChunkEncoder(tokenizer), None, TaskContext.get()
    part, shard, start = task.partitionId(), 0, 0
    held: list[np.ndarray] = []
    ids: list[int] = []
    known: list[bool] = []
    sizes: list[int] = []

    def flush():
        nonlocal files, shard, start
        tokens = np.concatenate(held)
        files = files or _open(root)
        name = f"{files[1]}/part-{part:06d}-{shard:06d}.wvm"
        image = to_bytes(WaveletMatrix.build(tokens, levels), np.array(ids, np.int64), np.cumsum(sizes), np.array(known))
        # Attempts write files of their own; the last rename wins with equal bytes.
        own = f"{name}.{task.taskAttemptId()}"
        files[0].create_dir(files[1], recursive=True)
        with files[0].open_output_stream(own) as out:
            out.write(image)
        files[0].move(own, name)
        row = pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip((part, f"{root}/{name.rpartition('/')[2]}", start, len(tokens), len(ids)), _SHARD)], schema=_SHARD
        )
        shard, start = shard + 1, start + len(tokens)
        for x in (held, ids, known, sizes):
            x.clear()
        return row

    for batch in batches:
        raw, offsets = text_buffers(batch.column(1))
        doc_ids = batch.column(0)
        keys, valid = doc_ids.fill_null(0).to_numpy(), doc_ids.is_valid().to_numpy(zero_copy_only=False)
        for a, b in cut(offsets, PIECE_BYTES):
            tokens, counts = encoder.encode(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            whole = np.full(len(tokens) + b - a, end_id, np.uint32)
            body = np.ones(len(whole), bool)
            body[np.cumsum(counts + 1) - 1] = False
            whole[body] = tokens
            held.append(whole)
            ids.extend(keys[a:b].tolist())
            known.extend(valid[a:b].tolist())
            sizes.extend((counts + 1).tolist())
            if sum(map(len, held)) >= shard_tokens:
                yield flush()
    if ids:
        yield flush()


def write_tokens(
    docs: DataFrame, root: str, tokenizer: str, levels: int = 16, end_id: int = 0, shard_tokens: int = SHARD_TOKENS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Write shards below ``root`` in ascending id order; returns (part, path, start, tokens, docs, first).

    ``first`` counts all ids before the shard. ``tokenizer`` is the file of a byte-level
    tokenizer, ``levels`` the bits of its largest id. Null and empty texts hold the end id
    alone; rows without an id come first; rows of one id are ordered by a hash of the text.
    A shard closes after the document that takes it past ``shard_tokens``, so no document is split.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    tie = F.xxhash64("text")
    # Tasks of twice the usual size: the longer a task's text, the more of its chunks it has seen.
    tasks = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 2)
    ordered = rows.repartitionByRange(tasks, "doc_id", tie).sortWithinPartitions("doc_id", tie)
    shards = ordered.mapInArrow(
        lambda b: _write_shards(root, tokenizer, end_id, levels, shard_tokens, b),
        "part int, path string, start long, tokens long, docs long",
    )
    # A few rows per task: gathered, so that the manifest is a few files.
    shards = scratch.stored(shards.repartition(-(-tasks // MANIFEST_TASKS)), f"{root}/manifest")
    parts = shards.groupBy("part").agg(F.sum("tokens").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    return shards.join(parts, "part").withColumn("first", F.col("base") + F.col("start")).drop("base")


def _read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    for batch in batches:
        for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            files, name = _open(path)
            with files.open_input_file(name) as f:
                matrix, ids, ends, known = from_bytes(f.read())
            tokens = matrix.decode().astype("<u4")
            starts = np.concatenate([[0], ends[:-1]])
            crcs = [zlib.crc32(tokens[a:b]) for a, b in zip(starts, ends)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, mask=~known), pa.array(first + starts), pa.array(ends - starts), pa.array(crcs, pa.int64())], schema=schema
            )


def read_digests(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    paths = shards.select("path", "first")
    # A number of its own, as these few narrow rows would be put into one task.
    paths = paths.repartition(max(1, -(-paths.count() // SHARDS_PER_TASK)))
    return paths.mapInArrow(_read_shards, "doc_id long, start long, n_tokens long, ids_crc32 long")
