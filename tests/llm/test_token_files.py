"""Exact round trips of token files against the tokenizer itself."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from newslake.llm import token_files as T
from newslake.llm.wavelet import WaveletMatrix, from_bytes, to_bytes
from newslake.llm.words import text_buffers

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_chunks_encode_like_whole_texts(tokenizer):
    rng = random.Random(1)
    alphabet = list("ab Z'st \n\t  .,9x é×÷ß —\x1c　日\x85<|endoftext|>\r ")
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(2000)]
    texts += [t[:9] + "<|endoftext|>" * (i % 3) + t[9:] for i, t in enumerate(texts[:500])]
    for group in (texts, [t for t in texts if not set(t) & set(" 　\x85—")]):
        ids, counts = T.ChunkEncoder(PATH).encode(*text_buffers(pa.array(group)))
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in group]
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]


def test_added_tokens_keep_their_ids(tokenizer):
    end = "<|endoftext|>"
    assert tokenizer.encode(f"a {end} b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    texts = [f"a {end} b", end, end * 3, f"x{end}y", f"\n{end}\n", "<|endoftext|", "|>a", "<|endof", "text|>", f"a  {end}  b", f"é{end}日{end[:5]}{end}", f" {end} "]
    ids, counts = T.ChunkEncoder(PATH).encode(*text_buffers(pa.array(texts)))
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]


@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (511, 9), (512, 70_000 // 2), (5000, 300)])
def test_wavelet_matrix(n, top):
    ids = np.random.default_rng(n).integers(0, top, n).astype(np.uint32)
    image = to_bytes(WaveletMatrix.build(ids, 16), np.array([4]), np.array([n]), np.array([True]))
    matrix, docs, ends, known = from_bytes(image)
    assert (matrix.decode() == ids).all() and docs.tolist() == [4] and ends.tolist() == [n] and known.all()
    assert (matrix.access(np.arange(n)) == ids).all()
    for token in {0, top - 1, top + 5, *ids[:20].tolist()}:
        assert matrix.count(token) == (ids == token).sum()
        assert matrix.count(token, n // 2) == (ids[: n // 2] == token).sum()
        assert matrix.occurrences(token).tolist() == np.flatnonzero(ids == token).tolist()


def test_too_large_id():
    with pytest.raises(ValueError):
        WaveletMatrix.build(np.array([8], np.uint32), 3)


@pytest.mark.parametrize("shard", [50, 10**6])
def test_digests(documents, tokenizer, work, shard):
    shards = T.write_tokens(documents, f"file://{work}", PATH, shard_tokens=shard)
    got = [tuple(r) for r in T.read_digests(shards).collect()]
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    ids = {}
    for doc, text in rows:
        own = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        ids[doc] = (len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
    assert sorted(((d, n, c) for d, _, n, c in got), key=str) == sorted(((d, *ids[d]) for d, _ in rows), key=str)
    at = 0
    for _, start, n, _ in sorted(got, key=lambda r: r[1]):
        assert start == at
        at += n
    order = [d for d, *_ in sorted(got, key=lambda r: r[1])]
    assert order[0] is None and order[1:] == sorted(order[1:])


def test_empty_table(documents, work):
    assert T.read_digests(T.write_tokens(documents.limit(0), work, PATH)).count() == 0
