"""Wavelet matrix of a token sequence and its file image.

One bit-plane per bit of the largest id, highest bit first. Plane ``k`` holds that
bit of the sequence as ordered by the planes before it; zeros then move ahead of ones,
both keeping their order. Ranks come from a directory of one count per 512 bits.
Access, counting and finding occurrences take one step per plane.
"""

from __future__ import annotations

import struct

import numpy as np
import zstandard

_MAGIC = b"NLWM\x01"
_HEAD = "<5sBQQ"
_BLOCK = 512


class WaveletMatrix:
    """Planes as packed bits; ``zeros`` counts each plane's zero bits."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int]):
        self.n, self.planes, self.zeros = n, planes, zeros
        self._words: list[np.ndarray] | None = None

    @classmethod
    def build(cls, ids: np.ndarray, levels: int) -> WaveletMatrix:
        """Needs every id below ``2 ** levels``."""
        now = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        if len(ids) and int(ids.max()) >> levels:
            raise ValueError(f"an id needs more than {levels} bits")
        planes, zeros = [], []
        for k in range(levels - 1, -1, -1):
            if k == 7:
                now = now.astype(np.uint8)  # the higher bits are stored
            bit = (now >> k).astype(np.uint8) & 1
            planes.append(np.packbits(bit, bitorder="little"))
            one = bit.view(bool)
            # Positions move faster than masks do.
            low, high = np.flatnonzero(~one), np.flatnonzero(one)
            zeros.append(len(low))
            now = np.concatenate([now[low], now[high]])
        return cls(len(ids), planes, zeros)

    @property
    def levels(self) -> int:
        return len(self.planes)

    def decode(self) -> np.ndarray:
        """The whole sequence, from the last plane up."""
        now = np.zeros(self.n, np.uint8)
        for k, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
            if k == 8:
                now = now.astype(np.uint16 if self.levels <= 16 else np.uint32)
            one = np.unpackbits(plane, count=self.n, bitorder="little").view(bool)
            up = np.empty_like(now)
            up[np.flatnonzero(~one)] = now[:zeros]
            up[np.flatnonzero(one)] = now[zeros:] | now.dtype.type(1 << k)
            now = up
        return now

    def _directory(self):
        """64-bit words of each plane and the ones before every block of 512 bits."""
        if self._words is None:
            self._words, self._ones = [], []
            for plane in self.planes:
                room = np.zeros((self.n // _BLOCK + 1) * _BLOCK // 8, np.uint8)
                room[: len(plane)] = plane
                words = room.view("<u8")
                per = np.bitwise_count(words).reshape(-1, _BLOCK // 64).sum(1, dtype=np.int64)
                self._words.append(words)
                self._ones.append(np.concatenate([[0], np.cumsum(per)]))
        return self._words, self._ones

    def _rank(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones of a plane before each position."""
        words, ones = (x[level] for x in self._directory())
        total = ones[at // _BLOCK].astype(np.int64)
        first, last = at // _BLOCK * (_BLOCK // 64), at // 64
        for i in range(_BLOCK // 64):
            use = first + i < last
            total += np.where(use, np.bitwise_count(words[np.minimum(first + i, len(words) - 1)]), 0)
        rest = (np.uint64(1) << (at % 64).astype(np.uint64)) - np.uint64(1)
        return total + np.bitwise_count(words[np.minimum(last, len(words) - 1)] & rest)

    def access(self, at) -> np.ndarray:
        """The ids at the positions."""
        at = np.asarray(at, np.int64)
        ids = np.zeros(at.shape, np.int64)
        for k in range(self.levels):
            words = self._directory()[0][k]
            bit = (words[at // 64] >> (at % 64).astype(np.uint64) & np.uint64(1)).astype(np.int64)
            one = self._rank(k, at)
            at = np.where(bit == 1, self.zeros[k] + one, at - one)
            ids = ids << 1 | bit
        return ids

    def _bounds(self, token: int, end: int) -> tuple[int, int]:
        """Where the occurrences of an id before ``end`` lie below the last plane."""
        lo, hi = np.array([0]), np.array([end])
        for k in range(self.levels):
            one_lo, one_hi = self._rank(k, lo), self._rank(k, hi)
            if token >> (self.levels - 1 - k) & 1:
                lo, hi = self.zeros[k] + one_lo, self.zeros[k] + one_hi
            else:
                lo, hi = lo - one_lo, hi - one_hi
        return int(lo[0]), int(hi[0])

    def count(self, token: int, end: int | None = None) -> int:
        """How often an id occurs before a position (anywhere by default)."""
        if token < 0 or token >> self.levels or not self.n:
            return 0
        lo, hi = self._bounds(token, self.n if end is None else end)
        return hi - lo

    def occurrences(self, token: int) -> np.ndarray:
        """All positions of an id in ascending order."""
        if token < 0 or token >> self.levels or not self.n:
            return np.zeros(0, np.int64)
        lo, hi = self._bounds(token, self.n)
        at = np.arange(lo, hi)
        for k in range(self.levels - 1, -1, -1):
            one = token >> (self.levels - 1 - k) & 1
            at = self._select(k, one, at - self.zeros[k] if one else at)
        return at

    def _select(self, level: int, bit: int, nth: np.ndarray) -> np.ndarray:
        """Position of the n-th (from 0) such bit of a plane, by bisection on ranks."""
        lo, hi = np.zeros(len(nth), np.int64), np.full(len(nth), self.n, np.int64)
        while (lo < hi).any():
            mid = (lo + hi) // 2
            ones = self._rank(level, np.minimum(mid + 1, self.n))
            enough = (ones if bit else np.minimum(mid + 1, self.n) - ones) > nth
            lo, hi = np.where(enough | (lo >= hi), lo, mid + 1), np.where(enough & (lo < hi), mid, hi)
        return lo


def to_bytes(matrix: WaveletMatrix, doc_ids: np.ndarray, ends: np.ndarray, known: np.ndarray) -> bytes:
    """File image: header, document table (id, whether it has one, end), then each plane."""
    pack = zstandard.ZstdCompressor(level=1).compress
    parts = [doc_ids.astype("<i8").tobytes(), known.astype("u1").tobytes(), ends.astype("<u8").tobytes()]
    out = [struct.pack(_HEAD, _MAGIC, matrix.levels, matrix.n, len(doc_ids))]
    for body in parts + [p.tobytes() for p in matrix.planes]:
        body = pack(body)
        out += [struct.pack("<Q", len(body)), body]
    out.append(struct.pack(f"<{matrix.levels}Q", *matrix.zeros))
    return b"".join(out)


def from_bytes(image: bytes) -> tuple[WaveletMatrix, np.ndarray, np.ndarray, np.ndarray]:
    """The matrix, document ids, their ends and whether each id is known."""
    magic, levels, n, docs = struct.unpack_from(_HEAD, image)
    if magic != _MAGIC:
        raise ValueError("not a wavelet token file")
    at, bodies, unpack = struct.calcsize(_HEAD), [], zstandard.ZstdDecompressor().decompress
    for _ in range(3 + levels):
        (size,) = struct.unpack_from("<Q", image, at)
        bodies.append(unpack(image[at + 8 : at + 8 + size]))
        at += 8 + size
    zeros = list(struct.unpack_from(f"<{levels}Q", image, at))
    ids, known, ends = np.frombuffer(bodies[0], "<i8"), np.frombuffer(bodies[1], "u1"), np.frombuffer(bodies[2], "<u8")
    planes = [np.frombuffer(b, np.uint8) for b in bodies[3:]]
    return WaveletMatrix(n, planes, zeros), ids, ends.astype(np.int64), known.astype(bool)
