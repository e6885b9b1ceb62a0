"""Fingerprints of substrings and of words, vectorised with numpy.

A fingerprint is a polynomial over random byte codes modulo 2**64. With the running
sum of a text, the fingerprint of any of its substrings takes two look-ups and one
product. Two families together give 128 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

STRIDE = 1 << 20  # bytes of a text worked on at once
LONGEST = 4096  # longest substring asked for


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all their bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base % 2**64, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Family:
    """One family of fingerprints."""

    def __init__(self, seed: int):
        self.start = np.uint64(seed) * np.uint64(1 << 32)
        self.codes = mixed(self.start + np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
        base = int(mixed(np.array([seed + 977], np.uint64))[0]) & ~7 | 5
        self.power = powers(base, STRIDE + 2 * LONGEST + 1)
        self.inverse = powers(pow(base, -1, 2**64), STRIDE + 2 * LONGEST + 1)

    def sums(self, data: np.ndarray) -> np.ndarray:
        """Running sums over bytes, or over 64-bit fingerprints that stand for words."""
        codes = self.codes[data] if data.dtype == np.uint8 else mixed(data + self.start) | np.uint64(1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(codes * self.power[: len(data)], out=out[1:])
        return out

    def between(self, sums: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return (sums[stops] - sums[starts]) * self.inverse[starts]


KEPT = 3  # families that a worker keeps, as many as one operator uses in a task; each takes 17 MB

_families: dict[int, Family] = {}


def family(seed: int) -> Family:
    """The family of this seed. A worker serves several operators in turn: the oldest families go."""
    if seed not in _families:
        while len(_families) >= KEPT:
            del _families[next(iter(_families))]
        _families[seed] = Family(seed)
    return _families[seed]


def substrings(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, seed: int) -> np.ndarray:
    """Fingerprints of data[start:stop], each at most LONGEST bytes; any length of data."""
    of = family(seed)
    if len(data) <= STRIDE:
        return mixed(of.between(of.sums(data), starts, stops))
    out = np.empty(len(starts), np.uint64)
    for piece in np.unique(starts // STRIDE):
        at = np.flatnonzero(starts // STRIDE == piece)
        begin = int(piece) * STRIDE
        sums = of.sums(data[begin : begin + STRIDE + LONGEST])
        out[at] = mixed(of.between(sums, starts[at] - begin, stops[at] - begin))
    return out


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (one more than rows) and bytes of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return offsets, np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)


def signed(h: np.ndarray) -> pa.Array:
    """64-bit fingerprints as the signed integers Spark has."""
    return pa.array(h.view(np.int64))
