"""Words of an Arrow string column, as arrays over all texts of a slice."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from shiftloom.llm.rolling import family, mixed, utf8

SLICE = 1 << 20  # bytes of whole texts worked on at once; a longer text is a slice of its own
ROWS = 4_096  # texts worked on at once, at most

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, stop row, offsets from 0, bytes) of runs of whole texts."""
    offsets, data = utf8(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        stop = max(row + 1, min(row + ROWS, int(np.searchsorted(offsets, offsets[row] + SLICE, "right")) - 1))
        yield row, stop, offsets[row : stop + 1] - offsets[row], data[offsets[row] : offsets[stop]]
        row = stop
    # workers live on: what earlier batches took goes back to the system
    pa.default_memory_pool().release_unused()


def words(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, stop) of each word: bytes between blanks and the ends of its text."""
    solid = ~BLANK[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    inner = offsets[1:-1][offsets[1:-1] < len(data)]
    begins[inner] = solid[inner]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    edge = inner[inner > 0] - 1
    ends[edge] = solid[edge]
    starts = np.flatnonzero(begins)
    return np.searchsorted(offsets, starts, "right") - 1, starts, np.flatnonzero(ends) + 1


def fingerprints(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, seed: int) -> np.ndarray:
    """Fingerprints of words of any length in data of any length."""
    of = family(seed)
    if len(data) < len(of.power):
        return mixed(of.between(of.sums(data), starts, stops))
    out = np.zeros(len(starts), np.uint64)  # a very long text: add up pieces, each over its own origin
    step = len(of.power) - 1
    turn = np.uint64(int(of.power[-1]))
    weight = np.ones(1, np.uint64)
    for begin in range(0, len(data), step):
        sums = of.sums(data[begin : begin + step])
        a, b = (np.clip(x - begin, 0, len(sums) - 1) for x in (starts, stops))
        out += (sums[b] - sums[a]) * weight
        weight = weight * turn
    # back to the word's own origin
    whole, rest = starts // step, starts % step
    back = np.ones(int(whole.max(initial=0)) + 1, np.uint64)
    back[1:] = pow(int(turn), -1, 2**64)
    return mixed(out * np.multiply.accumulate(back)[whole] * of.inverse[rest])
