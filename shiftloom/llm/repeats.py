"""Removal of byte strings that occur more than once, by fingerprints at sampled places.

Fingerprints of fixed lengths take the place of prefix doubling over a suffix array: no
pairs of earlier ranks are formed, no offset is doubled and nothing is sorted. A place is
ranked by the fingerprint of the string there, places whose rank is unique drop out, and
the rest are ranked anew by a fingerprint of another fixed length, at last of all
``length`` bytes. Three things make this fit a corpus:

- Only equality is needed, so Spark's grouping of equal ranks takes the place of the
  global sort.
- Every window of ``length`` bytes has one anchor: the place of the least fingerprint of
  ``SEED`` bytes in it. Equal windows have their anchors at the same offset, so ranking
  anchors first, a hundredth of all places, loses no repeat.
- All windows of an anchor are judged together. If the string that covers them all
  occurs twice, all are repeats. If the string that they share is unique, none is. What
  is left is judged by a smaller range of offsets, and then window by window.

Ranks that decide have 128 bits.

Runs of words go the same way: a text is then a row of words, each by a fingerprint of
64 bits, and places, windows and ranks count words instead of bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftloom.llm.rolling import STRIDE, mixed, signed, substrings, utf8
from shiftloom.llm.scratch import stored
from shiftloom.llm.words import fingerprints, words

SEED = 100  # bytes of the first rank
CELL = 43  # offsets judged together in the second round
SPREAD = 511  # offsets of a window from its anchor, at most, as a place has 9 bits for them

KEY = ["id", "hash"]


class Windows(NamedTuple):
    """Windows that are looked for: their length, in words or else in bytes."""

    length: int
    words: bool
    seed: int  # words or bytes of the first rank
    cell: int  # offsets judged together in the second round

    @property
    def spread(self) -> int:
        """An anchor's windows start at offsets 0 to this before it."""
        return self.length - self.seed

    @property
    def least_bytes(self) -> int:
        return 2 * self.length - 1 if self.words else self.length


def byte_windows(length: int) -> Windows:
    return _checked(Windows(length, False, SEED, CELL))


def word_windows(length: int) -> Windows:
    seed = -(-length // 3)
    return _checked(Windows(length, True, seed, (length - seed) // 4 + 1))


def _checked(of: Windows) -> Windows:
    if not max(of.seed, 1) <= of.length <= of.seed + SPREAD:
        raise ValueError(f"windows of {of.length} {'words' if of.words else 'bytes'}")
    return of


def removed(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte is removed if a string of ``length`` bytes that covers it also starts anywhere
    else, in the same document or in another row. A null text is an empty one; nothing
    shorter than ``length`` is removed. Null and repeated ids are kept: rows with equal
    ids are separate documents. Other columns are left out.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    return _cut(rows, [byte_windows(length)], []).withColumnRenamed("id", id_col)


def kept(
    docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", run: int | None = None
) -> DataFrame:
    """The documents with repeated strings removed from the text; all columns are kept.

    With ``run``, the words of every run of so many that also stands anywhere else go as
    well, and what is between them, however many bytes that is. Words are what stands
    between blanks; runs are equal word for word, whatever the blanks. Both are judged on
    the whole texts. A null text stays null. Characters that lose some of their bytes are
    lost as a whole.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    own = [f"own_{k}" for k in range(len(docs.columns))]
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.xxhash64(text).alias("hash"),
        text.alias("text"),
        *(
            (F.col(f"`{c}`").isNotNull() if c == text_col else F.col(f"`{c}`")).alias(n)
            for c, n in zip(docs.columns, own)
        ),
    )
    cut = _cut(rows, [byte_windows(length)] + ([word_windows(run)] if run else []), own)
    return cut.select(
        *(
            (F.when(F.col(n), F.col("kept")) if c == text_col else F.col(n)).alias(c)
            for c, n in zip(docs.columns, own)
        )
    )


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.id").eqNullSafe(F.col(f"{b}.id")) & (F.col(f"{a}.hash") == F.col(f"{b}.hash"))


def spans(rows: DataFrame, of: Windows) -> DataFrame:
    """id, hash and the runs of starts (first, last) of windows that occur more than once."""
    kind = rows.schema["id"].dataType.simpleString()
    texts = rows.filter(F.octet_length("text") >= of.least_bytes)
    places = stored(
        texts.mapInArrow(
            _anchors(of), f"id {kind}, hash long, place long, core long, whole1 long, whole2 long"
        ),
        "anchors",
    )
    seen = stored(_twice(places, "core").drop("core"), "seen")
    judged = stored(_marked(seen, "whole1", "whole2").select(*KEY, "place", "twice", "open"), "judged")

    cells = stored(
        _at(texts, judged.filter("open"), "place").mapInArrow(
            _cells(of),
            f"id {kind}, hash long, first long, last long, core long, whole1 long, whole2 long",
        ),
        "cells",
    )
    inner = stored(_marked(_twice(cells, "core").drop("core"), "whole1", "whole2"), "cells-judged")
    open_cells = inner.filter("open").select(*KEY, F.struct("first", "last").alias("cell"))
    single = stored(
        _at(texts, open_cells, "cell").mapInArrow(
            _windows(of), f"id {kind}, hash long, first long, whole1 long, whole2 long"
        ),
        "windows",
    )
    ends = F.expr("place >> 18").alias("a"), F.expr("(place >> 9) & 511").alias("hi"), F.expr("place & 511").alias("lo")
    runs = judged.filter("twice").select(*KEY, *ends).select(*KEY, F.expr("a - hi").alias("first"), F.expr("a - lo").alias("last"))
    return (
        runs.union(inner.filter("twice").select(*KEY, "first", "last"))
        .union(_twice(single, "whole1", "whole2").select(*KEY, "first", F.col("first").alias("last")))
    )


def _twice(df: DataFrame, *rank: str) -> DataFrame:
    """Rows whose rank is not unique. Ranks are counted before rows meet.

    The repeated ranks are a table of their own, so that the join deals both its sides
    out anew and splits a rank that very many rows have.
    """
    common = stored(df.groupBy(*rank).agg(F.count("*").alias("n")).filter("n > 1").drop("n"), "ranks")
    return df.join(common, list(rank), "left_semi")


def _marked(df: DataFrame, *rank: str) -> DataFrame:
    """All rows, with ``twice``: whether the rank is not unique, and ``open``: whether the
    next round needs the row. That is so if it is not decided, and for one row of each
    rank that is: others may share a part of its string only."""
    tagged = df.withColumn("tag", F.xxhash64(*df.columns))
    common = tagged.groupBy(*rank).agg(F.count("*").alias("n"), F.min("tag").alias("one")).filter("n > 1").drop("n")
    common = stored(common, "ranks")
    twice = F.col("one").isNotNull()
    return (
        tagged.join(common, list(rank), "left")
        .withColumns({"twice": twice, "open": ~twice | (F.col("tag") == F.col("one"))})
        .drop("tag", "one")
    )


def _at(texts: DataFrame, places: DataFrame, what: str) -> DataFrame:
    """Texts with the distinct places of their rows."""
    lists = places.groupBy(*KEY).agg(F.collect_set(what).alias("places"))
    return texts.alias("t").join(lists.alias("p"), _same("t", "p")).select("t.id", "t.hash", "t.text", "p.places")


def _texts(batch: pa.RecordBatch, as_words: bool = False) -> Iterator[tuple[int, np.ndarray]]:
    """The bytes of each text, or fingerprints of its words."""
    offsets, data = utf8(batch.column("text"))
    for i in range(len(offsets) - 1):
        text = data[offsets[i] : offsets[i + 1]]
        yield i, fingerprints(text, *_words(text), 1) if as_words else text


def _words(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the words of a text."""
    return words(np.array([0, len(text)]), text)[1:]


def _rows(batch: pa.RecordBatch, which: list[np.ndarray], **columns) -> pa.RecordBatch:
    at = pa.array(np.concatenate(which)) if which else pa.array([], pa.int64())
    arrays = [batch.column("id").take(at), batch.column("hash").take(at), *columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=["id", "hash", *columns])


def _joined(parts: list[np.ndarray], kind=np.int64) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def least(data: np.ndarray, length: int, seed: int = SEED) -> np.ndarray:
    """For each start of a window of ``length`` bytes or words, the place of its least seed.

    Of equal seeds the first counts. Seeds are compared by 43 bits; equal windows agree.
    """
    n, wide = len(data), length - seed + 1
    starts = np.arange(n - seed + 1)
    seeds = substrings(data, starts, starts + seed, 1)
    low = np.uint64((1 << 21) - 1)
    seeds = (seeds & ~low) | starts.astype(np.uint64)
    blocks = -(-len(seeds) // wide)
    full = np.full(blocks * wide, np.iinfo(np.uint64).max, np.uint64)
    full[: len(seeds)] = seeds
    full = full.reshape(blocks, wide)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    behind = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    last = n - length + 1
    return (np.minimum(behind[:last], ahead[wide - 1 : wide - 1 + last]) & low).astype(np.int64)


def anchors(data: np.ndarray, length: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first, last): the anchors of all windows and the starts that each stands for."""
    out = []
    for begin in range(0, max(0, len(data) - length + 1), STRIDE):
        piece = data[begin : begin + STRIDE + length - 1]
        places = least(piece, length, seed)
        edge = np.flatnonzero(np.diff(places)) + 1
        first = np.concatenate([[0], edge])
        last = np.concatenate([edge - 1, [len(places) - 1]])
        out.append(np.stack([places[first], first, last]) + begin)
    if not out:
        return tuple(np.zeros((3, 0), np.int64))
    at, first, last = np.concatenate(out, axis=1)
    new = np.concatenate([[True], at[1:] != at[:-1]])  # an anchor on both sides of a stride is one
    return at[new], first[new], last[np.concatenate([new[1:], [True]])]


def covering(data: np.ndarray, at: np.ndarray, far: np.ndarray, near: np.ndarray, length: int):
    """Two ranks of the string that covers the windows starting ``near`` to ``far`` bytes
    before ``at``, as far as the text goes; what the text's ends cut off is part of the rank."""
    start, stop = at - far, at - near + length
    lo, hi = np.maximum(start, 0), np.minimum(stop, len(data))
    clipped = mixed(((lo - start) * 4096 + (stop - hi)).astype(np.uint64))
    return tuple(signed(mixed(substrings(data, lo, hi, seed) ^ clipped)) for seed in (2, 3))


def _anchors(of: Windows):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, place, core, one, two = [], [], [], [], []
            for i, data in _texts(batch, of.words):
                at, first, last = anchors(data, of.length, of.seed)
                which.append(np.full(len(at), i))
                place.append(at << 18 | (at - first) << 9 | (at - last))
                core.append(substrings(data, at, at + of.seed, 1))
                a, b = covering(data, at, np.full(len(at), of.spread), np.zeros(len(at), np.int64), of.length)
                one.append(a.to_numpy()), two.append(b.to_numpy())
            yield _rows(
                batch,
                which,
                place=pa.array(_joined(place)),
                core=signed(_joined(core, np.uint64)),
                whole1=pa.array(_joined(one)),
                whole2=pa.array(_joined(two)),
            )

    return find


def _cells(of: Windows):
    length, wide = of.length, of.cell

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[] for _ in range(6)]
            lists = batch.column("places")
            for i, data in _texts(batch, of.words):
                place = np.sort(lists[i].values.to_numpy(zero_copy_only=False))
                at, hi, lo = place >> 18, place >> 9 & 511, place & 511
                n = hi // wide - lo // wide + 1
                at, hi, lo, low = (np.repeat(x, n) for x in (at, hi, lo, lo // wide))
                cell = low + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
                near, far = cell * wide, np.minimum(cell * wide + wide - 1, of.spread)
                one, two = covering(data, at, far, near, length)
                core = substrings(data, at - near, at - far + length, 1)
                for column, x in zip(
                    out,
                    (np.full(len(at), i), at - np.minimum(far, hi), at - np.maximum(near, lo), core.view(np.int64), one.to_numpy(), two.to_numpy()),
                ):
                    column.append(x)
            names = ("first", "last", "core", "whole1", "whole2")
            yield _rows(batch, out[0], **{k: pa.array(_joined(v)) for k, v in zip(names, out[1:])})

    return split


def _windows(of: Windows):
    length = of.length

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, start, one, two = [], [], [], []
            lists = batch.column("places")
            for i, data in _texts(batch, of.words):
                ends = lists[i].values
                first, last = (ends.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
                n = last - first + 1
                at = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                which.append(np.full(len(at), i))
                start.append(at)
                one.append(substrings(data, at, at + length, 2).view(np.int64))
                two.append(substrings(data, at, at + length, 3).view(np.int64))
            yield _rows(
                batch, which, first=pa.array(_joined(start)), whole1=pa.array(_joined(one)), whole2=pa.array(_joined(two))
            )

    return split


def _cut(rows: DataFrame, looked: list[Windows], own: list[str]) -> DataFrame:
    """What is left of each row; with ``own`` columns, those and the text that is left."""
    texts = rows.select(*KEY, "text")
    found = reduce(DataFrame.union, [spans(texts, of).withColumn("kind", F.lit(k)) for k, of in enumerate(looked)])
    found = stored(found.groupBy(*KEY).agg(F.collect_list(F.struct("first", "last", "kind")).alias("runs")), "runs")
    both = rows.alias("t").join(found.alias("p"), _same("t", "p"), "left").select("t.*", "p.runs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, gone, count, digest, text = [], [], [], [], []
            lists = batch.column("runs")
            for i, data in _texts(batch):
                n, left = 0, data
                if lists[i].is_valid:
                    first, last, kind = (lists[i].values.field(k).to_numpy(zero_copy_only=False) for k in (0, 1, 2))
                    step = np.zeros(len(data) + 1, np.int64)
                    for k in np.unique(kind):
                        start, stop = first[kind == k], last[kind == k] + looked[k].length
                        if looked[k].words:
                            starts, stops = _words(data)
                            start, stop = starts[start], stops[stop - 1]
                        np.add.at(step, start, 1)
                        np.add.at(step, stop, -1)
                    covered = np.cumsum(step[:-1]) > 0
                    n = int((np.diff(covered.astype(np.int8), prepend=0) == 1).sum())
                    left = data[~covered]
                size.append(len(data)), gone.append(len(data) - len(left)), count.append(n)
                if own:
                    text.append(left.tobytes().decode("utf-8", "ignore"))
                else:
                    digest.append(hashlib.sha256(left).hexdigest())
            if own:
                arrays = [pa.array(text, pa.string()), *(batch.column(c) for c in own)]
                yield pa.RecordBatch.from_arrays(arrays, names=["kept", *own])
            else:
                arrays = [batch.column("id"), *(pa.array(x, pa.int64()) for x in (size, gone, count)), pa.array(digest, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    if own:
        kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in own)
        return both.mapInArrow(cut, f"kept string, {kinds}")
    kind = rows.schema["id"].dataType.simpleString()
    return both.mapInArrow(cut, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
