"""Near-duplicate documents: MinHash bands, odd sketches, then the full sets.

A document's set holds its distinct word shingles, as 64-bit fingerprints. Equal sets are
one class, and only classes are compared. A class has ``BANDS`` keys of ``ROWS`` MinHash
samples each; classes that share a key are candidates. The samples are also folded into
an odd sketch, a bitmap that holds the parity of the samples at each bit: the population
count of two sketches' XOR estimates how many samples differ, and so the similarity,
most precisely where it is high. A second odd sketch holds the parity of the whole set:
the population count of two of these never exceeds the number of shingles that only one
set has, so what the threshold does not allow is ruled out for certain. Candidates that
neither rules out are compared by their full sets.

Within a bucket not all pairs are compared. Each class is compared with the bucket's
pivot first, and components are found. Only where a bucket still holds classes of several
components are pairs across components compared, so a bucket of thousands of copies of
one text costs one comparison each. No link that could join two components is left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shiftloom.llm.components import components
from shiftloom.llm.rolling import mixed
from shiftloom.llm.scratch import stored
from shiftloom.llm.words import LOWER, fingerprints, slices, words

BANDS, ROWS = 40, 6  # a pair at similarity 0.8 shares no band once in 190,000
WORDS = 16  # 64-bit words of an odd sketch
MARGIN = 0.15  # five standard errors of a sketch's estimate at 0.8

DRAWN = ("size", "sketch", "parity")
PIVOTS = 3  # others that a class is compared with first

FACTORS = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) << np.uint64(8)) | np.uint64(1)


def shingles(offsets: np.ndarray, data: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, shingle) pairs of a slice, sorted; A-Z count as a-z."""
    data = LOWER[data]
    text, starts, stops = words(offsets, data)
    word = fingerprints(data, starts, stops, 6)
    first = np.searchsorted(text, text, "left")
    left = np.searchsorted(text, text, "right") - np.arange(len(text))  # words from here to the text's end
    total = np.zeros(len(text), np.uint64)
    for k in range(wide):
        here = np.flatnonzero(left > k)
        total[here] = mixed(total[here] * np.uint64(0x9E3779B97F4A7C15) + word[here + k] + np.uint64(k + 1))
    # a text with fewer words is one shingle
    whole = (left >= wide) | (first == np.arange(len(text)))
    text, total = text[whole], total[whole]
    order = np.lexsort((total, text))
    text, total = text[order], total[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (total[1:] != total[:-1])
    return text[new], total[new]


def odd(row: np.ndarray, item: np.ndarray, n: int) -> np.ndarray:
    """Odd sketches of n rows: parity bitmaps of the items of each."""
    bits = WORDS * 64
    at = (mixed(item) % np.uint64(bits)).astype(np.int64) + row * bits
    parity = np.bincount(at, minlength=n * bits) & 1
    return np.packbits(parity.astype(np.uint8).reshape(n, bits), axis=1).view(np.int64)


def sketches(samples: np.ndarray) -> np.ndarray:
    """Odd sketches of rows of MinHash samples; the same sample elsewhere in the row is another item."""
    item = samples + np.arange(samples.shape[1], dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)
    return odd(np.repeat(np.arange(len(samples)), samples.shape[1]), item.ravel(), len(samples))


def signatures(docs: DataFrame, wide: int) -> DataFrame:
    """id, hash, n_shingles, set (a fingerprint of it), bands and sketch of (id, hash, text) rows."""
    kind = docs.schema["id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, stop, offsets, data in slices(batch.column("text")):
                n = stop - row
                text, item = shingles(offsets, data, wide)
                size = np.bincount(text, minlength=n)
                edge = np.concatenate([[0], np.cumsum(size)])
                full = np.flatnonzero(size)
                samples = np.empty((len(full), BANDS * ROWS), np.uint64)
                if len(full):
                    for k, factor in enumerate(FACTORS):
                        samples[:, k] = np.minimum.reduceat(item * factor, edge[full])
                bands = np.zeros((len(full), BANDS), np.uint64)
                for k in range(ROWS):
                    bands = mixed(bands * np.uint64(31) + samples[:, k::ROWS])
                bands = mixed(bands + np.arange(BANDS, dtype=np.uint64))
                drawn = sketches(samples)
                whole = odd(text, item, n)
                at = np.full(n, -1)
                at[full] = np.arange(len(full))
                raw = item.tobytes()
                sets = [hashlib.md5(raw[8 * edge[i] : 8 * edge[i + 1]]).digest() if size[i] else None for i in range(n)]
                part = batch.slice(row, n)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("hash"),
                        pa.array(size, pa.int64()),
                        pa.array(sets, pa.binary()),
                        pa.array([bands[k].view(np.int64) if k >= 0 else None for k in at], pa.list_(pa.int64())),
                        pa.array([drawn[k] if k >= 0 else None for k in at], pa.list_(pa.int64())),
                        pa.array([whole[i] if k >= 0 else None for i, k in enumerate(at)], pa.list_(pa.int64())),
                    ],
                    names=["id", "hash", "n_shingles", "set", "bands", "sketch", "parity"],
                )

    return docs.mapInArrow(
        sign, f"id {kind}, hash long, n_shingles long, set binary, bands array<long>, sketch array<long>, "
        "parity array<long>"
    )


def near(
    docs: DataFrame, wide: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept.

    Documents are linked where 100 * intersection >= percent * union of their sets of
    ``wide``-word shingles. A text with fewer words is one shingle; one without words, or
    null, has an empty set and no links. component_id is the smallest id reachable by
    links, the document's own included; kept says that it is its own. Rows with equal ids
    are documents of their own. A row whose id is null links with nothing, has no
    component_id and is kept. Other columns are left out.
    """
    return placed(docs, wide, percent, id_col, text_col).drop("hash", "node").withColumnRenamed("id", id_col)


def representatives(
    docs: DataFrame, wide: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest id.

    Of its rows with that id the one with the smallest hash of its text stays, and of equal
    ones the first by their other columns. Rows with a null id stay.
    """
    found = placed(docs, wide, percent, id_col, text_col).filter("component_id is not null")
    # a component is its node, as unlike rows with equal ids may not be linked; rows without words are their own
    alone = F.when(F.col("node").isNull(), F.struct("id", "hash"))
    stays = found.groupBy("node", alone.alias("alone")).agg(F.min(F.struct("id", "hash")).alias("s")).select("s.id", "s.hash").distinct()
    own = [f"own_{k}" for k in range(len(docs.columns))]
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("hash"),
        *(F.col(f"`{c}`").alias(o) for c, o in zip(docs.columns, own)),
    )
    other = [F.col(o) for c, o in zip(docs.columns, own) if c not in (id_col, text_col)]
    first = F.row_number().over(W.partitionBy("id", "hash").orderBy(*other or [F.col("id")]))
    kept = rows.join(stays, ["id", "hash"], "left_semi").withColumn("number", first).filter("number = 1")
    kept = kept.select(*own).union(rows.filter("id is null").select(*own))
    return kept.select(*(F.col(o).alias(c) for c, o in zip(docs.columns, own)))


def placed(docs: DataFrame, wide: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """id, hash of the text, n_shingles, component_id, kept and the component's node of each row."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    signed = stored(signatures(rows, wide), "signatures")
    own = signed.filter("id is not null and set is not null")
    classes = own.groupBy(F.col("set").alias("node")).agg(
        F.min(F.struct("id", "hash")).alias("one"),
        F.first("n_shingles").alias("size"),
        F.first("bands").alias("bands"),
        F.first("sketch").alias("sketch"),
        F.first("parity").alias("parity"),
    )
    classes = stored(classes, "classes")
    least = classes.select("node", F.col("one.id").alias("least"))
    linked = linked_classes(classes, rows, wide, percent)
    ids = linked.join(least, "node").groupBy("component").agg(F.min("least").alias("component_id"))
    named = linked.join(ids, "component").select("node", "component", "component_id")
    named = least.join(named, "node", "left").select(
        F.col("node").alias("set"), F.coalesce("component_id", "least").alias("component_id"), F.coalesce("component", "node").alias("node")
    )
    out = signed.select("id", "hash", "n_shingles", "set").join(stored(named, "named"), "set", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(
        "id",
        "hash",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
        "node",
    )


def linked_classes(classes: DataFrame, rows: DataFrame, wide: int, percent: int) -> DataFrame:
    """node and component of the classes that have links."""
    keys = classes.select("node", F.explode("bands").alias("key"))
    common = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    buckets = stored(keys.join(stored(common, "keys"), "key", "left_semi"), "buckets")

    ones = classes.select("node", F.col("one.id").alias("id"), F.col("one.hash").alias("hash"), *DRAWN)
    ones = ones.join(buckets.select("node").distinct(), "node", "left_semi")
    # rows with equal id and text are equal, so any of them will do
    texts = stored(rows.join(ones, ["id", "hash"]).dropDuplicates(["id", "hash"]).drop("id", "hash"), "texts")

    # each class with the pivots that it shares the most buckets with
    pivots = buckets.groupBy("key").agg(F.min("node").alias("b"))
    pairs = _most_shared(buckets.join(pivots, "key").select(F.col("node").alias("a"), "b"), PIVOTS)
    links = stored(confirmed(pairs, texts, wide, percent), "confirmed")

    # where a bucket holds classes of several pivots: the others with those of the first one.
    # Labels are of one step only here; what is joined by more steps is compared for nothing
    near = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    split = _split(buckets, near)
    first = split.groupBy("key").agg(F.min(F.struct("component", "node")).alias("first"))
    others = split.join(first, "key").filter("component != first.component")
    pairs = _most_shared(others.select(F.col("node").alias("a"), F.col("first.node").alias("b")), 3 * PIVOTS)
    links = stored(links.union(confirmed(pairs, texts, wide, percent)), "confirmed")
    found = stored(components(links), "components")
    split = _split(split.select("key", "node"), found)

    # what is left: all pairs across the components of a bucket
    split = split.join(texts.select("node", *DRAWN), "node").join(classes.select("node", "bands"), "node")
    a, b = split.alias("a"), split.alias("b")
    first_key = F.array_min(F.array_intersect(F.col("a.bands"), F.col("b.bands")))
    across = a.join(
        b,
        (F.col("a.key") == F.col("b.key"))
        & (F.col("a.component") < F.col("b.component"))
        & likely("a.{}", "b.{}", percent)
        & (F.col("a.key") == first_key),  # in one of their buckets only
    )
    pairs = across.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))
    more = stored(confirmed(pairs, texts, wide, percent), "confirmed")
    return found if more.isEmpty() else stored(components(links.union(more)), "components")


def _most_shared(pairs: DataFrame, most: int) -> DataFrame:
    """For each class the ``most`` others that it shares the most buckets with. What this
    leaves out is met by the later rounds."""
    counted = pairs.filter("a != b").groupBy("a", "b").agg(F.count("*").alias("n"))
    rank = F.row_number().over(W.partitionBy("a").orderBy(F.desc("n"), "b"))
    return counted.withColumn("rank", rank).filter(F.col("rank") <= most).select("a", "b")


def _split(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """key, node and component of the buckets that hold more than one component."""
    at = buckets.join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    at = stored(at, "placed")
    several = at.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x != y")
    return stored(at.join(stored(several.select("key"), "keys"), "key", "left_semi"), "split")


def estimate(a: Column, b: Column) -> Column:
    """Similarity by two odd sketches; 0 where they are too far apart to say."""
    bits, samples = float(WORDS * 64), float(BANDS * ROWS)
    rest = 1 - 2 * apart(a, b) / F.lit(bits)
    return F.when(rest > 0, 1 + F.lit(bits / (4 * samples)) * F.log(rest)).otherwise(F.lit(0.0))


def likely(a: str, b: str, percent: int) -> Column:
    """Whether a pair may reach the threshold, by the columns of its sides (as '{}_a').

    The sizes allow it, no more shingles are known to be in one set only than it allows,
    and the estimate is not far below.
    """
    size_a, size_b = F.col(a.format("size")), F.col(b.format("size"))
    sizes = F.least(size_a, size_b) * 100 >= F.greatest(size_a, size_b) * percent
    only_one = apart(F.col(a.format("parity")), F.col(b.format("parity")))
    # intersection and union are (total - d) / 2 and (total + d) / 2
    allowed = only_one * (100 + percent) <= (size_a + size_b) * (100 - percent)
    near = estimate(F.col(a.format("sketch")), F.col(b.format("sketch"))) >= percent / 100 - MARGIN
    return sizes & allowed & near


def apart(a: Column, b: Column) -> Column:
    """Bits in which two odd sketches differ.

    A loop over the words: written out, the words of two sketches make a method of generated
    code that is too long for the JVM to compile, and every pair is interpreted.
    """
    bits = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(bits, F.lit(0), lambda total, n: total + n)


def confirmed(pairs: DataFrame, texts: DataFrame, wide: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold. Pairs that their sketches rule out end before."""

    def side(name: str) -> DataFrame:
        return texts.select(F.col("node").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in (*DRAWN, "text")))

    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    both = both.filter(likely("{}_a", "{}_b", percent))
    both = both.select("a", "b", "text_a", "text_b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, stop, offsets, data in slices(batch.column("text_a")):
                part = batch.slice(row, stop - row)
                row_a, item_a = shingles(offsets, data, wide)
                b_at = [shingles(o, d, wide)[0:2] + (r,) for r, _, o, d in slices(part.column("text_b"))]
                row_b = np.concatenate([x[0] + x[2] for x in b_at])
                item_b = np.concatenate([x[1] for x in b_at])
                row_of, item = np.concatenate([row_a, row_b]), np.concatenate([item_a, item_b])
                order = np.lexsort((item, row_of))
                row_of, item = row_of[order], item[order]
                twice = (row_of[1:] == row_of[:-1]) & (item[1:] == item[:-1])
                common = np.bincount(row_of[1:][twice], minlength=stop - row)
                union = np.bincount(row_of, minlength=stop - row) - common
                good = np.flatnonzero(100 * common >= percent * np.maximum(union, 1))
                yield part.select(["a", "b"]).take(pa.array(good))

    return both.mapInArrow(check, "a binary, b binary")
