"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within cells.

Equal vectors are one class, and only classes are compared. Each class has the cell of
the centroid it is nearest to as its home. Two vectors at a cosine of at least ``least``
are at most ``sqrt(2 - 2 least)`` apart, so if their homes differ, one of them is within
half of that of the plane between the two centroids. A class therefore visits every cell
whose plane is that near, and each pair is in a home together, or one of the two visits
the other's: no link is lost. A pair seen twice is counted in one of the two cells.

Cells are compared block by block, at most about ``BLOCK`` against ``BLOCK`` vectors in a
task, so a cell of any size is spread. A block says how many links each of its vectors
has, and a spanning forest of the links, never the pairs themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftloom.llm.components import components
from shiftloom.llm.scratch import stored

BLOCK = 1024  # vectors of a block, about
SAMPLE = 16_384  # vectors that centroids are fitted to, at most
CELL = 2_000  # vectors for each centroid, about
CELLS = 1_024  # centroids at most


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, all components there and finite, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column of equal lengths, as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def centroids(sample: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids of spherical k-means; an empty cell takes the worst placed vector."""
    rows = unit(sample)
    at = rows[np.random.default_rng(0).permutation(len(rows))[:k]]
    for _ in range(rounds):
        near = rows @ at.T
        home = near.argmax(axis=1)
        sums = np.zeros_like(at)
        np.add.at(sums, home, rows)
        size = np.linalg.norm(sums, axis=1)
        empty = np.flatnonzero(size < 1e-9)
        sums[empty] = rows[np.argsort(near.max(axis=1), kind="stable")[: len(empty)]]
        at = unit(sums)
    return np.unique(at, axis=0)


def margins(rows: np.ndarray, home: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Distance of unit rows to the planes between their home's centroid and the others."""
    near = rows @ at.T
    apart = np.sqrt(np.maximum(2 - 2 * at @ at.T, 1e-30))[home]
    out = (near[np.arange(len(rows)), home][:, None] - near) / apart
    out[np.arange(len(rows)), home] = np.inf
    return out


def near_vectors(
    vectors: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept.

    Vectors at a cosine of at least ``least`` are linked, all such pairs. n_links counts
    the other rows linked directly; component_id is the smallest id reachable by links,
    the row's own included; kept says that it is its own. Vectors that are null, zero or
    hold null or non-finite components link with nothing, and so do rows with a null id,
    which have no component_id and are kept. Only vectors of equal length are compared.
    Rows with equal ids are vectors of their own. Other columns are left out.
    """
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("vector"))
    part = F.col("id").isNotNull() & usable(F.col("vector"))
    rows = rows.withColumn("key", F.when(part, F.md5(F.col("vector").cast("string"))))
    classes = rows.filter("key is not null").groupBy("key").agg(
        F.min("id").alias("least"), F.count("*").alias("rows"), F.first("vector").alias("vector")
    )
    classes = stored(classes.withColumn("dim", F.size("vector")), "classes")
    found = stored(links(classes, least), "links")

    ids = classes.select("key", "least", "rows")
    counts = found.groupBy("key").agg(F.sum("n").alias("n"))
    parts = components(found.select(F.col("key").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "key")
    parts = stored(parts, "components")
    smallest = parts.join(ids, "key").groupBy("component").agg(F.min("least").alias("component_id"))
    named = parts.join(smallest, "component").select("key", "component_id")
    known = ids.join(counts, "key", "left").join(named, "key", "left").select(
        "key",
        (F.col("rows") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        F.coalesce("component_id", "least").alias("component_id"),
    )
    out = rows.select("id", "key").join(known, "key", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )


def fitted(classes: DataFrame) -> dict[int, np.ndarray]:
    """Centroids by length of the vectors, from a sample of the least hashes; only for the most usual length."""
    lengths = classes.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if lengths is None:
        return {}
    dim, n = lengths
    own = classes.filter(F.col("dim") == dim).orderBy(F.xxhash64("key"), "key").limit(SAMPLE).select("vector")
    sample = matrix(own.toArrow().column("vector"))
    k = min(max(1, -(-n // CELL)), CELLS, len(sample))
    return {dim: centroids(sample, k)}


def links(classes: DataFrame, least: float) -> DataFrame:
    """key, root, n: for each block and class with links there, how many rows it links
    with, and the least key of its part of the block's links."""
    model = fitted(classes)
    reach = float(np.sqrt(max(0.0, 2 - 2 * least))) / 2 + 1e-9

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home, visits = np.zeros(len(batch), np.int32), [[] for _ in range(len(batch))]
            dims = batch.column("dim").to_numpy()
            for dim in model:
                own = np.flatnonzero(dims == dim)
                for some in np.array_split(own, -(-len(own) // 2000) or 1):
                    if len(some):
                        u = unit(matrix(batch.column("vector").take(pa.array(some))))
                        home[some] = (u @ model[dim].T).argmax(axis=1)
                        near = margins(u, home[some], model[dim]) <= reach
                        for i, row in zip(some, near):
                            visits[i] = np.flatnonzero(row)
            columns = [*(batch.column(c) for c in ("key", "rows", "dim", "vector"))]
            columns += [pa.array(home), pa.array(visits, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "rows", "dim", "vector", "home", "visits"])

    kind = classes.schema["vector"].dataType.simpleString()
    placed = classes.select("key", "rows", "dim", "vector").mapInArrow(
        place, f"key string, rows long, dim int, vector {kind}, home int, visits array<int>"
    )
    placed = stored(placed, "placed")
    homes = placed.withColumn("cell", F.col("home"))
    visitors = placed.withColumn("cell", F.explode("visits"))
    cell = ["dim", "cell"]

    def blocks(df, name):
        return df.groupBy(*cell).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))

    sizes = blocks(homes, "own").join(blocks(visitors, "guests"), cell, "left").fillna(0, ["guests"])
    row = ["key", "rows", "dim", "cell", "home", "vector"]
    mine = F.pmod(F.xxhash64("key"), F.col("own")).cast("int")
    homes = homes.select(*row).join(sizes, cell).withColumn("block", mine)
    # a home block meets each of its cell's home blocks, itself included, and each guests' block
    with_homes = homes.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("own") - 1))).select(
        *row,
        F.lit(False).alias("guests"),
        F.least("block", "other").alias("x"),
        F.greatest("block", "other").alias("y"),
        (F.col("block") > F.col("other")).alias("second"),
    )
    to_guests = homes.filter("guests > 0").withColumn("y", F.explode(F.sequence(F.lit(0), F.col("guests") - 1))).select(
        *row, F.lit(True).alias("guests"), F.col("block").alias("x"), "y", F.lit(False).alias("second")
    )
    as_guests = (
        visitors.select(*row)
        .join(sizes, cell)
        .withColumn("y", F.pmod(F.xxhash64("key"), F.col("guests")).cast("int"))
        .withColumn("x", F.explode(F.sequence(F.lit(0), F.col("own") - 1)))
        .select(*row, F.lit(True).alias("guests"), "x", "y", F.lit(True).alias("second"))
    )
    dealt = with_homes.union(to_guests).union(as_guests)

    def meet(group: pa.Table) -> pa.Table:
        second = group.column("second").to_numpy()
        a, b = np.flatnonzero(~second), np.flatnonzero(second)
        guests, same = group.column("guests")[0].as_py(), group.column("x")[0] == group.column("y")[0]
        if not guests and same:
            b = a
        u = unit(matrix(group.column("vector")))
        i, j = np.nonzero(u[a] @ u[b].T >= least)
        i, j = a[i], b[j]
        if not guests and same:
            i, j = i[i != j], j[i != j]  # each pair is here twice, once in each order
        else:
            if guests:  # seen in the guest's home as well, if the other visits it: count it in the lower cell
                home = group.column("home").to_numpy()
                centre = model[group.column("dim")[0].as_py()]
                here, there = home[i], home[j]
                gap = np.sqrt(np.maximum(2 - 2 * (centre[here] * centre[there]).sum(axis=1), 1e-30))
                both = (u[i] * (centre[here] - centre[there])).sum(axis=1) / gap <= reach
                once = ~both | (here < there)
                i, j = i[once], j[once]
            i, j = np.concatenate([i, j]), np.concatenate([j, i])
        order = np.argsort(i, kind="stable")
        i, j = i[order], j[order]
        linked, first = np.unique(i, return_index=True)
        if not len(linked):
            return SAID.empty_table()
        keys = np.array(group.column("key").to_pylist(), object)
        rank = np.empty(len(keys), np.int64)
        rank[np.argsort(keys)] = np.arange(len(keys))
        label = rank.copy()
        while True:  # the least key that links reach, within the block
            low = np.minimum(label[linked], np.minimum.reduceat(label[j], first))
            if (low == label[linked]).all():
                break
            label[linked] = low
        rows = group.column("rows").to_numpy()
        n = np.add.reduceat(rows[j], first)
        root = keys[np.argsort(rank)][label[linked]]
        return pa.table([pa.array(keys[linked], pa.string()), pa.array(root, pa.string()), pa.array(n, pa.int64())], SAID)

    return dealt.groupBy("dim", "cell", "guests", "x", "y").applyInArrow(meet, "key string, root string, n long")


SAID = pa.schema([("key", pa.string()), ("root", pa.string()), ("n", pa.int64())])
