"""Nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector to the cell of a grid over a few Gaussian projections. A query
looks into its own cell and into cells next to it, in the order in which they are likely
to hold a near vector: by the sum of squared distances from the query's projections to
the cells' sides. Candidates of all tables are ranked by their exact distance.

A grid is fitted to a bounded sample, for neighbours up to a distance, its reach: the
fewest probes that find ``AIM`` of the rows that far away. The reach is the one that
leaves the least to compare. All rows are indexed. A bucket with many rows is split into
blocks, and so are the queries that meet it; each pair of blocks gives only its best k
for a query.

The k-th row found is no nearer than the k-th neighbour. So a query whose k-th row is
within the reach is done. The others, and those that found fewer than k, go to a wider
grid fitted to them while there are many and a grid spares comparisons, and then over all
rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shiftloom.llm.scratch import stored
from shiftloom.llm.vectors import matrix, usable

TABLES = 2
SAMPLE = 8_192  # vectors that the grid is fitted to, at most
TESTS = 200  # queries that are looked up in it
AIM = 0.97  # share of the rows at the reach that the probes find
GRIDS = 3  # at most, before the queries left go over all rows
BLOCK = 4_096  # rows, and queries, that meet in a task, about
SPREAD = 2_048  # rows of neighbouring buckets dealt together, about


@dataclass
class Grid:
    """Projections and offsets of each table, the probes' steps, how many are taken, and
    the distance up to which they find ``AIM`` of the rows."""

    lines: np.ndarray  # tables, dimensions of a vector, dimensions of the grid
    shifts: np.ndarray
    width: float
    steps: np.ndarray  # all steps of -1, 0 and 1 in the grid's dimensions
    probes: int
    reach: float
    cost: float = 0.0  # rows compared with a query, those of the next search included, as a share of all

    def cells(self, rows: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """Cells of rows, and where in the cell they are, from 0 to 1."""
        at = rows @ self.lines[table] / self.width + self.shifts[table]
        low = np.floor(at)
        return np.clip(low, -(2**40), 2**40).astype(np.int64), np.nan_to_num(at - low)

    def order(self, inside: np.ndarray) -> np.ndarray:
        """Steps of each row, likeliest first."""
        away = np.stack([inside**2, np.zeros_like(inside), (1 - inside) ** 2])  # to the side a step crosses
        score = sum(away[self.steps[:, k] + 1, :, k] for k in range(inside.shape[1]))
        return np.argsort(score, axis=0, kind="stable").T

    def probed(self, rows: np.ndarray, table: int, probes: int) -> np.ndarray:
        """Codes of the cells that each row looks into, likeliest first."""
        cell, inside = self.cells(rows, table)
        return code(cell[:, None, :] + self.steps[self.order(inside)[:, :probes]])

    def found(self, rows: np.ndarray, away: np.ndarray) -> np.ndarray:
        """The probe, from 0, that finds what is ``away`` from a row, in the table that finds it first."""
        first = np.full(away.shape[:2], len(self.steps))
        for t in range(TABLES):
            cell, inside = self.cells(rows, t)
            there = self.cells((rows[:, None] + away).reshape(-1, rows.shape[1]), t)[0]
            step = there.reshape(*away.shape[:2], -1) - cell[:, None]
            place = np.argsort(self.order(inside), axis=1)  # of each step in the order
            index = ((np.clip(step, -1, 1) + 1) * 3 ** np.arange(step.shape[2])[::-1]).sum(axis=2)
            at = np.take_along_axis(place, index, 1)
            first = np.minimum(first, np.where((np.abs(step) <= 1).all(axis=2), at, len(self.steps)))
        return first


def code(cells: np.ndarray) -> np.ndarray:
    """One number for each cell."""
    out = np.zeros(cells.shape[:-1], np.uint64)
    for k in range(cells.shape[-1]):
        out = (out ^ cells[..., k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all pairs, by products: near enough to choose whom to measure."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0)


def fitted(sample: np.ndarray, tests: np.ndarray, same: np.ndarray, rows: int, k: int) -> Grid:
    """Grid for so many rows of which ``sample`` are some, and queries of which ``tests`` are some.

    ``same`` says which row of the sample is the query's own.
    """
    random = np.random.default_rng(0)
    dim, dims = sample.shape[1], int(np.clip(round(np.log(max(rows, 2) / 64) / np.log(3)), 2, 6))
    lines, shifts = random.normal(size=(TABLES, dim, dims)), random.random((TABLES, dims))
    steps = np.array(list(product((-1, 0, 1), repeat=dims)))
    # a power of two as unit keeps squares finite
    unit = 2.0 ** float(np.ceil(np.log2(max(np.abs(sample).max(), np.abs(tests).max()))))
    sample, tests = sample / unit, tests / unit
    near = distances(tests, sample)
    near[same] = np.inf
    k = min(k, int((~same).sum(axis=1).min()))
    if not k:
        return Grid(lines, shifts, unit, steps, len(steps), 0.0)
    best = np.argpartition(near, k - 1, axis=1)[:, :k]
    toward = sample[best] - tests[:, None]
    far = np.sqrt((toward**2).sum(axis=2, keepdims=True))
    last = far.max(axis=(1, 2))
    # directions in which neighbours lie; any for equal vectors
    toward = np.where(far > 0, toward, random.normal(size=toward.shape))
    toward /= np.sqrt((toward**2).sum(axis=2, keepdims=True))
    grids = []
    for reach in np.unique(np.quantile(last, (0.1, 0.25, 0.5, 0.75, 0.9, 0.97, 1.0), method="higher")):
        grid = Grid(lines, shifts, max(reach, 1e-300) * 1.8, steps, len(steps), reach)
        while True:
            found = np.bincount(grid.found(tests, toward * reach).ravel(), minlength=len(steps) + 1).cumsum()
            enough = np.flatnonzero(found[:-1] >= AIM * found[-1])
            if len(enough) or grid.width > 1e6 * reach:
                break
            grid.width *= 1.25
        if not len(enough):  # no width finds them
            continue
        grid.probes = int(enough[0]) + 1
        met = 0
        for t in range(TABLES):
            codes, probes = np.sort(code(grid.cells(sample, t)[0])), grid.probed(tests, t, grid.probes)
            met += (np.searchsorted(codes, probes, "right") - np.searchsorted(codes, probes)).sum()
        grid.cost = met / near.size + (last > reach).mean()
        grids.append(grid)
    grid = min(grids, key=lambda g: g.cost) if grids else Grid(lines, shifts, 1.0, steps, len(steps), 0.0, 1.0)
    grid.width, grid.reach = grid.width * unit, grid.reach * unit
    return grid


def nearest(
    vectors: DataFrame, every: int = 100, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The k nearest rows found for each query: query_id, rank from 1, the row's id, score.

    Queries are the rows whose id is divisible by ``every``; candidates are all other
    rows. score is the Euclidean distance in double precision, ties go to the smaller id.
    Vectors that are null, zero or hold null or non-finite components take no part, nor do
    rows with a null id or another length than the first query has. Of rows with equal ids
    the query skips all; a repeated query id is looked up once, by its least vector.
    """
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("vector"))
    rows = stored(rows.filter(F.col("id").isNotNull() & usable(F.col("vector"))), "vectors")
    queries = rows.filter(F.col("id") % every == 0).groupBy("id").agg(F.min("vector").alias("vector"))
    queries = stored(queries.select(F.col("id").alias("query"), "vector"), "queries")
    first = queries.orderBy("query").select(F.size("vector").alias("dim")).first()
    dim = first.dim if first else 0
    queries, rows = (df.filter(F.size("vector") == dim) for df in (queries, rows))
    # of equal vectors no more than the k + 1 smallest ids can be among the nearest
    number = F.row_number().over(W.partitionBy("vector").orderBy("id"))
    rows = stored(rows.distinct().withColumn("number", number).filter(F.col("number") <= k + 1).drop("number"), "rows")
    n = rows.count()
    if not n or first is None:
        return _ranked(rows.select(F.col("id").alias("query"), "id", F.lit(0.0).alias("score")).limit(0), k, id_col)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("id", "vector").toArrow()
    ids, vectors = sample.column("id").to_numpy(), matrix(sample.column("vector"))
    parts = max(1, -(-n // SPREAD))
    kind = rows.schema["vector"].dataType.simpleString()
    left, done = queries, []
    for turn in range(GRIDS):
        tests = left.orderBy(F.xxhash64("query"), "query").limit(TESTS).toArrow()
        if not len(tests):
            break
        same = tests.column("query").to_numpy()[:, None] == ids
        grid = fitted(vectors, matrix(tests.column("vector")), same, n, k)
        if turn and grid.cost >= 1:
            break
        placed = stored(rows.mapInArrow(_place(grid, parts), PLACED.format(kind)), "placed")
        asked = stored(left.mapInArrow(_ask(grid, parts), ASKED.format(kind)), "asked")
        found = stored(_ranked(_meet(placed, asked, k), k, id_col), "found")
        last = found.groupBy(F.col("query_id").alias("query")).agg(F.count("*").alias("n"), F.max("score").alias("last"))
        # those that found too little, or may have nearer rows in cells that they did not look into
        open_ = (F.coalesce("n", F.lit(0)) < min(k, n - 1)) | (F.col("last") > grid.reach)
        left = stored(left.join(last, "query", "left").filter(open_).select("query", "vector"), "left")
        done.append(found.join(left.select(F.col("query").alias("query_id")), "query_id", "left_anti").select(*found.columns))
        if left.count() <= BLOCK:
            break
    if not left.isEmpty():
        # over all rows, in blocks
        one = [F.lit(0).alias("table"), F.lit(0).alias("part")]
        whole = _meet(
            rows.select(*one, "id", "vector", F.lit(0).cast("long").alias("code")),
            left.select(*one, "query", "vector", F.array(F.lit(0).cast("long")).alias("codes")),
            k,
        )
        done.append(_ranked(whole, k, id_col))
    return reduce(DataFrame.union, done)


PLACED = "table int, part int, id long, vector {}, code long"
ASKED = "table int, part int, query long, vector {}, codes array<long>"


def _place(grid: Grid, parts: int):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                vectors = matrix(batch.column("vector"))
                for t in range(TABLES):
                    codes = code(grid.cells(vectors, t)[0])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(batch), t, np.int32)),
                            pa.array((codes.view(np.uint64) % np.uint64(parts)).astype(np.int32)),
                            batch.column("id").cast(pa.int64()),
                            batch.column("vector"),
                            pa.array(codes),
                        ],
                        names=["table", "part", "id", "vector", "code"],
                    )

    return place


def _ask(grid: Grid, parts: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 256):
                some = batch.slice(i, 256)
                vectors = matrix(some.column("vector"))
                for t in range(TABLES):
                    out = []  # (row, part, codes there)
                    for row, codes in enumerate(grid.probed(vectors, t, grid.probes)):
                        part = (codes.view(np.uint64) % np.uint64(parts)).astype(np.int32)
                        order = np.argsort(part, kind="stable")
                        own, edge = np.unique(part[order], return_index=True)
                        out += zip([row] * len(own), own, np.split(codes[order], edge[1:]))
                    at = pa.array([o[0] for o in out])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(out), t, np.int32)),
                            pa.array([o[1] for o in out], pa.int32()),
                            some.column("query").cast(pa.int64()).take(at),
                            some.column("vector").take(at),
                            pa.array([o[2] for o in out], pa.list_(pa.int64())),
                        ],
                        names=["table", "part", "query", "vector", "codes"],
                    )

    return ask


def _meet(placed: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """query, id, score: the best k of each query in each block of rows that it looks into."""
    at = ["table", "part"]

    def blocks(df, name):
        return df.groupBy(*at).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))

    sizes = stored(blocks(placed, "rows").join(blocks(asked, "queries"), at), "sizes")

    def block(df, key, own):
        return F.pmod(F.xxhash64(key), F.col(own)).cast("int")

    every = lambda own: F.explode(F.sequence(F.lit(0), F.col(own) - 1))
    none = F.lit(None)
    left = placed.join(sizes, at).withColumn("x", block(placed, "id", "rows")).withColumn("y", every("queries"))
    right = asked.join(sizes, at).withColumn("y", block(asked, "query", "queries")).withColumn("x", every("rows"))
    dealt = left.select(*at, "x", "y", "id", "vector", "code", none.cast("array<long>").alias("codes")).union(
        right.select(*at, "x", "y", F.col("query").alias("id"), "vector", none.cast("long").alias("code"), "codes")
    )

    def search(group: pa.Table) -> pa.Table:
        asks = group.column("codes").is_valid().to_numpy()
        q, r = group.filter(pa.array(asks)), group.filter(pa.array(~asks))
        if not len(q) or not len(r):
            return FOUND.empty_table()
        row, (codes, bucket) = r.column("id").to_numpy(), np.unique(r.column("code").to_numpy(), return_inverse=True)
        a, b = matrix(q.column("vector")), matrix(r.column("vector"))
        # a power of two as unit keeps squares finite and distances exact
        unit = 2.0 ** float(np.ceil(np.log2(max(np.abs(a).max(), np.abs(b).max()))))
        a, b, out = a / unit, b / unit, []
        for at in range(0, len(q), 256):
            some = q.slice(at, 256)
            probes = some.column("codes").combine_chunks()
            asker = np.repeat(np.arange(len(some)), np.diff(probes.offsets.to_numpy()))
            probes = probes.flatten().to_numpy()
            place = np.minimum(np.searchsorted(codes, probes), len(codes) - 1)
            looks = np.zeros((len(some), len(codes)), bool)
            there = codes[place] == probes
            looks[asker[there], place[there]] = True
            query, own = some.column("id").to_numpy(), a[at : at + 256]
            square = distances(own, b)
            square[~looks[:, bucket] | (query[:, None] == row)] = np.inf
            last = min(k, len(row)) - 1
            most = np.partition(square, last, axis=1)[:, last]
            i, j = np.nonzero((square <= most[:, None] + 1e-12 * len(b[0])) & (square < np.inf))
            score = np.sqrt(((b[j] - own[i]) ** 2).sum(axis=1)) * unit
            order = np.lexsort((row[j], score, i))
            i, j, score = i[order], j[order], score[order]
            best = np.arange(len(i)) - np.searchsorted(i, i) < k
            out.append(pa.table([pa.array(query[i[best]]), pa.array(row[j[best]]), pa.array(score[best])], FOUND))
        return pa.concat_tables(out)

    return dealt.groupBy(*at, "x", "y").applyInArrow(search, "query long, id long, score double")


FOUND = pa.schema([("query", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])


def _ranked(found: DataFrame, k: int, id_col: str) -> DataFrame:
    """The best k of each query; a row found in several tables counts once."""
    # rows with equal ids keep the nearest
    once = found.groupBy("query", "id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query").orderBy("score", "id"))
    return once.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        F.col("query").alias("query_id"), "rank", F.col("id").alias(id_col), "score"
    )
