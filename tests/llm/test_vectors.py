import numpy as np
import pytest

from shiftloom.llm import vectors


def brute(rows, least):
    """Cosines of all pairs."""
    ids = [i for i, _ in rows]

    def fine(v):
        return v is not None and None not in v and np.isfinite(np.array(v, float)).all() and any(v)

    n = len(rows)
    link = [set() for _ in rows]
    for a in range(n):
        for b in range(n):
            x, y = rows[a][1], rows[b][1]
            if a != b and None not in (ids[a], ids[b]) and fine(x) and fine(y) and len(x) == len(y):
                x, y = (np.array(v, float) / max(map(abs, v)) for v in (x, y))
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                    link[a].add(b)
    label = list(ids)
    for _ in range(n):
        for a in range(n):
            for b in link[a]:
                label[a] = label[b] = min(label[a], label[b])
    return sorted((i or -1, len(s), c or -1, i is None or c == i) for i, s, c in zip(ids, link, label))


@pytest.mark.parametrize("cell,block", [(2000, 1024), (20, 16), (40, 1024)])
def test_matches_all_pairs(spark, monkeypatch, cell, block):
    monkeypatch.setattr(vectors, "CELL", cell)
    monkeypatch.setattr(vectors, "BLOCK", block)
    r = np.random.default_rng(cell)
    base = r.normal(size=(30, 6))
    rows = [list(map(float, b + r.normal(size=6) * s)) for b in base for s in r.choice([0.05, 0.2, 0.5, 1], 6)]
    rows += [rows[0], rows[0], [2 * x for x in rows[3]], [0.0] * 6, None, [None] + [1.0] * 5, [float("nan")] + [1.0] * 5]
    rows += [[1.0, 2.0], [1.0, 2.1], [-1.0, 2.0], [float("inf")] * 6, [1e300, 1e300], [1e-300, 1e-300]]
    ids = [int(k) for k in r.permutation(len(rows))]
    pairs = [*zip(ids, rows), (None, rows[0]), (5, rows[1]), (5, rows[2])]
    df = spark.createDataFrame([(i, v, "x") for i, v in pairs], "vec_id long, embedding array<double>, key string")
    got = vectors.near_vectors(df, 0.95).collect()
    clean = lambda x: -1 if x is None else x
    assert sorted((clean(x[0]), x[1], clean(x[2]), x[3]) for x in got) == [
        (-1 if k == -1 else k, *rest) for k, *rest in map(tuple, brute_clean(pairs))
    ]


def brute_clean(pairs):
    moved = [(None if i is None else i + 1, v) for i, v in pairs]
    return [(i - 1 if i > 0 else -1, n, c - 1 if c > 0 else -1, k) for i, n, c, k in brute(moved, 0.95)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vectors.near_vectors(df).count() == 0
