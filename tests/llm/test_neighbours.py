import numpy as np
import pytest

from shiftloom.llm import neighbours


def brute(pairs, every, k):
    """All distances; rows that take part only."""

    def fine(v):
        return v is not None and None not in v and np.isfinite(np.array(v, float)).all() and any(v)

    rows = [(i, np.array(v, float)) for i, v in pairs if i is not None and fine(v)]
    out = {}
    for q, a in rows:
        if q % every == 0:
            near = sorted((float(np.sqrt(((a - b) ** 2).sum())), i) for i, b in rows if i != q)[:k]
            out[q] = near
    return out


def answers(df):
    out = {}
    for x in sorted(df.collect(), key=lambda x: (x.query_id, x.rank)):
        out.setdefault(x.query_id, []).append((x.score, x.vec_id))
        assert x.rank == len(out[x.query_id])
    return out


@pytest.mark.parametrize("block,spread", [(4096, 2048), (64, 100)])
def test_recall_order_and_scores(spark, monkeypatch, block, spread):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    monkeypatch.setattr(neighbours, "SPREAD", spread)
    r = np.random.default_rng(3)
    centre = r.normal(size=(20, 12))
    vectors = [list(map(float, c + r.normal(size=12) * 0.3)) for c in centre for _ in range(60)]
    vectors += [vectors[5]] * 40 + [[0.0] * 12, None, [None] + [1.0] * 11, [float("inf")] * 12]
    pairs = list(zip(map(int, r.permutation(len(vectors))), vectors)) + [(None, vectors[0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in pairs], "vec_id long, embedding array<double>, code string")
    want, got = brute(pairs, 50, 10), answers(neighbours.nearest(df, every=50, k=10))
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    hits = [len({i for _, i in got[q]} & {i for _, i in want[q]}) / 10 for q in want]
    assert np.mean(hits) >= 0.9
    true = dict(pairs)
    for q, found in got.items():
        assert found == sorted(found)
        for score, i in found:
            assert score == pytest.approx(float(np.linalg.norm(np.array(true[q]) - np.array(true[i]))), rel=1e-12)


def test_few_rows_give_all_others(spark):
    pairs = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [50.0, 1e9]), (100, [1.0, 0.0]), (3, [1.0])]
    df = spark.createDataFrame(pairs, "vec_id long, embedding array<double>")
    assert answers(neighbours.nearest(df)) == brute(pairs[:4], 100, 10)


def test_no_rows_and_no_queries(spark):
    kind = "vec_id long, embedding array<float>"
    assert neighbours.nearest(spark.createDataFrame([], kind)).count() == 0
    assert neighbours.nearest(spark.createDataFrame([(1, [1.0])], kind)).count() == 0
    assert neighbours.nearest(spark.createDataFrame([(100, [1.0])], kind)).count() == 0


@pytest.mark.parametrize("block", [4096, 16])
def test_isolated_queries_among_groups_of_near_copies(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    r = np.random.default_rng(5)
    copies = [c + r.normal(size=24) * 0.2 for c in r.normal(size=(20, 24)) for _ in range(120)]
    alone = list(r.normal(size=(1_600, 24)))
    vectors = [list(map(float, v)) for v in copies + alone]
    pairs = list(zip(map(int, r.permutation(len(vectors))), vectors))
    df = spark.createDataFrame(pairs, "vec_id long, embedding array<double>")
    want, got = brute(pairs, 20, 10), answers(neighbours.nearest(df, every=20, k=10))
    place = {i: at for at, (i, _) in enumerate(pairs)}
    hits = {q: len({i for _, i in got[q]} & {i for _, i in want[q]}) / 10 for q in want}
    for mine in ([q for q in want if place[q] < len(copies)], [q for q in want if place[q] >= len(copies)]):
        assert np.mean([hits[q] for q in mine]) >= neighbours.AIM - 0.02
