"""Exact quantiles against sorting, and what the plan holds."""

import math
import random

import pytest

from shiftloom.operators import quantiles as q

WANTED = [0.0, 0.05, 0.25, 0.5, 0.95, 1.0]


def sorted_quantiles(values, wanted):
    values = sorted(v for v in values if v is not None and not math.isnan(v))
    out = {}
    for p in wanted:
        at = p * (len(values) - 1)
        a, b = values[math.floor(at)], values[math.ceil(at)]
        out[p] = a if a == b else a + (b - a) * (at - math.floor(at))
    return out


def check(spark, series, wanted=WANTED):
    rows = [(k, v) for k, vs in series.items() for v in vs]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "id string, v double").repartition(5)
    got = {(r.id, r.quantile): (r.n, r.value) for r in q.quantiles(df, "id", "v", wanted).collect()}
    expected = {}
    for k, vs in series.items():
        n = sum(v is not None and not math.isnan(v) for v in vs)
        if n:
            expected |= {(k, p): (n, v) for p, v in sorted_quantiles(vs, wanted).items()}
    assert got == expected


def test_against_sorting(spark):
    r = random.Random(1)
    check(
        spark,
        {
            "even": [r.uniform(0, 500) for _ in range(3000)],
            "wide": [r.choice((-1, 1)) * 10 ** r.uniform(-300, 300) for _ in range(2000)],
            "ties": [float(r.randint(0, 3)) for _ in range(1500)],
            "close": [1.0 + k * 2.0**-52 for k in range(1000)],
            "small": [5e-324 * k for k in range(50)],
            None: [r.gauss(0, 1) for _ in range(200)],
        },
    )


def test_nulls_nan_zeros_infinities_and_single_values(spark):
    check(
        spark,
        {
            "one": [7.5],
            "two": [1.0, 2.0],
            "holes": [None, math.nan, 3.0, None, 1.0],
            "nothing": [None, math.nan],
            "ends": [-math.inf, -1.0, 0.0, -0.0, 2.0, math.inf, math.inf],
        },
        [0.0, 0.5, 1.0],
    )


def test_empty_table_and_bad_quantiles(spark):
    empty = spark.createDataFrame([], "id string, v double")
    assert q.quantiles(empty, "id", "v", [0.5]).count() == 0
    with pytest.raises(ValueError):
        q.quantiles(empty, "id", "v", [1.5])
    with pytest.raises(ValueError):
        q.quantiles(empty, "id", "v", [])


def test_rounds_are_few_and_no_window_is_over_a_series(spark, monkeypatch):
    labels, plans = [], []
    stored = q._stored

    def noted(df, label):
        labels.append(label)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, label)

    monkeypatch.setattr(q, "_stored", noted)
    r = random.Random(2)
    rows = [("hot" if k % 3 else "b", r.lognormvariate(0, 9)) for k in range(20_000)]
    q.quantiles(spark.createDataFrame(rows, "id string, v double"), "id", "v", [0.1, 0.5]).collect()
    assert labels.count("ranks") <= 6
    # only counted bins are ordered, never rows
    windows = [line for p in plans for line in p.splitlines() if " Window [" in line]
    assert windows and all("sum(_n" in line for line in windows)
    assert all("CartesianProduct" not in p and "NestedLoop" not in p for p in plans)
