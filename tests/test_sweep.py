"""Points in spans by a sweep, against the bucketed join and against looking at every pair."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from test_intervals import frame, interval

from shiftloom.operators import intervals as ops
from shiftloom.operators import sweep

ZERO = datetime(2026, 2, 12, 7)


def at(minutes):
    return None if minutes is None else ZERO + timedelta(minutes=minutes)


def run(spark, points, spans, **more):
    p = spark.createDataFrame([(ln, at(t), n) for ln, t, n in points], "line int, t timestamp_ntz, n int")
    s = spark.createDataFrame([(ln, at(a), at(b), k) for ln, a, b, k in spans], "line int, _from timestamp_ntz, _to timestamp_ntz, k string")
    return sweep.within(p, s, "line", "t", ["k"], **more)


def rows_of(df):
    return sorted((r.line, r.n, r.k) for r in df.collect())


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("width", [60, 3600])
def test_points_in_spans(spark, seed, width):
    pick = random.Random(seed)
    spans, points = [], []
    for line in (1, 1, 1, 2, 3):
        t = 0 if not [s for s in spans if s[0] == line] else max(s[2] for s in spans if s[0] == line)
        for _ in range(6):
            a = t + pick.choice([0, 0, 5, 400])
            t = a + pick.choice([0, 1, 30, 60, 2000, 90_000])
            spans.append((line, a, t, None if pick.random() < 0.1 else f"{line}/{a}"))
    ends = [x for s in spans for x in s[1:3]]
    for n in range(400):
        points.append((pick.choice([1, 1, 2, 3, 4, None]), pick.choice([*ends, pick.randrange(200_000), None]), n))
    want = sorted(
        (ln, n, k) for ln, t, n in points if t is not None for sl, a, b, k in spans if sl == ln and a <= t < b
    ) if all(s[3] for s in spans) else None
    got = [(r.line, r.n, r.k) for r in run(spark, points, spans, width=width).collect()]
    if want is None:
        want = [(ln, n, k) for ln, t, n in points if t is not None for sl, a, b, k in spans if sl == ln and a <= t < b]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_overlapping_spans_are_an_error(spark):
    with pytest.raises(PySparkException, match="overlap on line 7"):
        rows_of(run(spark, [(7, 5, 1)], [(7, 0, 500, "a"), (7, 400, 900, "b")]))
    with pytest.raises(PySparkException, match="overlap on line 7"):
        rows_of(run(spark, [(7, 5, 1)], [(7, 0, 5, "a"), (7, 0, 5, "b")]))
    assert rows_of(run(spark, [(7, 5, 1)], [(7, 0, 5, "a"), (7, 5, 9, "b"), (8, 0, 9, "c")])) == [(7, 1, "b")]


def test_empty_sides(spark):
    assert rows_of(run(spark, [], [(1, 0, 5, "a")])) == []
    assert rows_of(run(spark, [(1, 0, 1)], [])) == []


def test_same_rows_as_the_bucketed_join(spark):
    pick = random.Random(9)
    seen = [interval(pick.choice([1, 1, 1, 2]), at(pick.randrange(5_000)), n, pick.choice(["US", " SS ", "AV"])) for n in range(300)]
    intervals = frame(spark, seen)
    shifts = [(n, ln, at(n * 480), at(n * 480 + 480) if n != 4 else None) for n in range(9) for ln in (1, 2)]
    shifts = spark.createDataFrame(shifts, "WorkShiftExecutionId int, ProductionLineId int, StartDate timestamp_ntz, EndDate timestamp_ntz")
    for hours in (0, 6):
        ahead = F.expr(f"INTERVAL '{hours}' HOUR")
        a, b = ops.in_execution(intervals, shifts, hours), sweep.in_execution(intervals, shifts, ahead)
        assert sorted(a.columns) == sorted(b.columns)
        assert sorted(map(tuple, a.select(*sorted(a.columns)).collect())) == sorted(map(tuple, b.select(*sorted(a.columns)).collect()))


def test_no_row_is_multiplied(spark):
    plan = run(spark, [(1, 0, 1)], [(1, 0, 5_000_000, "years")])._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "NestedLoop" not in plan
