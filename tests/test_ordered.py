"""Two-level ordered operations against brute force, with one series holding a third of the rows or more."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shiftloom.operators.ordered import begun_runs, next_value, row_numbers, runs, time_bucket

START = datetime(2024, 1, 1)


def series(seed: int, n: int = 400, hot: float = 0.4):
    """Rows (line, t, seq, state) with gaps of hours, bursts within an hour, and equal times."""
    rng = random.Random(seed)
    rows, clock = [], {}
    for seq in range(n):
        line = 0 if rng.random() < hot else rng.randrange(1, 5)
        step = rng.choice([0, 1, 60, 900, 3600, 7200, 40000])
        clock[line] = clock.get(line, START) + timedelta(seconds=step)
        rows.append((line, clock[line], seq, rng.random() < 0.5))
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "line int, t timestamp_ntz, seq int, state boolean")


def by_line(rows):
    out = {}
    for row in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        out.setdefault(row[0], []).append(row)
    return out


# Seconds per bucket: hours, minutes and seconds are all put to use.
SIZES = [3600, 60, 1]


@pytest.mark.parametrize("size", SIZES)
@pytest.mark.parametrize("seed", range(2))
def test_runs(spark, seed, size):
    rows = series(seed)
    expected = []
    for line, items in by_line(rows).items():
        current = None
        for _, t, _, state in items:
            if state:
                current = [t, t, 0] if current is None else current
                current[1], current[2] = t, current[2] + 1
            elif current:
                expected.append((line, *current))
                current = None
        if current:
            expected.append((line, *current))
    got = [tuple(r) for r in runs(frame(spark, rows), ["line"], "t", "seq", "state", size).select("line", "t0", "t1", "n").collect()]
    assert sorted(got) == sorted(expected)


@pytest.mark.parametrize("seed, size", enumerate(SIZES))
def test_next_value(spark, seed, size):
    rows = series(seed)
    expected = []
    for items in by_line(rows).values():
        for here, after in zip(items, [*items[1:], None]):
            expected.append((here[2], after[1] if after else None))
    out = next_value(frame(spark, rows), ["line"], "t", "seq", "t", "after", size).select("seq", "after")
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("seed, size", enumerate(SIZES))
def test_row_numbers(spark, seed, size):
    rows = series(seed)
    expected = sorted((r[2], i) for items in by_line(rows).values() for i, r in enumerate(items, start=1))
    out = row_numbers(frame(spark, rows), ["line"], "t", "seq", "n", size).select("seq", "n")
    assert sorted(tuple(r) for r in out.collect()) == expected


def test_run_over_a_whole_day_is_one(spark):
    rows = [(1, START + timedelta(minutes=10 * i), i, True) for i in range(200)]
    out = runs(frame(spark, rows), ["line"], "t", "seq", "state").collect()
    assert [(r.t0, r.t1, r.n) for r in out] == [(rows[0][1], rows[-1][1], 200)]


def test_no_true_rows(spark):
    rows = [(1, START, 0, False)]
    assert runs(frame(spark, rows), ["line"], "t", "seq", "state").count() == 0
    assert frame(spark, rows).where(F.col("state")).count() == 0


@pytest.mark.parametrize("seed, size", enumerate(SIZES))
def test_begun_runs(spark, seed, size):
    rows = series(seed)
    expected = []
    for line, items in by_line(rows).items():
        states = [r[3] for r in items]
        begun = [sum(s == want and (i == 0 or states[i - 1] != want) for i, s in enumerate(states)) for want in (True, False)]
        expected.append((line, *begun))
    df = frame(spark, rows)
    df = df.withColumn("b", time_bucket("t", size))
    out = begun_runs(df, ["line"], "b", "t", "seq", {"on": F.col("state"), "off": ~F.col("state")})
    assert sorted(tuple(r) for r in out.select("line", "on", "off").collect()) == sorted(expected)


def test_bucket_width_is_an_argument(spark):
    rows = [(1, START + timedelta(seconds=20 * k), k, True) for k in range(180)]
    df = frame(spark, rows)
    counts = [df.select(time_bucket("t", width).alias("b")).distinct().count() for width in (3600, 60, 1)]
    assert counts == [1, 60, 180]


def test_null_series_and_times_keep_their_rows(spark):
    rows = [(1, START, 1, True), (1, None, 2, True), (None, START, 3, True), (None, None, 4, False)]
    out = row_numbers(frame(spark, rows), ["line"], "t", "seq", "n").select("seq", "n").collect()
    assert sorted(map(tuple, out)) == [(1, 2), (2, 1), (3, 2), (4, 1)]
