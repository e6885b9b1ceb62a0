"""Runs counted on a stream against the batch counts, over replayed files and a restart."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_intervals import frame, interval

from shiftloom.operators import intervals as ops
from shiftloom.streaming import live, runs

ZERO = datetime(2026, 2, 12, 0)
STORE = "spark.sql.streaming.stateStore.providerClass"


@pytest.fixture
def stored(spark):
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, runs.STORE)
    yield spark
    spark.conf.unset(STORE) if before is None else spark.conf.set(STORE, before)


def seen(seed=0, n=240):
    """Intervals every ten minutes of two lines over a day and a half, some up to an hour out of order."""
    pick = random.Random(seed)
    rows = [
        interval(1 + k % 2, ZERO + timedelta(minutes=10 * k + pick.randrange(10)), k, pick.choice(["US", " SS", "AV", "US"]))
        for k in range(n)
    ]
    order = sorted(range(n), key=lambda k: k + pick.randrange(6))
    return [rows[k] for k in order]


def batch_counts(spark, rows):
    spans = runs.with_shift(frame(spark, rows).withColumn("t", F.col("IntervalBegin").cast("timestamp")), "t")
    spans = spans.select("ProductionLineId", "shift_start", "shift_end").distinct()
    ends = {c: F.timestamp_micros(a).cast("timestamp_ntz") for c, a in (("_from", "shift_start"), ("_to", "shift_end"))}
    found = ops.in_spans(frame(spark, rows), spans.withColumns(ends))
    counted = ops.count_runs(found, ["ProductionLineId", "shift_start"])
    return {(r[0], r[1]): (r.ParosNoProgramadosCont, r.ParosProgramadosCont) for r in counted.collect()}


def streamed(spark, target):
    out = runs.read_runs(spark, target).withColumn("at", F.unix_micros("shift_start")).collect()
    return {(r.ProductionLineId, r.at): (r.np_runs, r.p_runs) for r in out}, {(r.ProductionLineId, r.at): r.final for r in out}


def replay(spark, folder, pieces, tmp_path):
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "mark")
    for piece in pieces:
        frame(spark, piece).coalesce(1).write.mode("append").parquet(folder)
        query = runs.start_runs(live.stream_intervals(spark, folder, 1), target, checkpoint, "2 hours", available_now=True)
        query.awaitTermination(120)
        assert query.exception() is None
    return target


def test_replayed_files_and_restarts_give_the_batch_counts(stored, tmp_path):
    rows = seen()
    pieces = [rows[k : k + 60] for k in range(0, len(rows), 60)]
    target = replay(stored, str(tmp_path / "in"), pieces, tmp_path)
    counts, final = streamed(stored, target)
    assert counts == batch_counts(stored, rows)
    starts = sorted({at for _, at in final})
    # the shifts that ended before the newest row less the delay are final, the last one is not
    assert all(final[line, at] for line, at in final if at in starts[:-2]) and not any(final[line, starts[-1]] for line in (1, 2))


def test_rows_behind_the_watermark_are_left_out(stored, tmp_path):
    first = [interval(1, ZERO + timedelta(hours=7, minutes=m), m, "US" if m % 2 else "AV") for m in range(10)]
    later = [interval(1, ZERO + timedelta(hours=30), 50, "AV")]
    late = [interval(1, ZERO + timedelta(hours=7, minutes=30), 60, "SS"), interval(1, ZERO + timedelta(hours=30, minutes=1), 61, "SS")]
    target = replay(stored, str(tmp_path / "in"), [first, later, late], tmp_path)
    counts, final = streamed(stored, target)
    want = batch_counts(stored, first + later + late[1:])
    assert counts == want and sum(final.values()) == 1


def test_shift_bounds(spark):
    rows = [(datetime(2026, 2, 12, h, m),) for h, m in ((6, 59), (7, 0), (15, 29), (15, 30), (22, 59), (23, 0), (0, 0))]
    df = spark.createDataFrame(rows, "t timestamp_ntz").select(F.col("t").cast("timestamp"))
    out = runs.with_shift(df, "t").select((F.col("shift_start") / 3.6e9 % 24).alias("a"), ((F.col("shift_end") - F.col("shift_start")) / 3.6e9).alias("n"))
    assert [tuple(r) for r in out.collect()] == [(23, 8), (7, 8.5), (7, 8.5), (15.5, 7.5), (15.5, 7.5), (23, 8), (23, 8)]
    assert runs.with_shift(df, "t", ((420, 930),)).count() == 2
