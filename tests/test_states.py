"""Stored daily states against the direct summary, and what a refresh reads and replaces."""

import glob
import os
import random
from datetime import date, datetime, timedelta

from shiftloom.operators import sensors, states
from shiftloom.schemas import schema_of
from shiftloom.sources import reads as rd

FIRST = date(2026, 1, 5)


def reads(spark, days, seed=0, n=60):
    pick = random.Random(seed)
    rows = []
    for day in days:
        for k in range(n):
            t = datetime.combine(FIRST + timedelta(days=day), datetime.min.time()) + timedelta(minutes=9 * k)
            value = None if pick.random() < 0.1 else round(pick.uniform(0, 120), 3)
            sensor = None if pick.random() < 0.05 else pick.choice(["Var-1", "VAR-1", "var-2", "v3"])
            rows.append((sensor, 1, seed * 1000 + k, t, value, 0.0, 400.0, pick.choice([None, 5.0]), 100.0, t.date(), "Primer"))
    return spark.createDataFrame(rows, schema_of("reads"))


def catalog(spark):
    return spark.createDataFrame([("VAR-1", "Temperatura", "IQF", None, None, None, 5.0, 100.0, True, True)], schema_of("catalog"))


def files(target):
    return {f for f in glob.glob(f"{target}/Day=*/*.parquet")}


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def day(k):
    return (FIRST + timedelta(days=k)).isoformat()


def test_refresh_reads_and_replaces_changed_days_only(spark, tmp_path):
    path, target = str(tmp_path / "reads"), str(tmp_path / "states")
    rd.write_reads(reads(spark, range(6)), path)
    cat = catalog(spark)

    def same(first=None, last=None):
        stored = states.stored_states(spark, target)
        assert rows_of(states.merged(stored, cat, first, last)) == rows_of(sensors.summary(rd.load_reads(spark, path, first, last), cat))

    assert states.stored_states(spark, target) is None
    assert states.refresh(spark, path, target) == [day(k) for k in range(6)]
    same()
    same(day(1), day(3))
    before = files(target)
    assert states.refresh(spark, path, target) == []
    assert files(target) == before

    more = reads(spark, [2], seed=7, n=20).withColumn("SensorKey", rd.sensor_key(states.F.col("ProductionLineControlVariableId")))
    more.write.mode("append").partitionBy("Day", "Shift").parquet(path)
    assert states.refresh(spark, path, target) == [day(2)]
    kept = {f for f in before if f"Day={day(2)}" not in f}
    assert kept <= files(target) and len(files(target) - kept) == len(files(target)) - len(kept)
    assert not {f for f in before if f"Day={day(2)}" in f} & files(target)
    same()
    same(day(2), day(2))


def test_days_whose_files_are_gone(spark, tmp_path):
    path, target = str(tmp_path / "reads"), str(tmp_path / "states")
    rd.write_reads(reads(spark, range(3)), path)
    states.refresh(spark, path, target)
    for name in glob.glob(f"{path}/Day={day(1)}/*/*"):
        os.unlink(name)
    for name in glob.glob(f"{path}/Day={day(1)}/*/.*.crc"):
        os.unlink(name)
    assert states.refresh(spark, path, target) == [day(1)]
    assert states.refresh(spark, path, target) == []
    stored = states.stored_states(spark, target)
    assert stored.where(f"Day = '{day(1)}' AND mark IS NULL").count() == 0
    left = rd.load_reads(spark, path).where(f"Day <> '{day(1)}'")
    assert rows_of(states.merged(stored, catalog(spark))) == rows_of(sensors.summary(left, catalog(spark)))


def test_a_refresh_that_lost_a_partition_is_mended(spark, tmp_path):
    path, target = str(tmp_path / "reads"), str(tmp_path / "states")
    rd.write_reads(reads(spark, range(3)), path)
    states.refresh(spark, path, target)
    for name in glob.glob(f"{target}/Day={day(0)}/*") + glob.glob(f"{target}/Day={day(0)}/.*.crc"):
        os.unlink(name)
    assert states.refresh(spark, path, target) == [day(0)]


def test_a_range_scans_no_raw_reads(spark, tmp_path):
    path, target = str(tmp_path / "reads"), str(tmp_path / "states")
    rd.write_reads(reads(spark, range(3)), path)
    states.refresh(spark, path, target)
    plan = states.merged(states.stored_states(spark, target), catalog(spark), day(1), day(1))._jdf.queryExecution().executedPlan().toString()
    assert "/reads" not in plan and "PartitionFilters: [isnotnull(Day" in plan
    marks = states.file_marks(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in marks
