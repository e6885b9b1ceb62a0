"""Retention by months against the plain rule, and which files it touches."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shiftloom.operators.conversations import retention
from shiftloom.sources import retention as months

NOW = datetime(2026, 3, 20, 12)
LIMIT = NOW - timedelta(days=30)  # 18 February


def tables(spark):
    begun = [datetime(2025, 11, 3), datetime(2026, 1, 31, 23), datetime(2026, 2, 1), LIMIT - timedelta(seconds=1), LIMIT,
             datetime(2026, 2, 28), datetime(2026, 3, 1), None]
    threads = spark.createDataFrame([(f"t{k}", at) for k, at in enumerate(begun)], "thread_id string, created_at timestamp_ntz")
    rows = [(f"t{k % 8}", k, NOW, f"text {k}") for k in range(40)] + [("unknown", 1, NOW, "a"), (None, 1, datetime(2020, 1, 1), None)]
    return threads, spark.createDataFrame(rows, "thread_id string, turn int, created_at timestamp_ntz, text string")


def files(path):
    found = {}
    for folder, _, names in os.walk(path):
        for name in names:
            if name.endswith(".parquet"):
                full = os.path.join(folder, name)
                found[full] = os.stat(full).st_mtime_ns
    return found


def content(spark, path):
    schema = tables(spark)[path.endswith("messages")].schema
    return sorted((tuple(r) for r in months.read_months(spark, path, schema).drop("Month").collect()), key=repr)


@pytest.fixture
def stored(spark, tmp_path):
    threads, messages = tables(spark)
    paths = str(tmp_path / "threads"), str(tmp_path / "messages")
    months.write_months(threads, messages, *paths)
    kept = retention(threads, messages, F.lit(NOW).cast("timestamp_ntz"))
    return paths, [sorted((tuple(r) for r in df.select(*a.columns).collect()), key=repr) for df, a in zip(kept, (threads, messages))]


def test_rows_that_stay_and_files_that_are_left_alone(spark, stored):
    paths, expected = stored
    before = [files(p) for p in paths]
    assert months.expire(spark, *paths, NOW) == ["2025-11", "2026-01", "2026-02"]
    assert [content(spark, p) for p in paths] == expected
    for path, old in zip(paths, before):
        new = files(path)
        for month in ("2026-03", months.NO_MONTH):
            same = {f: t for f, t in old.items() if f"Month={month}/" in f}
            assert same and same == {f: t for f, t in new.items() if f"Month={month}/" in f}
        assert not any("Month=2025-11" in f or "Month=2026-01" in f for f in new)
    # nothing is left to do
    again = [files(p) for p in paths]
    assert months.expire(spark, *paths, NOW) == []
    assert [files(p) for p in paths] == again


@pytest.mark.parametrize("broken", range(5))
def test_a_run_that_fails_is_completed_by_the_next(spark, stored, monkeypatch, broken):
    paths, expected = stored
    left = [broken]

    def failing(real):
        def run(*args):
            if left[0] == 0:
                raise OSError("lost")
            left[0] -= 1
            return real(*args)

        return run

    with monkeypatch.context() as m:
        m.setattr(months, "_write", failing(months._write))
        m.setattr(months, "_delete", failing(months._delete))
        with pytest.raises(OSError):
            months.expire(spark, *paths, NOW)
    months.expire(spark, *paths, NOW)
    assert [content(spark, p) for p in paths] == expected


def test_a_month_that_nothing_stays_of(spark, stored):
    paths, _ = stored
    months.expire(spark, *paths, datetime(2026, 4, 30))
    assert {r[0] for r in content(spark, paths[0])} == {"t7"}
    assert {r[0] for r in content(spark, paths[1])} == {"t7", "unknown", None}


def test_empty_tables_and_tables_that_nothing_stays_of(spark, tmp_path):
    threads, messages = tables(spark)
    begun = threads.where("created_at IS NOT NULL")
    own = messages.join(begun, "thread_id", "left_semi")
    for name, rows in (("a", (threads.limit(0), messages.limit(0))), ("b", (begun, own)), ("c", (begun, own.limit(0)))):
        paths = str(tmp_path / f"{name}-threads"), str(tmp_path / f"{name}-messages")
        months.write_months(*rows, *paths)
        months.expire(spark, *paths, datetime(2027, 1, 1))
        assert [content(spark, p) for p in paths] == [[], []]
