"""Running sums by ranges against one ordered pass, and what the plan holds."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shiftloom.operators.prefix import running_sums
from shiftloom.operators.stops import share_of_all


def order():
    return [F.desc_nulls_last("v"), F.asc("id")]


def expected(rows):
    """By plain addition in order: id -> (running, total)."""
    counted = [(i, v, Decimal(0) if v is None else Decimal(v)) for i, v in rows]
    ordered = sorted(counted, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    total, so_far, out = sum((a for *_, a in counted), Decimal(0)), Decimal(0), {}
    for i, _, amount in ordered:
        so_far += amount
        out[i] = (so_far, total)
    return out


def summed(spark, rows, parts, kind="long"):
    df = spark.createDataFrame(rows, f"id long, v {kind}").repartition(3)
    got = running_sums(df, order(), "v", "run", "total", parts).collect()
    assert len(got) == len(rows)
    return {r.id: (r.run, r.total) for r in got}


@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_equal_to_one_pass(spark, parts):
    r = random.Random(parts)
    rows = [(i, r.choice([None, 0, 5, r.randrange(-50, 10**6)])) for i in range(500)]
    assert summed(spark, rows, parts) == expected(rows)


def test_a_value_on_most_rows_is_split_by_the_tie_break(spark):
    rows = [(i, 9 if i % 10 else i) for i in range(400)]
    assert summed(spark, rows, 8) == expected(rows)


def test_one_row_nulls_and_no_rows(spark):
    assert summed(spark, [(1, 4)], 5) == {1: (4, 4)}
    assert summed(spark, [(1, None), (2, None)], 5) == {1: (0, 0), 2: (0, 0)}
    assert summed(spark, [], 5) == {}


def test_sums_beyond_28_digits_stay_exact(spark):
    big = 2 * 10**17
    rows = [(i, big + i) for i in range(30)]
    assert summed(spark, rows, 6) == expected(rows)
    small = spark.createDataFrame([(1, 1e17), (2, 1e-9), (3, float("nan")), (4, float("inf"))], "id long, v double")
    got = {r.id: r.run for r in running_sums(small, [F.asc("id")], "v", "run", "total", 4).collect()}
    assert got[2] == Decimal("100000000000000000.0000000010") == got[3] == got[4]


def test_no_single_partition(spark):
    df = spark.range(100).select("id", (F.col("id") * 3).alias("v"))
    plan = running_sums(df, order(), "v", "run", "total", 4)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" in plan


def test_shares_of_all_reasons(spark):
    kind = "TypeName string, MotiveName string, StoppageType string, Type string, seconds long, timed long, events long"
    rows = [("t", "a", "NP", "NP", 600, 1, 1), ("t", "b", None, "P", 300, 1, 2), (None, None, None, "P", 100, 1, 1), ("t", "c", "P", "P", None, 0, 4)]
    got = {r.Motivo_Particular: (r.Pct_Total, r.Pct_Acumulado) for r in share_of_all(spark.createDataFrame(rows, kind), 3).collect()}
    assert got == {"a": (60.0, 60.0), "b": (30.0, 90.0), "Sin Clasificar": (10.0, 100.0), "c": (0.0, 100.0)}
    untimed = share_of_all(spark.createDataFrame(rows[3:], kind), 3).collect()
    assert [(r.Pct_Total, r.Pct_Acumulado) for r in untimed] == [(0.0, 0.0)]
