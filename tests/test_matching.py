"""Requests for sensors against one look-up after the other."""

import random

import pytest

from shiftloom.operators import matching
from shiftloom.operators.catalog import find_sensor

WORDS = ["red", "ring", "Molino", "presión", "iqf", "agua", "seven", "bolt"]


def catalog_of(spark, n=40):
    r = random.Random(4)
    rows = []
    for k in range(n):
        name = " ".join(r.choice(WORDS[: 2 + k % 7]) for _ in range(r.randint(1, 4)))
        device = r.choice([None, "", "IQF", "red line"])
        rows.append((f"v-{k}", name if k % 9 else None, device, None, None, None, None, None, k % 3 == 0, k % 8 != 7))
    names = ["ProductionLineControlVariableId", "Name", "DeviceName", "Tag", "MinValue", "MaxValue", "CriticalMinValue",
             "CriticalMaxValue", "IsCritical", "Active"]
    kinds = "string, string, string, string, double, double, double, double, boolean, boolean".split(", ")
    return spark.createDataFrame(rows, ", ".join(f"{a} {b}" for a, b in zip(names, kinds)))


def test_equals_one_request_after_the_other(spark):
    catalog = catalog_of(spark).coalesce(1).cache()
    r = random.Random(5)
    texts = [" ".join(r.choice(WORDS + ["zzz"]) for _ in range(r.randint(1, 6))) for _ in range(12)]
    texts += ["\tV-3\n", " v-7 ", "v-8", "red RED red", "zzz", "", " ", "PRESIÓN del agua!", "v 8"]
    rows = [(k, t) for k, t in enumerate(texts)] + [(100, None), (101, texts[0]), (102, "red")]
    got = {
        r.k: (r.var_id, r.name, r.device, r.exact, r.score)
        for r in matching.find_sensors(catalog, spark.createDataFrame(rows, "k int, text string")).collect()
    }
    expected = {}
    for k, text in rows:
        for s in find_sensor(catalog, text).collect() if text is not None else []:
            expected[k] = (s.var_id, s.name, s.device, s.exact, s.score)
    assert got == expected


def test_empty_sides_and_clashing_columns(spark):
    catalog = catalog_of(spark, 5)
    none = spark.createDataFrame([], "k int, text string")
    some = spark.createDataFrame([(1, "red")], "k int, text string")
    assert matching.find_sensors(catalog, none).count() == 0
    assert matching.find_sensors(catalog.limit(0), some).count() == 0
    with pytest.raises(ValueError):
        matching.find_sensors(catalog, some.withColumn("name", some.text))


def test_plan_has_no_cross_join(spark):
    requests = spark.createDataFrame([(1, "red")], "k int, text string")
    plan = matching.find_sensors(catalog_of(spark, 5), requests)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
