import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shiftloom.operators import catalog as cat
from shiftloom.operators import sensors
from shiftloom.schemas import schema_of

START = datetime(2026, 1, 5, 7)


def catalog(spark):
    rows = [
        ("AAA-1", "Temperatura Interna", "IQF", "t1", 0.0, 10.0, 1.0, 9.0, True, True),
        ("bbb-2", "Temperatura del agua", "Chiller", None, None, None, None, None, True, True),
        ("ccc-3", "Alertas", "Detector", None, 0.0, 1.0, 0.0, 1.0, False, True),
        ("ddd-4", "Vieja", "IQF", None, 0.0, 1.0, 0.0, 1.0, True, False),
    ]
    return spark.createDataFrame(rows, schema_of("catalog"))


def reads(spark, rows):
    """Rows are (id, value, low, high)."""
    return spark.createDataFrame(
        [
            (v, 1, i, START + timedelta(minutes=i), x, None, None, lo, hi, date(2026, 1, 5), "Primer")
            for i, (v, x, lo, hi) in enumerate(rows)
        ],
        schema_of("reads"),
    )


def test_summary_counts_and_names(spark):
    rows = [("AAA-1", 5.0, 1.0, 9.0), ("aaa-1", 10.0, 1.0, 9.0), ("AAA-1", None, 1.0, 9.0), ("AAA-1", 0.5, None, 9.0)]
    rows += [("zzz", 3.0, 4.0, None), ("yyy", None, 1.0, 2.0)]
    out = {r.var_id: r for r in sensors.summary(reads(spark, rows), catalog(spark)).collect()}
    a = out["aaa-1"]
    assert (a.points, a.out_points, a.out_pct, a.name, a.device) == (3, 1, 33.33, "Temperatura Interna", "IQF")
    assert (a.avg_value, a.min_value, a.max_value) == (5.167, 0.5, 10.0)
    assert (out["zzz"].name, out["zzz"].device, out["zzz"].out_pct) == ("zzz", "", 100.0)
    assert (out["yyy"].points, out["yyy"].out_pct) == (0, None)


def test_operating_band_counts_null_reads(spark):
    rows = [("AAA-1", 11.0, None, None), ("AAA-1", None, None, None), ("AAA-1", 5.0, None, None), ("AAA-1", -1.0, None, None)]
    banded = sensors.against_catalog_band(reads(spark, rows), cat.all_sensors(catalog(spark)))
    row = sensors.variable_out_pct(banded).first()
    assert (row.points, row.out_points, row.out_pct) == (4, 2, 50.0)
    assert sorted(r.point_class for r in sensors.split_points(banded).collect()) == ["in", "out", "out"]


def test_median_band(spark):
    rows = [("x", 1.0, 1.0, 9.0), ("x", 1.0, 2.0, 8.0), ("X", 3.0, 4.0, None), ("x", 0.0, 9.0, 8.0)]
    row = sensors.median_band(reads(spark, rows)).first()
    assert (row.band_min, row.band_max) == (3.0, 8.0)
    out = sensors.against_median_band(reads(spark, rows)).where("is_out").count()
    assert out == 3


def test_catalog_defaults_and_order(spark):
    out = cat.all_sensors(catalog(spark)).collect()
    assert [r.var_id for r in out] == ["BBB-2", "AAA-1", "CCC-3"]
    assert (out[0].tag, out[0].min_val, out[0].crit_max) == ("", 0.0, 0.0)
    assert [r.var_id for r in cat.critical_sensors(catalog(spark)).collect()] == ["BBB-2", "AAA-1"]


@pytest.mark.parametrize(
    "query, var_id", [(" aaa-1 ", "AAA-1"), ("temperatura agua", "BBB-2"), ("temperatura", "BBB-2"), ("IQF", "AAA-1"), ("nada", None)]
)
def test_find_sensor(spark, query, var_id):
    row = cat.find_sensor(catalog(spark), query).first()
    assert (row.var_id if row else None) == var_id


def test_critical_reads_keep_active_critical_ids(spark):
    rows = [("AAA-1", 1.0, 0.0, 1.0), ("CCC-3", 1.0, 0.0, 1.0), ("DDD-4", 1.0, 0.0, 1.0)]
    out = sensors.critical_reads(reads(spark, rows), catalog(spark)).collect()
    assert [r.ProductionLineControlVariableId for r in out] == ["aaa-1"]
    assert [r.Value for r in sensors.variable_reads(reads(spark, rows), "ccc-3 ").collect()] == [1.0]


def test_health_and_text(spark):
    rows = [("AAA-1", 10.0, 1.0, 9.0)] * 3 + [("AAA-1", 5.0, 1.0, 9.0)] + [("bbb-2", 5.0, 1.0, 9.0)] * 4
    summary = sensors.summary(reads(spark, rows), catalog(spark))
    row = sensors.process_health(summary).first()
    assert tuple(row) == ("62.5%", "Intervención necesaria", "1 / 2", "IQF", "37.50%", "1 / 2")
    text = sensors.exec_summary(summary, "2026-01-05", "2026-01-06").first().text.split("\r\n")
    assert text == [
        "Resumen ejecutivo (2026-01-05 a 2026-01-06):",
        "- Variables críticas analizadas: 2",
        "- Mayor % fuera de crítico: Temperatura Interna — IQF (75.0%)",
        "  1) Temperatura Interna — IQF: 75.0% fuera (3/4 pts)",
        "  2) Temperatura del agua — Chiller: 0.0% fuera (0/4 pts)",
    ]
    assert sensors.exec_summary(summary.limit(0), "a", "b").count() == 0
    assert sensors.process_health(summary.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_episode_stops_against_brute_force(spark, seed):
    rng = random.Random(seed)

    def span(longest):
        begin = START + timedelta(seconds=rng.randrange(0, 86400))
        return begin, begin + timedelta(seconds=rng.choice([0, 30, 3600, longest]))

    episodes = [(rng.choice([1, 1, 2]), *span(30000), i) for i in range(60)]
    stops = [(rng.choice([1, 1, 2]), *span(90000), f"s{i}") for i in range(60)]
    left = spark.createDataFrame(episodes, "ProductionLineId int, t0 timestamp_ntz, t1 timestamp_ntz, n int")
    left = left.withColumn("ProductionLineControlVariableId", F.concat(F.lit("v"), F.col("n").cast("string")))
    right = spark.createDataFrame(stops, "ProductionLineId int, StartDate timestamp_ntz, EndDate timestamp_ntz, Type string")
    expected = sorted(
        (e[3], s[3], (min(e[2], s[2]) - max(e[1], s[1])).total_seconds())
        for e in episodes
        for s in stops
        if e[0] == s[0] and e[1] < s[2] and s[1] <= e[2]
    )
    out = sensors.episode_stops(left, right)
    assert {r.ProductionLineControlVariableId == f"v{r.n}" for r in out.collect()} == {True}
    assert sorted(tuple(r) for r in out.select("n", "Type", "overlap_sec").collect()) == expected


def test_sensors_of_a_line_have_their_own_episodes(spark):
    rows = [(1, "a", START + timedelta(minutes=k), k, 200.0, 5.0, 100.0) for k in (0, 2, 4)]
    rows += [(1, "b", START + timedelta(minutes=k), k, 50.0, 5.0, 100.0) for k in (1, 3)]
    reads = spark.createDataFrame(
        rows,
        "ProductionLineId int, ProductionLineControlVariableId string, LocalTime timestamp_ntz, ReadSeq int, "
        "Value double, CriticalMinValue double, CriticalMaxValue double",
    )
    assert [(r.ProductionLineControlVariableId, r.n) for r in sensors.episodes(reads).collect()] == [("a", 3)]


def test_missing_days(spark):
    df = spark.createDataFrame([(date(2026, 1, 5),), (date(2026, 1, 7),)], "Day date")
    out = sensors.missing_days(df, F.lit(date(2026, 1, 4)), F.lit(date(2026, 1, 7)))
    assert sorted(r.day for r in out.collect()) == [date(2026, 1, 4), date(2026, 1, 6)]
