from datetime import date

import pytest

from shiftloom.operators import charts
from shiftloom.operators.charts import ChartSpec

ROWS = [
    ("2026-02-18", "Primer", 50.0), ("2026-02-18", "Segundo", 45.0), ("2026-02-18", "Tercer", 20.0),
    ("2026-02-19", "Primer", 72.0), ("2026-02-19", "Segundo", 120.0), ("2026-02-19", "Tercer", 285.0),
]


@pytest.fixture
def chart(spark):
    return spark.createDataFrame(ROWS, "Fecha string, Turno string, OEE double")


def test_oee_with_repeated_dates_keeps_all_rows_unsplit(chart):
    out = charts.chart_frame(chart, ChartSpec(x="Fecha", ys=["OEE"])).collect()
    assert sorted((r.x, r.y) for r in out) == sorted((f, v) for f, _, v in ROWS)
    assert {r.series for r in out} == {"OEE"}


def test_other_metric_with_repeated_dates_is_split_by_shift(chart):
    out = charts.chart_frame(chart.withColumnRenamed("OEE", "Kg"), ChartSpec(x="Fecha", ys=["Kg"])).collect()
    assert {r.series for r in out} == {"Primer", "Segundo", "Tercer"} and len(out) == 6


def test_several_metrics_of_one_series(chart):
    two = chart.withColumnRenamed("OEE", "Kg").selectExpr("*", "Kg * 2 AS Plan")
    out = charts.chart_frame(two, ChartSpec(x="Fecha", ys=["Kg", "Plan"], hue="Turno")).collect()
    assert len(out) == 12 and "Primer, Plan" in {r.series for r in out}


def test_given_aggregate(chart):
    out = charts.chart_frame(chart, ChartSpec(x="Fecha", ys=["OEE"], agg="max", chart="bar")).collect()
    assert [(r.x, r.y) for r in out] == [("2026-02-18", 50.0), ("2026-02-19", 285.0)]


def test_weighting_from_own_columns(spark):
    df = spark.createDataFrame(
        [("d", "100", "50", "80", "100", "100"), ("d", "100", "100", "x", "100", None)],
        "Fecha string, TiempoDisponibleMin string, TiempoProductivoMin string, ProduccionRealKg string, "
        "ProduccionEstimadaKg string, Quality string",
    ).selectExpr("*", "'7' AS OEE")
    out = charts.chart_frame(df, ChartSpec(x="Fecha", ys=["OEE", "Quality"])).collect()
    assert sorted((r.series, round(r.y, 6)) for r in out) == [("OEE", 30.0), ("Quality", 100.0)]


def test_percent_scale(spark):
    df = spark.createDataFrame([("a", 0.5, 0.2), ("b", None, 1.0)], "x string, y double, z double")
    assert [r.y for r in charts.percent_scale(df, ["y", "z"]).orderBy("x").collect()] == [50.0, None]
    assert [r.z for r in charts.percent_scale(df.selectExpr("x", "y", "z * 2 AS z"), ["y", "z"]).orderBy("x").collect()] == [0.4, 2.0]
    out = charts.chart_frame(df, ChartSpec(x="x", ys=["z"], y_format="percent")).collect()
    assert [r.y for r in out] == [20.0, 100.0]


def test_sorting_of_times_in_text(spark):
    df = spark.createDataFrame([("2026-01-10",), ("2026-01-09 23:00:00",), ("b",), ("a",)], "x string")
    assert [r.x for r in charts.sort_series(df, "x").collect()] == ["a", "b", "2026-01-09 23:00:00", "2026-01-10"]
    numbers = spark.createDataFrame([("10",), ("9",), ("100",), ("x",)], "x string")
    assert [r.x for r in charts.sort_series(numbers, "x").collect()] == ["x", "9", "10", "100"]


def test_correlation_uses_pairs_that_are_present(spark):
    rows = [(1.0, 2.0, None, "t"), (2.0, 4.0, 1.0, "t"), (3.0, 7.0, 5.0, "t"), (4.0, 7.5, 2.0, "t")]
    df = spark.createDataFrame(rows, "a double, b double, c double, d string")
    got = {(r.column_a, r.column_b): r.corr for r in charts.correlation(df).collect()}
    want = df.toPandas()[["a", "b", "c"]].corr()
    assert len(got) == 9
    for (a, b), value in got.items():
        assert value == pytest.approx(want.loc[a, b])


def test_heatmap_and_wrong_specs(chart):
    assert charts.chart_frame(chart, ChartSpec(chart="heatmap")).columns == ["OEE"]
    with pytest.raises(ValueError):
        charts.chart_frame(chart, ChartSpec(chart="pie"))
    with pytest.raises(ValueError):
        charts.chart_frame(chart, ChartSpec(x="nope", ys=["OEE"]))


def test_profile(spark):
    df = spark.createDataFrame([("a", date(2026, 1, 1)), ("a", date(2026, 1, 2)), ("b", None)], "k string, t date")
    assert tuple(charts.profile(df, "k", "t").first()) == (3, 2, 2, date(2026, 1, 1), date(2026, 1, 2))
    assert charts.column_types(df) == {"k": "string", "t": "date"}
