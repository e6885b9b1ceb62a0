import os
from datetime import date

import pytest
from check import DATA
from pyspark.sql import functions as F

from shiftloom.api import Reports, Tables
from shiftloom.operators.charts import ChartSpec
from shiftloom.plans import QUERIES
from shiftloom.sources.bindings import Plant

FOLDER = f"{DATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="benchmark tables are not here")
EVENT_TABLES = {"executions": "plant_executions", "summaries": "plant_summaries", "stopages": "plant_stopages"}
NAMES = ("templates", "executions", "summaries", "stopages", "motives", "motive_types", "intervals", "lines", "catalog", "reads")


def tables(spark, renamed=None):
    plant = Plant(spark, FOLDER)
    return Tables(**{n: getattr(plant, (renamed or {}).get(n, n))() for n in NAMES})


@pytest.fixture(scope="module")
def history(spark):
    return Reports(tables(spark), today=date(2001, 8, 1))


@pytest.fixture(scope="module")
def january(spark):
    return Reports(tables(spark, EVENT_TABLES), today=date(2024, 1, 15))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_range_report(spark, history):
    report = history.oee_range("1995-01-01", "2001-12-31")
    for part, key in (("summary", "oee_consolidated"), ("daily", "oee_daily"), ("by_shift", "oee_by_shift"),
                      ("details", "oee_detail"), ("hierarchy", "stop_hierarchy"), ("pareto_chart", "pareto_np_chart")):
        assert rows(report[part]) == rows(QUERIES[key](spark, FOLDER)), part
    assert report["worst"].count() == 5 and report["enriched"].count() == 1 and report["kpis"].count() == 1
    assert report["daily_report"].count() == report["daily"].count()


def test_shift_reports(history):
    day = history.shift_day("1997-06-12")
    assert {r.Fecha for r in day.collect()} <= {date(1997, 6, 12)}
    week = history.shift_range()
    assert all(date(2001, 7, 25) <= r.Fecha <= date(2001, 8, 1) for r in week.collect())
    only = history.shift_range("1995-01-01", "2001-12-31", "Tercer Turno")
    assert {r.Turno for r in only.select("Turno").distinct().collect()} == {"Tercer Turno"}


def test_stop_reasons(history):
    report = history.stop_reasons("1995-01-01", "2001-12-31", stop_class="NP", top=10)
    assert report["reasons"].count() == 10 and {r.Clasificacion for r in report["reasons"].collect()} == {"NP"}
    assert report["pareto_80"].where("Pct_Acumulado > 80").count() == 0


def test_realtime(january):
    report = january.realtime()
    assert report["snapshot"].count() == 1 and report["metrics"].count() == 15 and report["outlook"].count() == 1
    assert january.snapshot(lookback="hour", per_line=True).count() == january.t.lines.count()
    assert january.shift_day("2024-01-10", recount=True).count() > 0


def test_sensors(january):
    report = january.control_variables("10/01/2024", "2024-01-20")
    assert report["text"].first().text.startswith("Resumen ejecutivo (2024-01-10 a 2024-01-20):")
    assert report["health"].count() == 1 and report["worst"].count() == 3
    assert january.list_control_variables().count() > 0
    both = january.correlation()
    assert {r.section for r in both["bundle"].select("section").distinct().collect()} >= {"sensor_summary", "oee_por_turno"}
    assert both["overlap"].columns


def test_one_variable(january):
    report = january.variable("var-7", "2024-01-05", "2024-01-18")
    total = report["totals"].first()
    points = {r.point_class: r["count"] for r in report["points"].groupBy("point_class").count().collect()}
    assert total.var_id == "VAR-7" and points.get("out", 0) == total.out_points
    assert report["span"].count() == 1
    with pytest.raises(LookupError):
        january.variable("nada parecido", "2024-01-05")
    with pytest.raises(ValueError):
        january.variable("var-7", "2024-01-01", "2024-01-15", most_days=14)


def test_oee_over_dates_is_consolidated(history):
    given = history.oee_range("1997-01-01", "1997-12-31", "Primer Turno")["details"].select("Fecha", "Turno", "OEE")
    out = history.chart(given, ChartSpec(x="Fecha", ys=["OEE"]))
    assert rows(out) == rows(history.oee_charts(*history._ends(given, "Fecha"), "Primer Turno"))
    other = history.chart(given.select("Turno", F.lit(1.0).alias("Kg")), ChartSpec(x="Turno", ys=["Kg"], agg="sum"))
    assert other.count() == 1


def test_tables_from_folders(spark, history, tmp_path):
    for name in NAMES:
        getattr(history.t, name).write.parquet(str(tmp_path / name))
    loaded = Reports(Tables.load(spark, str(tmp_path)), today=date(2001, 8, 1))
    got, want = (r.oee_range("1998-01-01", "1998-12-31")["summary"] for r in (loaded, history))
    assert rows(got) == rows(want)
