from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from shiftloom.operators import business, oee
from shiftloom.operators.business import RECIPES, Shifts, shift_star
from shiftloom.schemas import schema_of

TEMPLATES = [
    (0, "Primer Turno", "07:00", "15:30", True),
    (1, "Segundo Turno", "15:30", "23:00", True),
    (2, "Tercer Turno", "23:00", "07:00", True),
    (3, "Turno Retirado", "08:00", "16:00", False),
]

# Recorded shifts of 2026-02-09: template, start, end, OEE, A, P, Q.
RECORDED = [
    (0, "2026-02-09 13:00:05.814385", "2026-02-09 21:30:00.392553", 69.53, 62.33, 111.55, 100.0),
    (1, "2026-02-09 21:30:00.392553", "2026-02-10 05:00:07.556658", 89.74, 73.59, 121.94, 100.0),
    (2, "2026-02-10 05:00:07.556658", "2026-02-10 13:00:01.993967", 89.48, 77.25, 115.83, 100.0),
]


def ts(text):
    return datetime.fromisoformat(text)


def table(spark, name, rows):
    return spark.createDataFrame(rows, schema_of(name))


def summary(exec_id, **values):
    base = dict.fromkeys(schema_of("summaries").names)
    base |= {"WorkShiftExecutionId": exec_id, "ProductionLineId": 1, "Active": True}
    return tuple((base | values).values())


def shifts(spark, executions, recipe="detail", *args):
    return Shifts(table(spark, "executions", executions), table(spark, "templates", TEMPLATES), RECIPES[recipe], *args)


def test_recorded_shifts_have_one_business_date(spark):
    execs = [(i, r[0], ts(r[1]), ts(r[2]), "closed", True, False) for i, r in enumerate(RECORDED)]
    rows = shifts(spark, execs, "no_quality", "2026-02-09", "2026-02-09").rows().collect()
    assert len(rows) == 3 and {r.Fecha for r in rows} == {date(2026, 2, 9)}


def test_recorded_kpis_multiply(spark):
    for _, _, _, total, a, p, q in RECORDED:
        assert round(a * p * q / 1e4, 2) == total
    df = spark.createDataFrame([(364.0, 49.0, 103.0, 5626.336, 5271.804, 100.0)], "d double, s double, u double, r double, e double, q double")
    row = oee.from_times(df, "d", "s", "u", "r", "e", "q").first()
    assert round(row.availability_pct, 2) == 67.30 and round(row.performance_pct, 2) == 106.73
    assert round(row.oee_pct, 2) == 71.83 and row.productive_min == 212


def test_date_filter_keeps_shifts_of_any_length(spark):
    execs = [
        (1, 2, ts("2026-01-02 23:00:00"), ts("2026-01-06 07:00:00"), "closed", True, False),
        (2, 2, ts("2026-01-05 23:00:00"), ts("2026-01-06 07:00:00"), "closed", True, False),
        (3, 0, ts("2026-01-05 07:00:00"), ts("2026-01-09 15:30:00"), "closed", True, False),
        (4, 0, ts("2026-01-06 07:00:00"), ts("2026-01-06 15:30:00"), "closed", True, False),
        (5, 0, ts("2026-01-05 07:00:00"), None, "closed", True, False),
    ]
    rows = shifts(spark, execs, "no_quality", "2026-01-05", "2026-01-05").rows().collect()
    assert sorted(r.WorkShiftExecutionId for r in rows) == [1, 2, 3, 5]


def test_recipes_differ(spark):
    good = ("closed", True, False)
    kinds = {1: good, 2: ("open", True, False), 3: ("closed", False, False), 4: ("closed", True, True), 5: good, 6: good}
    execs = [
        (i, 3 if i == 6 else 0, ts("2026-01-05 07:00:00"), ts("2026-01-05 15:30:00"), *k) for i, k in kinds.items()
    ]
    rows = table(spark, "summaries", [summary(i, Active=i != 5) for i in kinds])
    kept = {
        name: sorted(r.WorkShiftExecutionId for r in shift_star(rows, shifts(spark, execs, name)).collect())
        for name in ("chat_day", "detail", "no_quality", "pareto_day_off", "pareto")
    }
    assert kept == {
        "chat_day": [1, 4],
        "detail": [1, 6],
        "no_quality": [1, 4, 6],
        "pareto_day_off": [1, 2, 3, 5, 6],
        "pareto": [1, 2, 3, 4, 5, 6],
    }


def star_of(spark, rows):
    execs = [(r[0], 0, ts("2026-01-05 07:00:00"), ts("2026-01-05 15:30:00"), "closed", True, False) for r in rows]
    return shift_star(table(spark, "summaries", rows), shifts(spark, execs))


def full(exec_id, avail=100.0, prod=50.0, real=80.0, expected=100.0, **more):
    return summary(
        exec_id, AvailableTimeMin=avail, ProductiveTimeMin=prod, CurrentProductionSummary=real,
        ExpectedProductionSummaryModified=expected, **more,
    )


def test_consolidated_null_confiscation_leaves_the_numerator(spark):
    star = star_of(spark, [full(1, ConfiscationKg=8.0), full(2)])
    row = oee.consolidated(star).first()
    assert (row.Availability, row.Performance, row.Quality) == (50.0, 80.0, 45.0)
    assert row.OEE == 18.0


def test_consolidated_zero_denominators(spark):
    row = oee.consolidated(star_of(spark, [full(1, 0.0, 0.0, 0.0, 0.0, ConfiscationKg=0.0)])).first()
    assert (row.Availability, row.Performance, row.Quality, row.OEE) == (0.0, 0.0, None, 0.0)


@pytest.mark.parametrize(
    "rounded, zero, expected", [(True, False, 20.0), (False, False, 20.0), (False, True, 40.0)]
)
def test_daily_quality_rules(spark, rounded, zero, expected):
    details = oee.detail(star_of(spark, [full(1, Quality=0.0), full(2, Quality=None)]))
    row = oee.daily(details, rounded, zero).first()
    assert row.OEE == pytest.approx(expected)


def test_daily_without_output(spark):
    row = oee.daily(oee.detail(star_of(spark, [full(1, real=0.0, Quality=50.0)]))).first()
    assert (row.OEE, row.Desempeno) == (0.0, 0.0)
    row = oee.daily(oee.detail(star_of(spark, [full(1, avail=0.0)]))).first()
    assert (row.OEE, row.Disponibilidad) == (0.0, 0.0)


def test_weighted_null_quality_is_100_but_0_when_queried_again(spark):
    star = star_of(spark, [full(1, Quality=None)])
    assert oee.weighted(oee.detail(star), "Fecha", ["OEE", "Quality"]).first().Quality == 100.0
    again = oee.weighted_requery(star).first()
    assert (again["_quality"], again["_oee"]) == (0.0, 0.0)


def test_weighted_zero_output_has_full_quality(spark):
    row = oee.weighted(oee.detail(star_of(spark, [full(1, real=0.0, Quality=10.0)])), "Fecha", ["OEE", "Quality"]).first()
    assert (row.Quality, row.OEE) == (100.0, 0.0)


def test_by_shift_takes_the_plain_mean_of_quality(spark):
    details = oee.detail(star_of(spark, [full(1, Quality=100.0), full(2, Quality=None)]))
    rows = oee.by_shift(details, "2026-01-05").collect()
    assert len(rows) == 1 and rows[0]["Producto Conforme"] == "50.0%" and rows[0].OEE == "20.0%"
    assert rows[0]["Paros no programados (Duración)"] == "0 minutos"


def test_without_quality_uses_duration_and_original_plan(spark):
    row = oee.without_quality(
        star_of(spark, [full(1, WorkshiftDurationMin=200.0, ExpectedProductionSummary=160.0)])
    ).first()
    assert (row.TotalTurnos, row.Disponibilidad, row.Desempeno, row.OEE) == (1, 0.5, 0.5, 0.25)


def test_map_back_keeps_unmatched_rows(spark):
    weights = oee.weighted_requery(star_of(spark, [full(1, Quality=100.0)]))
    chart = spark.createDataFrame(
        [("2026-01-05", "Primer", 1.0), ("2026-01-05", "Segundo", 2.0), ("2026-01-09", "Primer", 3.0), ("n/a", "x", 4.0)],
        "Fecha string, Turno string, OEE double",
    )
    out = oee.map_back_weighted(chart, weights, "Fecha", ["OEE"]).orderBy("Fecha", "Turno").collect()
    assert [r.OEE for r in out] == [40.0, 40.0, 3.0, 4.0]


def test_bands_and_limiting_kpi(spark):
    df = spark.createDataFrame([(85.0,), (84.99,), (64.99,), (None,)], "v double")
    assert [r[0] for r in df.select(oee.oee_band(F.col("v"))).collect()] == ["Clase Mundial", "En Riesgo", "Crítico", None]
    kpi = spark.createDataFrame([(69.0, 90.0, None)], "a double, p double, q double").select(
        oee.limiting_kpi(F.col("a"), F.col("p"), F.col("q")).alias("k")
    ).first().k
    assert (kpi.kpi, kpi.value, kpi.below) == ("Disponibilidad", 69.0, True)


def test_worst_shifts_count_null_as_zero(spark):
    details = oee.detail(star_of(spark, [full(1, Oee=5.0), full(2, Oee=None), full(3, Oee=1.0)]))
    assert [r.OEE for r in oee.worst_shifts(details, 2).collect()] == [None, 1.0]


def test_shift_filter_words(spark):
    df = spark.createDataFrame([("Primer Turno",), ("Segundo Turno",)], "Turno string")
    for word in (None, "", "(Todos)", "todos", "(All)", "ALL"):
        assert business.shift_filter(df, word).count() == 2
    assert business.shift_filter(df, "Primer Turno").count() == 1


def test_default_dates(spark):
    first, last = business.default_range(None, None, "2026-01-10")
    row = spark.range(1).select(first.alias("a"), last.alias("b"), business.default_day(None, "2026-01-10").alias("d")).first()
    assert (row.a, row.b, row.d) == (date(2026, 1, 3), date(2026, 1, 10), date(2026, 1, 9))
