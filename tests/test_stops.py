from datetime import datetime, timedelta

from shiftloom.operators import stops
from shiftloom.operators.business import RECIPES, Shifts
from shiftloom.schemas import schema_of

BEGIN = datetime(2026, 1, 5, 8)


def table(spark, name, rows):
    return spark.createDataFrame(rows, schema_of(name))


def totals(spark, rows, recipe="pareto", stop_class=None):
    """Rows are (motive, seconds or None, class, active, execution)."""
    stopages = [(m, e, BEGIN, None if s is None else BEGIN + timedelta(seconds=s), c, a) for m, s, c, a, e in rows]
    execs = [
        (1, 0, BEGIN.replace(hour=7), BEGIN.replace(hour=15, minute=30), "open", False, False),
        (2, 0, BEGIN.replace(hour=7), BEGIN.replace(hour=15, minute=30), "closed", True, True),
    ]
    temps = [(0, "Primer Turno", "07:00", "15:30", True)]
    motives = [(1, "A", "Atasco", "NP"), (2, "A", "Comida", "P"), (3, "B", "Otro", None), (4, "C", "Sin tipo", "NP")]
    types = [("A", "Mecánico"), ("B", "Varios")]
    shifts = Shifts(table(spark, "executions", execs), table(spark, "templates", temps), RECIPES[recipe])
    return stops.reason_totals(
        table(spark, "stopages", stopages), table(spark, "motives", motives), table(spark, "motive_types", types), shifts, stop_class
    )


ROWS = [
    (1, 600, "P", True, 1),
    (1, 61, "P", True, 1),
    (2, 120, "NP", True, 1),
    (3, 90, "NP", True, 1),
    (3, None, "NP", True, 1),
    (4, 30, "NP", True, 1),
    (9, 45, "P", True, 1),
    (1, 6000, "P", False, 1),
    (1, 9000, "P", True, 2),
]


def test_day_off_recipe_and_inactive_stops(spark):
    with_off = stops.pareto(totals(spark, ROWS), 50).first()
    without = stops.pareto(totals(spark, ROWS, "pareto_day_off"), 50).first()
    assert with_off.Duracion_Min == 9661 / 60 and without.Duracion_Min == 661 / 60


def test_pareto_labels_and_means(spark):
    rows = {r.Motivo_Particular: r for r in stops.pareto(totals(spark, ROWS, "pareto_day_off"), 50).collect()}
    assert rows["Atasco"].Clasificacion == "NP" and rows["Atasco"].Eventos == 2
    assert rows["Atasco"].Duracion_Promedio_Min == 330 / 60
    assert rows["Otro"].Clasificacion == "NP" and rows["Otro"].Eventos == 2 and rows["Otro"].Duracion_Promedio_Min == 1.5
    assert rows["Sin tipo"].Tipo_General == stops.UNCLASSIFIED
    assert rows[stops.UNCLASSIFIED].Tipo_General == stops.UNCLASSIFIED and rows[stops.UNCLASSIFIED].Clasificacion == "P"


def test_rows_with_equal_labels_stay_apart(spark):
    rows = [(1, 10, "P", True, 1), (1, 20, "NP", True, 1), (9, 5, "P", True, 1), (8, 7, "NP", True, 1)]
    out = stops.pareto(totals(spark, rows), 50).collect()
    assert len(out) == 4


def test_class_filter(spark):
    assert {r.Clasificacion for r in stops.pareto(totals(spark, ROWS, stop_class="p"), 50).collect()} == {"P"}
    assert {r.Clasificacion for r in stops.pareto(totals(spark, ROWS, stop_class="x"), 50).collect()} == {"P", "NP"}


def reasons(spark, rows):
    return spark.createDataFrame(
        rows, "Tipo_General string, Motivo_Particular string, Clasificacion string, Duracion_Min double, Eventos bigint"
    )


def test_share_is_of_the_listed_rows(spark):
    df = reasons(spark, [("A", "x", "NP", 50.0, 1), ("A", "y", "NP", 30.0, 2), ("B", "z", "P", 20.0, 3)])
    out = stops.share(df).orderBy("Pct_Acumulado").collect()
    assert [(r.Pct_Total, r.Pct_Acumulado) for r in out] == [(50.0, 50.0), (30.0, 80.0), (20.0, 100.0)]
    assert stops.vital_few(stops.share(df)).count() == 2


def test_vital_few_is_empty_when_the_first_cause_exceeds_80(spark):
    df = reasons(spark, [("A", "x", "NP", 90.0, 1), ("A", "y", "NP", 10.0, 2)])
    assert stops.vital_few(stops.share(df)).count() == 0


def test_share_of_nothing(spark):
    out = stops.share(reasons(spark, [("A", "x", "NP", None, 1)])).first()
    assert (out.Pct_Total, out.Pct_Acumulado) == (0.0, 0.0)


def test_np_chart(spark):
    df = reasons(spark, [("A", "x" * 60, "NP", 10.04, 1), ("A", "y", "P", 99.0, 2), ("B", "z", "np", 1.06, 3)])
    out = stops.np_chart(df).orderBy("rank").collect()
    assert [(r.label, r.minutes, r.events) for r in out] == [("x" * 45, 10.0, 1), ("z", 1.1, 3)]
    assert [r.vital_few for r in out] == [False, False]
    only_p = stops.np_chart(reasons(spark, [("A", "y", "P", 99.0, 2)]), 10, 30).collect()
    assert [r.label for r in only_p] == ["y"]


def test_hierarchy(spark):
    df = reasons(spark, [("A", "x", "NP", 10.0, 1), ("A", "y", "P", 5.04, 2), ("B", "z", "NP", 1.0, 3)])
    out = stops.hierarchy(df).collect()
    assert {(r.node, r.parent, r.minutes) for r in out} == {
        ("T_A", "", 15.0), ("T_B", "", 1.0), ("M_A_x", "T_A", 10.0), ("M_A_y", "T_A", 5.0), ("M_B_z", "T_B", 1.0),
    }
    assert stops.hierarchy(df.limit(1)).count() == 0


def test_class_totals_of_nothing(spark):
    assert tuple(stops.class_totals(reasons(spark, [("A", "x", "NP", 2.0, 1)])).first()) == (1, 2.0, 0, 0.0)
