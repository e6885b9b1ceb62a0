"""Queries over shift summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shiftloom.functions.numbers import divide_or, divide_or_null, divide_positive_or_one, divide_zero_as_one, round_py
from shiftloom.functions.texts import shift_rank
from shiftloom.operators import business, charts, oee
from shiftloom.operators.business import RECIPES, Shifts, shift_star
from shiftloom.plans.oracle import duration_text
from shiftloom.plans.registry import FIRST, LAST, query, rounded
from shiftloom.sources import sinks
from shiftloom.sources.bindings import Plant


def shifts(p: Plant, recipe: str, first: str | None = None, last: str | None = None, shift: str | None = None) -> Shifts:
    return Shifts(p.executions(first, last), p.templates(), RECIPES[recipe], first, last, shift)


def star(p: Plant, recipe: str, first: str = FIRST, last: str = LAST, shift: str | None = None):
    return shift_star(p.summaries(), shifts(p, recipe, first, last, shift))


def details(p: Plant, first: str = FIRST, last: str = LAST, shift: str | None = None):
    return oee.detail(star(p, "detail", first, last, shift))


CONSOLIDATED = """
WITH s AS (SELECT sum((available_min)::DECIMAL(38,10))::DOUBLE AS a, sum((productive_min)::DECIMAL(38,10))::DOUBLE AS p, sum((real_kg)::DECIMAL(38,10))::DOUBLE AS r, sum((expected_kg)::DECIMAL(38,10))::DOUBLE AS e,
    sum((real_kg - confiscation_kg)::DECIMAL(38,10))::DOUBLE AS c FROM star_detail),
  k AS (SELECT *, CASE WHEN a > 0 THEN p / a ELSE 0 END AS av, CASE WHEN e > 0 THEN r / e ELSE 0 END AS pe, c / nullif(r, 0) AS qu FROM s)
"""
CONSOLIDATED_COLUMNS = """round(a, 2) AS "TotalAvailableMin", round(p, 2) AS "TotalProductiveMin", round(r, 2) AS "TotalRealKg",
  round(e, 2) AS "TotalExpectedKg", round(av * 100, 2) AS "Availability", round(pe * 100, 2) AS "Performance",
  round(qu * 100, 2) AS "Quality", round(av * pe * coalesce(qu, 1.0::DOUBLE) * 100, 2) AS "OEE" """


@query("oee_consolidated", f"{CONSOLIDATED} SELECT {CONSOLIDATED_COLUMNS} FROM k")
def oee_consolidated(p: Plant):
    return oee.consolidated(star(p, "consolidated"))


@query(
    "range_enrichment",
    f"""{CONSOLIDATED}, d AS (SELECT sum(("TiempoNoProdNoProgramadoMin")::DECIMAL(38,10))::DOUBLE AS np, sum(("TiempoNoProdProgramadoMin")::DECIMAL(38,10))::DOUBLE AS pr FROM detail)
    SELECT {CONSOLIDATED_COLUMNS},
      round_even(CASE WHEN round(e, 2) > 0 THEN round(r, 2) / round(e, 2) ELSE 0 END * 100 * 10, 0) / 10 AS "CumplimientoPlan_Pct",
      round_even((round(e, 2) - round(r, 2)) * 10, 0) / 10 AS "GapProduccion_Kg",
      round_even(np * 10, 0) / 10 AS "TotalParosNoProgramadosMin", round_even(pr * 10, 0) / 10 AS "TotalParosProgramadosMin"
    FROM k, d""",
)
def range_enrichment(p: Plant):
    return oee.range_enrichment(oee.consolidated(star(p, "consolidated")), details(p))


DAILY_SUMS = """
WITH s AS (SELECT "Fecha", sum(("ProductiveTimeMin")::DECIMAL(38,10))::DOUBLE AS prod, sum(("AvailableTimeMin")::DECIMAL(38,10))::DOUBLE AS avail, sum(("CurrentProduction")::DECIMAL(38,10))::DOUBLE AS r,
    sum(("ExpectedProduction")::DECIMAL(38,10))::DOUBLE AS e, sum(({quality} / 100 * "CurrentProduction")::DECIMAL(38,10))::DOUBLE AS conf,
    sum(("TiempoNoProdNoProgramadoMin")::DECIMAL(38,10))::DOUBLE AS np_min, sum(("TiempoNoProdProgramadoMin")::DECIMAL(38,10))::DOUBLE AS p_min,
    sum("ParosNoProgramadosCont")::BIGINT AS np_cnt, sum("ParosProgramadosCont")::BIGINT AS p_cnt
  FROM detail GROUP BY "Fecha"),
k AS (SELECT *, CASE WHEN avail > 0 THEN prod / avail ELSE 0 END AS a, CASE WHEN e > 0 THEN r / e ELSE 0 END AS pe,
    CASE WHEN r > 0 THEN conf / r ELSE 1 END AS q FROM s)
"""


@query(
    "oee_daily",
    DAILY_SUMS.format(quality='coalesce("Quality", 100.0::DOUBLE)')
    + """SELECT "Fecha", round_even(a * pe * q * 100 * 10, 0) / 10 AS "OEE", round_even(a * 100 * 10, 0) / 10 AS "Disponibilidad",
      round_even(pe * 100 * 10, 0) / 10 AS "Desempeno", round_even(r, 0) AS "RealKg", round_even(e, 0) AS "EsperadaKg",
      round_even(np_min * 10, 0) / 10 AS "ParosNoProgMin", round_even(p_min * 10, 0) / 10 AS "ParosProgMin",
      np_cnt AS "ParosNoProgCont", p_cnt AS "ParosProgCont" FROM k ORDER BY "Fecha" """,
)
def oee_daily(p: Plant):
    return oee.daily(details(p))


@query(
    "oee_daily_report",
    DAILY_SUMS.format(quality='CASE WHEN coalesce("Quality", 100.0::DOUBLE) = 0 THEN 100.0::DOUBLE ELSE coalesce("Quality", 100.0::DOUBLE) END')
    + """SELECT "Fecha", round_even((a * pe * q * 100) * 1e4, 0) / 1e4 AS "OEE", round_even((a * 100) * 1e4, 0) / 1e4 AS "Disponibilidad",
      round_even((pe * 100) * 1e4, 0) / 1e4 AS "Desempeno", round_even((r) * 1e2, 0) / 1e2 AS "RealKg", round_even((e) * 1e2, 0) / 1e2 AS "EsperadaKg",
      round_even((np_min) * 1e2, 0) / 1e2 AS "ParosNoProgMin", round_even((p_min) * 1e2, 0) / 1e2 AS "ParosProgMin",
      np_cnt AS "ParosNoProgCont", p_cnt AS "ParosProgCont" FROM k ORDER BY "Fecha" """,
)
def oee_daily_report(p: Plant):
    out = oee.daily(details(p), rounded=False, zero_quality_as_100=True)
    out = rounded(out, 4, "OEE", "Disponibilidad", "Desempeno")
    return rounded(out, 2, "RealKg", "EsperadaKg", "ParosNoProgMin", "ParosProgMin")


WEIGHTED_TAIL = """
k AS (SELECT *, p / CASE WHEN a = 0 THEN 1 ELSE a END * 100 AS av, r / CASE WHEN e = 0 THEN 1 ELSE e END * 100 AS pe,
    CASE WHEN r = 0 THEN 100 ELSE c / r * 100 END AS qu FROM s)
"""


@query(
    "oee_weighted",
    f"""WITH s AS (SELECT "Fecha" AS x, sum(("ProductiveTimeMin")::DECIMAL(38,10))::DOUBLE AS p, sum(("AvailableTimeMin")::DECIMAL(38,10))::DOUBLE AS a, sum(("CurrentProduction")::DECIMAL(38,10))::DOUBLE AS r,
      sum(("ExpectedProduction")::DECIMAL(38,10))::DOUBLE AS e, sum((coalesce("Quality", 100.0::DOUBLE) / 100 * "CurrentProduction")::DECIMAL(38,10))::DOUBLE AS c FROM detail GROUP BY 1), {WEIGHTED_TAIL}
    SELECT x AS "Fecha", round_even((av * pe * qu / 10000) * 1e4, 0) / 1e4 AS "OEE", round_even((av) * 1e4, 0) / 1e4 AS "Disponibilidad", round_even((pe) * 1e4, 0) / 1e4 AS "Desempeno",
      round_even((qu) * 1e4, 0) / 1e4 AS "Quality" FROM k""",
)
def oee_weighted(p: Plant):
    ys = ["OEE", "Disponibilidad", "Desempeno", "Quality"]
    return rounded(oee.weighted(details(p), "Fecha", ys), 4, *ys)


REQUERY = f"""
WITH s AS (SELECT fecha AS x, sum((productive_min)::DECIMAL(38,10))::DOUBLE AS p, sum((available_min)::DECIMAL(38,10))::DOUBLE AS a, sum((real_kg)::DECIMAL(38,10))::DOUBLE AS r, sum((expected_kg)::DECIMAL(38,10))::DOUBLE AS e,
  sum((coalesce(quality, 0.0::DOUBLE) / 100 * real_kg)::DECIMAL(38,10))::DOUBLE AS c FROM star_detail GROUP BY 1), {WEIGHTED_TAIL}
"""


@query(
    "oee_weighted_requery",
    f"""{REQUERY} SELECT x AS "Fecha", round_even((av) * 1e4, 0) / 1e4 AS availability, round_even((pe) * 1e4, 0) / 1e4 AS performance, round_even((qu) * 1e4, 0) / 1e4 AS quality,
      round_even((av * pe * qu / 10000) * 1e4, 0) / 1e4 AS oee FROM k""",
)
def oee_weighted_requery(p: Plant):
    out = oee.weighted_requery(star(p, "weighted_requery")).select(
        "Fecha",
        F.col("_availability").alias("availability"),
        F.col("_performance").alias("performance"),
        F.col("_quality").alias("quality"),
        F.col("_oee").alias("oee"),
    )
    return rounded(out, 4, "availability", "performance", "quality", "oee")


@query(
    "map_back_weighted",
    f"""{REQUERY} SELECT cast(d.fecha AS VARCHAR) AS "Fecha", d.turno AS "Turno",
      round_even((coalesce(av * pe * qu / 10000, d.oee)) * 1e4, 0) / 1e4 AS "OEE", round_even((coalesce(pe, d.performance)) * 1e4, 0) / 1e4 AS "Desempeno"
    FROM star_plain d LEFT JOIN k ON d.fecha = k.x""",
)
def map_back_weighted(p: Plant):
    rows = star(p, "no_quality").select(
        F.col("Fecha").cast("string").alias("Fecha"), "Turno", F.col("Oee").alias("OEE"), F.col("Performance").alias("Desempeno")
    )
    weights = oee.weighted_requery(star(p, "weighted_requery"))
    return rounded(oee.map_back_weighted(rows, weights, "Fecha", ["OEE", "Desempeno"]), 4, "OEE", "Desempeno")




@query(
    "oee_by_shift",
    f"""WITH s AS (SELECT "Turno", sum(("ProductiveTimeMin")::DECIMAL(38,10))::DOUBLE / CASE WHEN sum(("AvailableTimeMin")::DECIMAL(38,10))::DOUBLE > 0 THEN sum(("AvailableTimeMin")::DECIMAL(38,10))::DOUBLE ELSE 1 END AS a,
      sum(("CurrentProduction")::DECIMAL(38,10))::DOUBLE / CASE WHEN sum(("ExpectedProduction")::DECIMAL(38,10))::DOUBLE > 0 THEN sum(("ExpectedProduction")::DECIMAL(38,10))::DOUBLE ELSE 1 END AS pe,
      sum((coalesce("Quality", 0.0::DOUBLE))::DECIMAL(38,10))::DOUBLE / count(*) AS q, sum(("CurrentProduction")::DECIMAL(38,10))::DOUBLE AS r, sum(("ExpectedProduction")::DECIMAL(38,10))::DOUBLE AS e,
      sum(("TiempoNoProdNoProgramadoMin")::DECIMAL(38,10))::DOUBLE AS np_min, sum(("TiempoNoProdProgramadoMin")::DECIMAL(38,10))::DOUBLE AS p_min,
      sum("ParosNoProgramadosCont")::BIGINT AS np_cnt, sum("ParosProgramadosCont")::BIGINT AS p_cnt FROM detail GROUP BY "Turno")
    SELECT '1995-01-01 a 2001-12-31' AS "Fecha", "Turno", format('{{:.1f}}%', a * pe * (q / 100) * 100) AS "OEE",
      format('{{:.1f}}%', a * 100) AS "Disponibilidad", format('{{:.1f}}%', pe * 100) AS "Desempeno",
      format('{{:.1f}}%', q) AS "Producto Conforme", format('{{:,.0f}}', r) AS "Producción Real (Kg)",
      format('{{:,.0f}}', e) AS "Producción Esperada (Kg)", {duration_text('np_min')} AS "Paros no programados (Duración)",
      np_cnt::VARCHAR || ' ev.' AS "Paros No Prog (Eventos)", {duration_text('p_min')} AS "Paros programados (Duración)",
      p_cnt::VARCHAR || ' ev.' AS "Paros Prog (Eventos)" FROM s""",
)
def oee_by_shift(p: Plant):
    return oee.by_shift(details(p), f"{FIRST} a {LAST}")


@query("oee_detail", 'SELECT * FROM detail ORDER BY "Fecha" DESC, "Turno"')
def oee_detail(p: Plant):
    return oee.detail_report(star(p, "detail"))


STORED = """turno AS "Turno", fecha AS "Fecha", oee AS "OEE", availability AS "Disponibilidad", performance AS "Desempeno",
  quality AS "Producto Conforme", coalesce(np_cnt, 0) AS "ParosNoProgramadosCont", np_min AS "TiempoNoProdNoProgramadoMin",
  coalesce(p_cnt, 0) AS "ParosProgramadosCont", p_min AS "TiempoNoProdProgramadoMin", duration_min AS "DuracionTurnoMin",
  available_min AS "TiempoDisponibleMin", productive_min AS "TiempoProductivoMin", expected_kg AS "ProduccionEstimadaKg",
  real_kg AS "ProduccionRealKg", v_exp AS "VelocidadPromedioEstimadaKgHr", v_cur AS "VelocidadPromedioRealKgHr" """


@query("oee_shift_day_stored", f"SELECT {STORED} FROM star_chat WHERE fecha = DATE '1997-06-12'")
def oee_shift_day_stored(p: Plant):
    return oee.stored(star(p, "chat_day", "1997-06-12", "1997-06-12"), by_rank=True)


@query("oee_shift_range_stored", f"SELECT {STORED} FROM star_chat ORDER BY fecha, turno")
def oee_shift_range_stored(p: Plant):
    return oee.stored(star(p, "chat_range"), by_rank=False)


@query(
    "oee_nodq",
    """WITH s AS (SELECT count(exec_id) AS n, sum((available_min)::DECIMAL(38,10))::DOUBLE AS a, sum((duration_min)::DECIMAL(38,10))::DOUBLE AS d, sum((real_kg)::DECIMAL(38,10))::DOUBLE AS r, sum((expected_orig)::DECIMAL(38,10))::DOUBLE AS e FROM star_plain)
    SELECT n AS "TotalTurnos", round_even((a) * 1e2, 0) / 1e2 AS "MinutosDisp", round_even((d) * 1e2, 0) / 1e2 AS "MinutosDur", round_even((r) * 1e2, 0) / 1e2 AS "RealKg", round_even((e) * 1e2, 0) / 1e2 AS "EsperadaKg",
      round_even((a / nullif(d, 0)) * 1e4, 0) / 1e4 AS "Disponibilidad", round_even((r / nullif(e, 0)) * 1e4, 0) / 1e4 AS "Desempeno",
      round_even((a / nullif(d, 0) * (r / nullif(e, 0))) * 1e4, 0) / 1e4 AS "OEE" FROM s""",
)
def oee_nodq(p: Plant):
    out = oee.without_quality(star(p, "no_quality"))
    return rounded(rounded(out, 2, "MinutosDisp", "MinutosDur", "RealKg", "EsperadaKg"), 4, "Disponibilidad", "Desempeno", "OEE")


@query(
    "oee_from_times",
    """SELECT exec_id, line_id, duration_min - p_min AS available_min, duration_min - p_min - np_min AS productive_min,
      (duration_min - p_min - np_min) / nullif(duration_min - p_min, 0) * 100 AS availability_pct, real_kg / nullif(expected_kg, 0) * 100 AS performance_pct,
      round_even(((duration_min - p_min - np_min) / nullif(duration_min - p_min, 0) * 100 * (real_kg / nullif(expected_kg, 0) * 100) * quality / 10000) * 1e4, 0) / 1e4 AS oee_pct
    FROM summaries""",
)
def oee_from_times(p: Plant):
    out = oee.from_times(
        p.summaries(), "WorkshiftDurationMin", "ScheduledStopageMin", "UnscheduledStopageMin",
        "CurrentProductionSummary", "ExpectedProductionSummaryModified", "Quality",
    )
    return rounded(out, 4, "oee_pct").select(
        F.col("WorkShiftExecutionId").alias("exec_id"), F.col("ProductionLineId").alias("line_id"),
        "available_min", "productive_min", "availability_pct", "performance_pct", "oee_pct",
    )


@query("business_date", "SELECT exec_id, start_date, end_date, fecha FROM dated")
def business_date(p: Plant):
    rows = p.executions().join(p.templates().drop("Active"), "WorkShiftTemplateId")
    return rows.select(
        F.col("WorkShiftExecutionId").alias("exec_id"),
        F.col("StartDate").alias("start_date"),
        F.col("EndDate").alias("end_date"),
        business.business_date().alias("fecha"),
    )


@query(
    "flt_recipe",
    """SELECT * FROM (
      SELECT 'chat_day' AS recipe, count(*) AS n, round_even((sum((real_kg)::DECIMAL(38,10))::DOUBLE) * 1e2, 0) / 1e2 AS kg FROM star_chat
      UNION ALL SELECT 'consolidated', count(*), round_even((sum((real_kg)::DECIMAL(38,10))::DOUBLE) * 1e2, 0) / 1e2 FROM star_detail
      UNION ALL SELECT 'no_quality', count(*), round_even((sum((real_kg)::DECIMAL(38,10))::DOUBLE) * 1e2, 0) / 1e2 FROM star_plain
      UNION ALL SELECT 'pareto_day_off', count(*), round_even((sum((s.real_kg)::DECIMAL(38,10))::DOUBLE) * 1e2, 0) / 1e2 FROM summaries s JOIN dated d ON s.exec_id = d.exec_id WHERE NOT d.day_off
      UNION ALL SELECT 'pareto', count(*), round_even((sum((s.real_kg)::DECIMAL(38,10))::DOUBLE) * 1e2, 0) / 1e2 FROM summaries s JOIN dated d ON s.exec_id = d.exec_id)""",
)
def flt_recipe(p: Plant):
    def count(name: str):
        rows = star(p, name).agg(F.count("*").alias("n"), round_py(F.sum("CurrentProductionSummary"), 2).alias("kg"))
        return rows.select(F.lit(name).alias("recipe"), "n", "kg")

    return charts.union_all([count(n) for n in ("chat_day", "consolidated", "no_quality", "pareto_day_off", "pareto")])


EXEC_COLUMNS = ("WorkShiftExecutionId", "Turno", "Fecha")


def executions(p: Plant, first: str | None = None, last: str | None = None, shift: str | None = None):
    return shifts(p, "no_quality", first, last, shift).rows().select(*EXEC_COLUMNS)


EXEC_SQL = """SELECT exec_id AS "WorkShiftExecutionId", turno AS "Turno", fecha AS "Fecha" FROM dated WHERE status = 'closed' AND active"""


@query("flt_day", f"{EXEC_SQL} AND fecha = DATE '1998-03-15'")
def flt_day(p: Plant):
    return executions(p, "1998-03-15", "1998-03-15")


@query("flt_range", f"{EXEC_SQL} AND fecha BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'")
def flt_range(p: Plant):
    return executions(p, "1996-01-01", "1999-12-31")


@query("flt_dates", f"{EXEC_SQL} AND fecha IN (DATE '1996-02-29', DATE '1997-06-12', DATE '2001-07-31')")
def flt_dates(p: Plant):
    return business.on_dates(executions(p), ["1996-02-29", "1997-06-12", "2001-07-31"])


@query(
    "flt_default_dates",
    f"""WITH last_day AS (SELECT max(fecha) AS d FROM dated)
    SELECT 'day' AS span, e.* FROM ({EXEC_SQL}) e, last_day WHERE e."Fecha" = d - 1
    UNION ALL SELECT 'range', e.* FROM ({EXEC_SQL}) e, last_day WHERE e."Fecha" BETWEEN d - 7 AND d""",
)
def flt_default_dates(p: Plant):
    dated = p.executions().join(p.templates().drop("Active"), "WorkShiftTemplateId")
    today = dated.agg(F.max(business.business_date())).scalar()
    rows = executions(p).withColumn("_today", today)
    now = F.col("_today")
    first, last = business.default_range(None, None, now)
    by_day = rows.where(F.col("Fecha") == business.default_day(None, now)).select(F.lit("day").alias("span"), *EXEC_COLUMNS)
    by_range = rows.where(F.col("Fecha").between(first, last)).select(F.lit("range").alias("span"), *EXEC_COLUMNS)
    return by_day.unionByName(by_range)


@query(
    "flt_shift",
    f"""SELECT 'Segundo Turno' AS wanted, * FROM ({EXEC_SQL} AND turno = 'Segundo Turno') UNION ALL SELECT '(Todos)', * FROM ({EXEC_SQL})""",
)
def flt_shift(p: Plant):
    frames = [executions(p, shift=s).select(F.lit(s).alias("wanted"), *EXEC_COLUMNS) for s in ("Segundo Turno", "(Todos)")]
    return charts.union_all(frames)


@query(
    "shift_rank",
    """SELECT exec_id, turno, CASE turno WHEN 'Primer Turno' THEN 1 WHEN 'Segundo Turno' THEN 2 WHEN 'Tercer Turno' THEN 3 ELSE 9 END AS shift_rank
    FROM (SELECT exec_id, CASE WHEN status = 'open' THEN 'Turno Especial' ELSE turno END AS turno FROM dated)""",
)
def shift_rank_query(p: Plant):
    named = p.executions().join(p.templates().drop("Active"), "WorkShiftTemplateId")
    turno = F.when(F.col("Status") == "open", "Turno Especial").otherwise(F.col("Name"))
    return named.select(
        F.col("WorkShiftExecutionId").alias("exec_id"), turno.alias("turno"), shift_rank(turno).alias("shift_rank")
    )


@query("join_shift_star", "SELECT exec_id, line_id, turno, fecha, start_date, end_date, oee, real_kg FROM star_plain")
def join_shift_star(p: Plant):
    return star(p, "no_quality").select(
        F.col("WorkShiftExecutionId").alias("exec_id"),
        F.col("ProductionLineId").alias("line_id"),
        F.col("Turno").alias("turno"),
        F.col("Fecha").alias("fecha"),
        F.col("StartDate").alias("start_date"),
        F.col("EndDate").alias("end_date"),
        F.col("Oee").alias("oee"),
        F.col("CurrentProductionSummary").alias("real_kg"),
    )


@query(
    "worst_shifts",
    """SELECT "Fecha", "Turno", "OEE", "CurrentProduction", "ExpectedProduction" FROM detail
    ORDER BY coalesce("OEE", 0), "Fecha", "Turno", "CurrentProduction", "ExpectedProduction" LIMIT 5""",
)
def worst_shifts(p: Plant):
    return oee.worst_shifts(details(p)).select("Fecha", "Turno", "OEE", "CurrentProduction", "ExpectedProduction")


@query(
    "kpi_fallback",
    """SELECT round_even((avg("OEE")) * 1e4, 0) / 1e4 AS oee_promedio, round_even((sum((coalesce("CurrentProduction", 0))::DECIMAL(38,10))::DOUBLE) * 1e2, 0) / 1e2 AS produccion_total,
      round_even((sum(("TiempoNoProdNoProgramadoMin")::DECIMAL(38,10))::DOUBLE) * 1e2, 0) / 1e2 AS paros_no_prog_min, count(*) AS turnos FROM detail""",
)
def kpi_fallback(p: Plant):
    return rounded(rounded(oee.kpi_fallback(details(p)), 4, "oee_promedio"), 2, "produccion_total", "paros_no_prog_min")


@query(
    "oee_band",
    """SELECT exec_id, line_id, oee, CASE WHEN oee >= 85 THEN 'Clase Mundial' WHEN oee >= 65 THEN 'En Riesgo' WHEN oee < 65 THEN 'Crítico' END AS band
    FROM summaries""",
)
def oee_band(p: Plant):
    return p.summaries().select(
        F.col("WorkShiftExecutionId").alias("exec_id"),
        F.col("ProductionLineId").alias("line_id"),
        F.col("Oee").alias("oee"),
        oee.oee_band(F.col("Oee")).alias("band"),
    )


@query(
    "limiting_kpi",
    """SELECT exec_id, line_id, kpi, value, CASE kpi WHEN 'Disponibilidad' THEN value < 70 WHEN 'Desempeño' THEN value < 80 ELSE value < 95 END AS below
    FROM (SELECT exec_id, line_id, least(availability, performance - 5, quality) AS value,
      CASE WHEN availability = least(availability, performance - 5, quality) THEN 'Disponibilidad'
        WHEN performance - 5 = least(availability, performance - 5, quality) THEN 'Desempeño' ELSE 'Producto conforme' END AS kpi FROM summaries)""",
)
def limiting_kpi(p: Plant):
    c = F.col
    kpi = oee.limiting_kpi(c("Availability"), c("Performance") - 5, c("Quality"))
    rows = p.summaries().select(c("WorkShiftExecutionId").alias("exec_id"), c("ProductionLineId").alias("line_id"), kpi.alias("k"))
    return rows.select("exec_id", "line_id", "k.kpi", "k.value", "k.below")


@query(
    "safe_divide",
    """SELECT exec_id, line_id, real_kg / nullif(p_cnt, 0) AS or_null, CASE WHEN p_cnt > 0 THEN real_kg / p_cnt ELSE 0 END AS or_zero,
      real_kg / CASE WHEN p_cnt = 0 THEN 1 ELSE p_cnt END AS zero_as_one, CASE WHEN p_cnt > 0 THEN real_kg / p_cnt ELSE 1 END AS or_one,
      real_kg / CASE WHEN p_cnt > 0 THEN p_cnt ELSE 1 END AS positive_or_one FROM summaries""",
)
def safe_divide(p: Plant):
    real, count = F.col("CurrentProductionSummary"), F.col("ScheduledStopagesCount")
    return p.summaries().select(
        F.col("WorkShiftExecutionId").alias("exec_id"),
        F.col("ProductionLineId").alias("line_id"),
        divide_or_null(real, count).alias("or_null"),
        divide_or(real, count, 0.0).alias("or_zero"),
        divide_zero_as_one(real, count).alias("zero_as_one"),
        divide_or(real, count, 1.0).alias("or_one"),
        divide_positive_or_one(real, count).alias("positive_or_one"),
    )


@query(
    "agg_by_x",
    """SELECT 'mean' AS how, "Turno", round_even((avg("AvailableTimeMin")) * 1e4, 0) / 1e4 AS minutes, round_even((avg("CurrentProduction")) * 1e4, 0) / 1e4 AS kg FROM detail GROUP BY ALL
    UNION ALL SELECT 'sum', "Turno", round_even((sum(("AvailableTimeMin")::DECIMAL(38,10))::DOUBLE) * 1e4, 0) / 1e4, round_even((sum(("CurrentProduction")::DECIMAL(38,10))::DOUBLE) * 1e2, 0) / 1e2 FROM detail GROUP BY ALL
    UNION ALL SELECT 'max', "Turno", round_even((max("AvailableTimeMin")) * 1e4, 0) / 1e4, round_even((max("CurrentProduction")) * 1e4, 0) / 1e4 FROM detail GROUP BY ALL
    UNION ALL SELECT 'min', "Turno", round_even((min("AvailableTimeMin")) * 1e4, 0) / 1e4, round_even((min("CurrentProduction")) * 1e4, 0) / 1e4 FROM detail GROUP BY ALL""",
)
def agg_by_x(p: Plant):
    rows = details(p)

    def one(how: str):
        out = charts.agg_by_x(rows, "Turno", ["AvailableTimeMin", "CurrentProduction"], how)
        places = 2 if how == "sum" else 4
        return out.select(
            F.lit(how).alias("how"),
            "Turno",
            round_py(F.col("AvailableTimeMin"), 4).alias("minutes"),
            round_py(F.col("CurrentProduction"), places).alias("kg"),
        )

    return charts.union_all([one(h) for h in ("mean", "sum", "max", "min")])


@query("dup_x_check", 'SELECT "Fecha" AS value, count(*) AS n FROM detail GROUP BY 1 HAVING count(*) > 1')
def dup_x_check(p: Plant):
    return charts.repeated_values(details(p), "Fecha")


@query(
    "pct_autoscale",
    """WITH f AS (SELECT l_orderkey, l_linenumber, l_discount AS d, l_tax AS t FROM lineitem),
      m AS (SELECT greatest(max(d), max(t)) AS top FROM f)
    SELECT l_orderkey, l_linenumber, CASE WHEN top <= 1 THEN d * 100 ELSE d END AS d, CASE WHEN top <= 1 THEN t * 100 ELSE t END AS t FROM f, m""",
)
def pct_autoscale(p: Plant):
    rows = p.raw("lineitem").select("l_orderkey", "l_linenumber", F.col("l_discount").alias("d"), F.col("l_tax").alias("t"))
    return charts.percent_scale(rows, ["d", "t"])


@query(
    "chart_frame",
    f"""WITH s AS (SELECT "Fecha" AS x, sum(("ProductiveTimeMin")::DECIMAL(38,10))::DOUBLE AS p, sum(("AvailableTimeMin")::DECIMAL(38,10))::DOUBLE AS a, sum(("CurrentProduction")::DECIMAL(38,10))::DOUBLE AS r,
      sum(("ExpectedProduction")::DECIMAL(38,10))::DOUBLE AS e, sum((coalesce("Quality", 100.0::DOUBLE) / 100 * "CurrentProduction")::DECIMAL(38,10))::DOUBLE AS c FROM detail GROUP BY 1), {WEIGHTED_TAIL},
      w AS (SELECT 'weighted' AS frame, cast(x AS VARCHAR) AS x, 'OEE' AS series, av * pe * qu / 10000 AS y FROM k
        UNION ALL SELECT 'weighted', cast(x AS VARCHAR), 'Disponibilidad', av FROM k),
      m AS (SELECT 'series' AS frame, cast("Fecha" AS VARCHAR) AS x, "Turno" AS series, "CurrentProduction" AS y FROM detail),
      g AS (SELECT 'grouped', "Turno", 'AvailableTimeMin', sum(("AvailableTimeMin")::DECIMAL(38,10))::DOUBLE FROM detail GROUP BY "Turno")
    SELECT frame, x, series, round_even((y) * 1e4, 0) / 1e4 AS y FROM (SELECT * FROM w UNION ALL SELECT * FROM m UNION ALL SELECT * FROM g)""",
)
def chart_frame(p: Plant):
    # three frames, two looks at whether dates repeat and a sample to sort by: joined once for all
    columns = ["Fecha", "Turno", "AvailableTimeMin", "ProductiveTimeMin", "CurrentProduction", "ExpectedProduction", "Quality"]
    rows = sinks.write_once(details(p).select(columns), "chart")
    specs = {
        "weighted": charts.ChartSpec(x="Fecha", ys=["OEE", "Disponibilidad"]),
        "series": charts.ChartSpec(x="Fecha", ys=["CurrentProduction"]),
        "grouped": charts.ChartSpec(x="Turno", ys=["AvailableTimeMin"], agg="sum", chart="bar"),
    }
    frames = [
        charts.chart_frame(rows, spec).select(
            F.lit(name).alias("frame"), F.col("x").cast("string").alias("x"), "series", round_py(F.col("y"), 4).alias("y")
        )
        for name, spec in specs.items()
    ]
    return charts.union_all(frames)


@query(
    "chart_requery",
    f"""{REQUERY} SELECT cast(d.fecha AS VARCHAR) AS x, 'OEE' AS series, round_even((coalesce(av * pe * qu / 10000, d.oee)) * 1e4, 0) / 1e4 AS y
    FROM star_plain d LEFT JOIN k ON d.fecha = k.x""",
)
def chart_requery(p: Plant):
    rows = star(p, "no_quality").select(F.col("Fecha").cast("string").alias("Fecha"), "Turno", F.col("Oee").alias("OEE"))
    frame = charts.chart_frame(rows, charts.ChartSpec(x="Fecha", ys=["OEE"]), star(p, "weighted_requery"))
    return rounded(frame, 4, "y")
