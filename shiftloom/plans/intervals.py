"""Queries over line status intervals."""

from __future__ import annotations

from pyspark.sql import functions as F

from shiftloom.functions.texts import status_code, status_label
from shiftloom.operators import intervals as ops
from shiftloom.operators import sweep
from shiftloom.operators import stops
from shiftloom.operators.business import RECIPES, Shifts, shift_star
from shiftloom.plans.oracle import duration_text, minutes_text, pareto_columns
from shiftloom.plans.registry import EVENT_FIRST, EVENT_LAST, query, rounded
from shiftloom.sources.bindings import Plant

STATUS = """CASE i.status WHEN 'US' THEN 'Paro No Programado' WHEN 'SS' THEN 'Paro Programado' WHEN 'LP' THEN 'Baja Producción'
  WHEN 'AV' THEN 'Disponible' ELSE i.status END"""
SINCE_STATUS = f"CASE WHEN contains(since_status, ':') THEN {minutes_text('since_status')} ELSE right(since_status, 2)::INT END"

LOOKBACK = """
  x AS (SELECT n.line_id, i.status, lag(i.status) OVER (PARTITION BY n.line_id ORDER BY i.t, i.seq) AS prev
    FROM latest n JOIN intervals i ON i.line_id = n.line_id AND i.t >= n.t - to_minutes({minutes}) AND i.t <= n.t),
  counts AS (SELECT line_id, count(*) FILTER (WHERE status = 'US' AND (prev IS NULL OR prev <> 'US')) AS np_runs,
    count(*) FILTER (WHERE status = 'SS' AND (prev IS NULL OR prev <> 'SS')) AS p_runs FROM x GROUP BY line_id)"""
SINCE_SHIFT = minutes_text("n.since_shift")

SNAPSHOT = f"""'Linea ' || i.line_id AS "LineName", t AS "SnapshotAtLocal", round(oee, 2) AS "OEE", round(a, 2) AS "Availability", round(p, 2) AS "Performance",
  round(q, 2) AS "Producto Conforme", np_runs AS "ParosNoProgramadosCont", {minutes_text('unscheduled_text')} AS "UnscheduledStopageMin",
  p_runs AS "ParosProgramadosCont", {minutes_text('scheduled_text')} AS "ScheduledStopageMin", {STATUS} AS "StatusCode",
  {SINCE_STATUS} AS "StatusTimeMin", {minutes_text('since_shift')} AS "NaturalTimeMin", {minutes_text('productive_text')} AS "ProductiveTimeMin",
  rate AS "CurrentRate", rate_exp AS "ExpectedRate", shift_kg AS "CurrentShiftProduction", shift_exp AS "ExpectedShiftProduction",
  day_kg AS "CurrentProduction", day_exp AS "ExpectedDayProduction" """
TOP1 = "latest AS (SELECT * FROM intervals ORDER BY t DESC, created_at DESC, seq DESC LIMIT 1)"
TOP1_SNAPSHOT = f"WITH {TOP1}, {LOOKBACK.format(minutes=SINCE_SHIFT)}, snap AS (SELECT {SNAPSHOT} FROM latest i JOIN counts c ON i.line_id = c.line_id)"
LINE_SNAPSHOT = f"""WITH latest AS (SELECT * FROM newest_per_line), {LOOKBACK.format(minutes=SINCE_SHIFT)},
  snap AS (SELECT {SNAPSHOT} FROM latest i JOIN counts c ON i.line_id = c.line_id)"""


@query("latest_snapshot", f"{TOP1_SNAPSHOT} SELECT * FROM snap")
def latest_snapshot(p: Plant):
    return ops.snapshots(p.intervals(), p.lines())


@query("join_lookback_shift", f"{LINE_SNAPSHOT} SELECT * FROM snap")
def join_lookback_shift(p: Plant):
    return ops.snapshots(p.intervals(), p.lines(), per_line=True)


@query(
    "join_lookback_60",
    f"""WITH latest AS (SELECT * FROM newest_per_line), {LOOKBACK.format(minutes='60')}
    SELECT {SNAPSHOT} FROM latest i JOIN counts c ON i.line_id = c.line_id""",
)
def join_lookback_60(p: Plant):
    return ops.snapshots(p.intervals(), p.lines(), shift=False, per_line=True)


@query("join_interval_line", "SELECT i.line_id, i.t, i.seq, l.name FROM intervals i JOIN lines l ON i.line_id = l.line_id")
def join_interval_line(p: Plant):
    rows = ops.with_line(p.intervals(), p.lines())
    return rows.select(
        F.col("ProductionLineId").alias("line_id"), F.col("IntervalBegin").alias("t"), F.col("IntervalSeq").alias("seq"),
        F.col("LineName").alias("name"),
    )


@query(
    "flt_line_like",
    "SELECT i.line_id, i.t, i.seq, l.name FROM intervals i JOIN lines l ON i.line_id = l.line_id WHERE contains(lower(l.name), lower('NEA 1'))",
)
def flt_line_like(p: Plant):
    rows = ops.with_line(p.intervals(), p.lines(), "NEA 1")
    return rows.select(
        F.col("ProductionLineId").alias("line_id"), F.col("IntervalBegin").alias("t"), F.col("IntervalSeq").alias("seq"),
        F.col("LineName").alias("name"),
    )


@query("status_label", f"SELECT seq, {STATUS} AS label FROM intervals i")
def status_label_query(p: Plant):
    code = status_code(F.col("IntervalProductionLineStatus"))
    return p.intervals().select(F.col("IntervalSeq").alias("seq"), status_label(code).alias("label"))


def plant_shifts(p: Plant, recipe: str, first: str = EVENT_FIRST, last: str = EVENT_LAST) -> Shifts:
    return Shifts(p.plant_executions(), p.templates(), RECIPES[recipe], first, last)


def plant_star(p: Plant, first: str = EVENT_FIRST, last: str = EVENT_LAST):
    return shift_star(p.plant_summaries(), plant_shifts(p, "shift_day", first, last))


@query("transition_count", "SELECT exec_id, line_id, np_runs, p_runs FROM exec_counts")
def transition_count(p: Plant):
    counts = ops.with_counts(plant_star(p), p.intervals())
    return counts.select(
        F.col("WorkShiftExecutionId").alias("exec_id"),
        F.col("ProductionLineId").alias("line_id"),
        F.col("ParosNoProgramadosCont").alias("np_runs"),
        F.col("ParosProgramadosCont").alias("p_runs"),
    )


@query("join_interval_exec", "SELECT exec_id, line_id, t, seq, status FROM interval_exec")
def join_interval_exec(p: Plant):
    rows = ops.in_execution(p.intervals(), plant_star(p))
    return rows.select(
        F.col("WorkShiftExecutionId").alias("exec_id"),
        F.col("ProductionLineId").alias("line_id"),
        F.col("IntervalBegin").alias("t"),
        F.col("IntervalSeq").alias("seq"),
        F.col("_status").alias("status"),
    )


@query("join_interval_exec_sweep", "SELECT exec_id, line_id, t, seq, status FROM interval_exec")
def join_interval_exec_sweep(p: Plant):
    rows = sweep.in_execution(p.intervals(), plant_star(p))
    return rows.select(
        F.col("WorkShiftExecutionId").alias("exec_id"),
        F.col("ProductionLineId").alias("line_id"),
        F.col("IntervalBegin").alias("t"),
        F.col("IntervalSeq").alias("seq"),
        F.col("_status").alias("status"),
    )


@query("transition_count_sweep", "SELECT exec_id, line_id, np_runs, p_runs FROM exec_counts WHERE np_runs + p_runs > 0")
def transition_count_sweep(p: Plant):
    counts = sweep.shift_counts(p.intervals(), plant_star(p))
    return counts.where("ParosNoProgramadosCont + ParosProgramadosCont > 0").select(
        F.col("WorkShiftExecutionId").alias("exec_id"),
        F.col("ProductionLineId").alias("line_id"),
        F.col("ParosNoProgramadosCont").alias("np_runs"),
        F.col("ParosProgramadosCont").alias("p_runs"),
    )


SHIFT_DAY = """SELECT e.turno AS "Turno", e.fecha AS "Fecha", s.line_id AS "ProductionLineId", oee AS "OEE", a AS "Disponibilidad", p AS "Desempeno", q AS "Producto Conforme",
  np_runs AS "ParosNoProgramadosCont", n * 3 AS "TiempoNoProdNoProgramadoMin", p_runs AS "ParosProgramadosCont",
  30.0::DOUBLE AS "TiempoNoProdProgramadoMin", 480.0::DOUBLE AS "DuracionTurnoMin", 450.0::DOUBLE AS "TiempoDisponibleMin",
  450 - n * 3 AS "TiempoProductivoMin", v * 1.2::DOUBLE AS "ProduccionEstimadaKg", v AS "ProduccionRealKg",
  v * 1.2::DOUBLE / 8 AS "VelocidadPromedioEstimadaKgHr", v / 8 AS "VelocidadPromedioRealKgHr"
FROM plant_summaries s JOIN plant_executions e ON s.exec_id = e.exec_id JOIN exec_counts c ON c.exec_id = s.exec_id AND c.line_id = s.line_id"""


@query("oee_shift_day", SHIFT_DAY)
def oee_shift_day(p: Plant):
    return ops.shift_day(plant_star(p), p.intervals(), executions=plant_shifts(p, "shift_day").rows())


def stops_today(p: Plant):
    wanted = plant_shifts(p, "pareto_day_off")
    totals = stops.reason_totals(p.plant_stopages(), p.motives(), p.motive_types(), wanted)
    return stops.class_totals(stops.reasons(totals))


TOTALS = f"""every AS (SELECT {pareto_columns()} FROM plant_reasons),
  tot AS (SELECT coalesce(sum("Eventos") FILTER (WHERE "Clasificacion" = 'NP'), 0)::BIGINT AS np_events,
      coalesce(sum("Duracion_Min") FILTER (WHERE "Clasificacion" = 'NP'), 0) AS np_minutes,
      coalesce(sum("Eventos") FILTER (WHERE "Clasificacion" = 'P'), 0)::BIGINT AS p_events,
      coalesce(sum("Duracion_Min") FILTER (WHERE "Clasificacion" = 'P'), 0) AS p_minutes FROM every)"""


SYNCED = f"""{TOP1_SNAPSHOT}, {TOTALS}
    SELECT * EXCLUDE (np_events, np_minutes, p_events, p_minutes) REPLACE (np_events AS "ParosNoProgramadosCont",
      {duration_text('np_minutes')} AS "UnscheduledStopageMin", p_events AS "ParosProgramadosCont",
      {duration_text('p_minutes')} AS "ScheduledStopageMin", {duration_text('"StatusTimeMin"')} AS "StatusTimeMin",
      {duration_text('"NaturalTimeMin"')} AS "NaturalTimeMin", {duration_text('"ProductiveTimeMin"')} AS "ProductiveTimeMin")
    FROM snap, tot"""


@query("snapshot_synced", SYNCED)
def snapshot_synced(p: Plant):
    return ops.synced(ops.snapshots(p.intervals(), p.lines()), stops_today(p))


METRICS = [
    ("OEE (%)", """format('{:.2f}%', "OEE")"""),
    ("Disponibilidad (%)", """format('{:.2f}%', "Availability")"""),
    ("Desempeño (%)", """format('{:.2f}%', "Performance")"""),
    ("Producto Conforme (%)", """format('{:.2f}%', "Producto Conforme")"""),
    ("Estatus Actual", '"StatusCode"'),
    ("Snapshot (Local)", '"SnapshotAtLocal"::VARCHAR'),
    ("Línea", '"LineName"'),
    ("Producción Real (Kg)", """format('{:.2f}', "CurrentShiftProduction")"""),
    ("Producción Esperada (Kg)", """format('{:.2f}', "ExpectedShiftProduction")"""),
    ("Velocidad Real (Kg/h)", """format('{:.2f}', "CurrentRate")"""),
    ("Velocidad Esperada (Kg/h)", """format('{:.2f}', "ExpectedRate")"""),
    ("Paros No Programados (Eventos)", '"ParosNoProgramadosCont"::VARCHAR'),
    ("Duración Paros No Prog.", duration_text('"UnscheduledStopageMin"')),
    ("Paros Programados (Eventos)", '"ParosProgramadosCont"::VARCHAR'),
    ("Duración Paros Prog.", duration_text('"ScheduledStopageMin"')),
]


@query(
    "snapshot_metrics",
    f"{LINE_SNAPSHOT} "
    + " UNION ALL ".join(f"""SELECT "LineName", '{n}' AS "Métrica", {e} AS "Valor" FROM snap""" for n, e in METRICS),
)
def snapshot_metrics(p: Plant):
    from shiftloom.functions.times import format_duration

    snaps = ops.snapshots(p.intervals(), p.lines(), per_line=True)
    shown = snaps.withColumns({c: format_duration(F.col(c)) for c in ops.DURATION_COLUMNS})
    return ops.snapshot_metrics(shown, by=["LineName"])


@query(
    "day_target_outlook",
    f"""{LINE_SNAPSHOT} SELECT "LineName", "SnapshotAtLocal", round_even(("ExpectedDayProduction" - "CurrentProduction") * 1e4, 0) / 1e4 AS gap_kg,
      round_even(CASE WHEN "ExpectedDayProduction" <= "CurrentProduction" THEN 0 ELSE ("ExpectedDayProduction" - "CurrentProduction")
        / CASE WHEN "CurrentRate" > 0 THEN "CurrentRate" END END * 1e4, 0) / 1e4 AS hours_needed, "ExpectedDayProduction" <= "CurrentProduction" AS target_met FROM snap""",
)
def day_target_outlook(p: Plant):
    out = ops.day_target_outlook(ops.snapshots(p.intervals(), p.lines(), per_line=True))
    return rounded(out, 4, "gap_kg", "hours_needed")


@query("status_stops", "SELECT line_id, start_date, end_date, type, seq FROM interval_stops")
def status_stops(p: Plant):
    return p.interval_stops().select(
        F.col("ProductionLineId").alias("line_id"),
        F.col("StartDate").alias("start_date"),
        F.col("EndDate").alias("end_date"),
        F.col("Type").alias("type"),
        F.col("IntervalSeq").alias("seq"),
    )
