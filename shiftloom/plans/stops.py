"""Queries over stoppages."""

from __future__ import annotations

from pyspark.sql import functions as F

from shiftloom.functions.texts import clip_label
from shiftloom.functions.times import int_avg, seconds_between
from shiftloom.operators import business, charts, stops
from shiftloom.plans.oee import shifts
from shiftloom.plans.oracle import pareto_columns
from shiftloom.plans.registry import FIRST, LAST, query
from shiftloom.sources.bindings import Plant


def totals(p: Plant, recipe: str = "pareto", stop_class: str | None = None, shift: str | None = None):
    wanted = shifts(p, recipe, FIRST, LAST, shift)
    return stops.reason_totals(p.stopages(), p.motives(), p.motive_types(), wanted, stop_class)


def pareto(p: Plant, top: int, recipe: str = "pareto", stop_class: str | None = None):
    return stops.pareto(totals(p, recipe, stop_class), top)


ORDER = "seconds DESC NULLS LAST, type_name NULLS FIRST, motive_name NULLS FIRST, stoppage_type NULLS FIRST, type NULLS FIRST"
SHOWN = '"Duracion_Min" DESC NULLS LAST, "Tipo_General", "Motivo_Particular", "Clasificacion" NULLS FIRST, "Eventos"'


@query("pareto_stops", f"SELECT {pareto_columns()} FROM pareto50")
def pareto_stops(p: Plant):
    return pareto(p, 50)


@query(
    "topn_reasons",
    f"""SELECT n::INT AS top, * EXCLUDE (n) FROM (
      SELECT 10 AS n, {pareto_columns()} FROM (SELECT * FROM reasons ORDER BY {ORDER} LIMIT 10)
      UNION ALL SELECT 20, {pareto_columns()} FROM (SELECT * FROM reasons ORDER BY {ORDER} LIMIT 20)
      UNION ALL SELECT 30, {pareto_columns()} FROM (SELECT * FROM reasons ORDER BY {ORDER} LIMIT 30))""",
)
def topn_reasons(p: Plant):
    rows = totals(p)
    return charts.union_all([stops.pareto(rows, n).withColumn("top", F.lit(n)) for n in (10, 20, 30)])


@query(
    "flt_stop_class",
    f"""SELECT 'NP' AS wanted, {pareto_columns()} FROM (SELECT * FROM reasons WHERE coalesce(stoppage_type, type) = 'NP' ORDER BY {ORDER} LIMIT 30)
      UNION ALL SELECT 'P', {pareto_columns()} FROM (SELECT * FROM reasons WHERE coalesce(stoppage_type, type) = 'P' ORDER BY {ORDER} LIMIT 30)
      UNION ALL SELECT 'todos', {pareto_columns()} FROM (SELECT * FROM reasons ORDER BY {ORDER} LIMIT 30)""",
)
def flt_stop_class(p: Plant):
    return charts.union_all([pareto(p, 30, stop_class=w).withColumn("wanted", F.lit(w)) for w in ("NP", "P", "todos")])


SHARE = f"""WITH t AS (SELECT {pareto_columns()} FROM pareto50),
  s AS (SELECT *, sum("Duracion_Min") OVER () AS total, sum("Duracion_Min") OVER (ORDER BY {SHOWN} ROWS UNBOUNDED PRECEDING) AS run FROM t),
  r AS (SELECT * EXCLUDE (total, run), round_even("Duracion_Min" / total * 100 * 10, 0) / 10 AS "Pct_Total",
    round_even(run / total * 100 * 10, 0) / 10 AS "Pct_Acumulado" FROM s)"""


@query("pareto_share", f"{SHARE} SELECT * FROM r")
def pareto_share(p: Plant):
    return stops.share(pareto(p, 50))


@query("pareto_80", f'{SHARE} SELECT * FROM r WHERE "Pct_Acumulado" <= 80')
def pareto_80(p: Plant):
    return stops.vital_few(stops.share(pareto(p, 50)))


SHARE_ALL = f"""WITH s AS (SELECT *, sum(seconds) OVER ()::DOUBLE AS total,
    coalesce(sum(seconds) OVER (ORDER BY {ORDER} ROWS UNBOUNDED PRECEDING), 0)::DOUBLE AS run FROM reasons),
  r AS (SELECT {pareto_columns()}, CASE WHEN total > 0 THEN round_even(coalesce(seconds, 0)::DOUBLE / total * 100 * 10, 0) / 10 ELSE 0.0 END AS "Pct_Total",
    CASE WHEN total > 0 THEN round_even(run / total * 100 * 10, 0) / 10 ELSE 0.0 END AS "Pct_Acumulado" FROM s)"""


@query("pareto_share_all", f"{SHARE_ALL} SELECT * FROM r")
def pareto_share_all(p: Plant):
    return stops.share_of_all(totals(p))


@query("pareto_80_all", f'{SHARE_ALL} SELECT * FROM r WHERE "Pct_Acumulado" <= 80')
def pareto_80_all(p: Plant):
    return stops.vital_few(stops.share_of_all(totals(p)))


@query(
    "pareto_np_chart",
    f"""WITH t AS (SELECT {pareto_columns()} FROM pareto20),
      k AS (SELECT * FROM t WHERE "Clasificacion" = 'NP' OR NOT EXISTS (SELECT 1 FROM t WHERE "Clasificacion" = 'NP')),
      n AS (SELECT *, row_number() OVER (ORDER BY {SHOWN}) AS rn, round_even("Duracion_Min" * 10, 0) / 10 AS minutes FROM k QUALIFY rn <= 15),
      c AS (SELECT *, round_even(sum(minutes) OVER (ORDER BY rn) / sum(minutes) OVER () * 100 * 10, 0) / 10 AS cum_pct FROM n)
    SELECT rn::INT AS rank, left("Motivo_Particular", 45) AS label, "Tipo_General" AS category, minutes, "Eventos" AS events,
      cum_pct, cum_pct <= 80 AS vital_few FROM c""",
)
def pareto_np_chart(p: Plant):
    return stops.np_chart(pareto(p, 20, "pareto_day_off"))


def _class_totals_sql(rows: str) -> str:
    return f"""WITH t AS (SELECT {pareto_columns()} FROM {rows})
    SELECT coalesce(sum("Eventos") FILTER (WHERE "Clasificacion" = 'NP'), 0)::BIGINT AS np_events,
      coalesce(sum("Duracion_Min") FILTER (WHERE "Clasificacion" = 'NP'), 0.0::DOUBLE) AS np_minutes,
      coalesce(sum("Eventos") FILTER (WHERE "Clasificacion" = 'P'), 0)::BIGINT AS p_events,
      coalesce(sum("Duracion_Min") FILTER (WHERE "Clasificacion" = 'P'), 0.0::DOUBLE) AS p_minutes FROM t"""


@query("stop_class_totals", _class_totals_sql("(SELECT * FROM reasons_work)"))
def stop_class_totals(p: Plant):
    return stops.class_totals(stops.reasons(totals(p, "pareto_day_off")))


@query("stop_class_totals_top", _class_totals_sql("pareto10"))
def stop_class_totals_top(p: Plant):
    """Of the ten longest reasons only, as the older report has it."""
    return stops.class_totals(pareto(p, 10, "pareto_day_off"))


@query(
    "stop_hierarchy",
    f"""WITH t AS (SELECT {pareto_columns()} FROM pareto20)
    SELECT 1 AS level, 'T_' || "Tipo_General" AS node, '' AS parent, "Tipo_General" AS label, NULL::VARCHAR AS stop_class,
      round_even(sum("Duracion_Min") * 10, 0) / 10 AS minutes, sum("Eventos")::BIGINT AS events FROM t GROUP BY "Tipo_General"
    UNION ALL SELECT 2, 'M_' || "Tipo_General" || '_' || left("Motivo_Particular", 45), 'T_' || "Tipo_General", left("Motivo_Particular", 45),
      upper("Clasificacion"), round_even("Duracion_Min" * 10, 0) / 10, "Eventos" FROM t""",
)
def stop_hierarchy(p: Plant):
    return stops.hierarchy(pareto(p, 20, "pareto_day_off"))


@query(
    "join_stop_star",
    """SELECT exec_id, motive_id, type, start_date, end_date, motive_name, stoppage_type, type_name, fecha, turno FROM stop_rows""",
)
def join_stop_star(p: Plant):
    c = F.col
    return stops.stop_star(p.stopages(), p.motives(), p.motive_types(), shifts(p, "pareto")).select(
        c("WorkShiftExecutionId").alias("exec_id"), c("MotiveId").alias("motive_id"), c("Type").alias("type"),
        c("StopStart").alias("start_date"), c("StopEnd").alias("end_date"), c("MotiveName").alias("motive_name"),
        c("StoppageType").alias("stoppage_type"), c("TypeName").alias("type_name"), c("Fecha").alias("fecha"),
        c("Turno").alias("turno"),
    )


@query(
    "null_defaults",
    """SELECT exec_id, motive_id, coalesce(type_name, 'Sin Clasificar') AS type_name,
      coalesce(motive_name, 'Sin Clasificar') AS motive_name, coalesce(seconds, 0) AS seconds FROM stop_rows""",
)
def null_defaults(p: Plant):
    rows = stops.stop_star(p.stopages(), p.motives(), p.motive_types(), shifts(p, "pareto")).select(
        F.col("WorkShiftExecutionId").alias("exec_id"),
        F.col("MotiveId").alias("motive_id"),
        F.col("TypeName").alias("type_name"),
        F.col("MotiveName").alias("motive_name"),
        seconds_between(F.col("StopStart"), F.col("StopEnd")).alias("seconds"),
    )
    labels = {"type_name": stops.UNCLASSIFIED, "motive_name": stops.UNCLASSIFIED}
    return business.null_defaults(rows, labels, ("seconds",))


@query(
    "seconds_between",
    """SELECT event_id, date_diff('second', prev, ts) AS seconds
    FROM (SELECT event_id, ts, TIMESTAMP '2024-01-01 00:00:00.9' AS prev FROM events)""",
)
def seconds_between_query(p: Plant):
    start = F.lit("2024-01-01 00:00:00.9").cast("timestamp_ntz")
    return p.raw("events").select("event_id", seconds_between(start, F.col("ts")).alias("seconds"))


@query(
    "int_avg",
    """SELECT motive_id, CASE WHEN count(s) > 0 THEN (sum(s)::BIGINT // count(s)) / 60.0::DOUBLE END AS minutes
    FROM (SELECT motive_id, date_diff('second', start_date, end_date) AS s FROM stopages) GROUP BY motive_id""",
)
def int_avg_query(p: Plant):
    seconds = seconds_between(F.col("StartDate"), F.col("EndDate"))
    sums = p.stopages().groupBy(F.col("MotiveId").alias("motive_id")).agg(F.sum(seconds).alias("s"), F.count(seconds).alias("n"))
    return sums.select("motive_id", (int_avg(F.col("s"), F.col("n")) / 60.0).alias("minutes"))


@query(
    "clip_label",
    """SELECT doc_id, left(text, 45) AS bar, left(text, 30) AS report,
      CASE WHEN length(c) > 47 THEN left(c, 47) || '...' ELSE c END AS title
    FROM (SELECT doc_id, text, trim(regexp_replace(text, '[\\r\\n]', ' ', 'g'), ' ') AS c FROM documents)""",
)
def clip_label_query(p: Plant):
    from shiftloom.functions.texts import clip_title

    text = F.col("text")
    return p.raw("documents").select(
        "doc_id", clip_label(text, 45).alias("bar"), clip_label(text, 30).alias("report"), clip_title(text).alias("title")
    )
