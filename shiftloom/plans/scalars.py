"""Queries that run the scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from shiftloom.functions import numbers, texts, times
from shiftloom.operators import charts
from shiftloom.plans.oracle import duration_text, minutes_text
from shiftloom.plans.registry import query, rounded
from shiftloom.sources.bindings import Plant

LINE = ("l_orderkey", "l_linenumber")
MINUTES = "l_quantity * l_linenumber * 37.0::DOUBLE - 400"


@query("format_duration", f"SELECT l_orderkey, l_linenumber, l_partkey, {duration_text(MINUTES)} AS text FROM lineitem")
def format_duration(p: Plant):
    minutes = F.col("l_quantity") * F.col("l_linenumber") * 37.0 - 400
    return p.raw("lineitem").select(*LINE, "l_partkey", times.format_duration(minutes).alias("text"))


@query(
    "parse_duration_text",
    f"""SELECT seq, CASE WHEN contains(since_status, ':') THEN {minutes_text('since_status')} ELSE right(since_status, 2)::INT END AS status_min,
      TRY_CAST(right(status, 2) AS INT) AS code_min FROM intervals""",
)
def parse_duration_text(p: Plant):
    return p.intervals().select(
        F.col("IntervalSeq").alias("seq"),
        times.parse_duration_text(F.col("TimeSinceLastStatusChange")).alias("status_min"),
        times.parse_duration_text(F.col("IntervalProductionLineStatus")).alias("code_min"),
    )


@query(
    "minutes_of_time",
    f"SELECT seq, {minutes_text('productive_text')} AS productive, CASE WHEN contains(since_status, ':') THEN {minutes_text('since_status')} END AS since FROM intervals",
)
def minutes_of_time(p: Plant):
    return p.intervals().select(
        F.col("IntervalSeq").alias("seq"),
        times.minutes_of_time(F.col("EffectiveAvailableTime")).alias("productive"),
        times.minutes_of_time(F.col("TimeSinceLastStatusChange")).alias("since"),
    )


@query(
    "parse_day",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 5 THEN 'lote ' || o_orderkey WHEN o_orderkey % 7 = 6 THEN ''
      ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""",
)
def parse_day(p: Plant):
    day, key = F.col("o_orderdate").cast("timestamp_ntz"), F.col("o_orderkey")
    text = (
        F.when(key % 7 == 0, F.concat(F.lit("  "), F.date_format(day, "yyyy-MM-dd")))
        .when(key % 7 == 1, F.date_format(day, "dd/MM/yyyy"))
        .when(key % 7 == 2, F.date_format(day, "d MMM yyyy"))
        .when(key % 7 == 3, F.date_format(day, "yyyy/MM/dd"))
        .when(key % 7 == 4, F.date_format(day, "d.M.yyyy"))
        .when(key % 7 == 5, F.concat(F.lit("lote "), key.cast("string")))
    )
    return p.raw("orders").select("o_orderkey", times.parse_day(text).alias("day"))


@query(
    "normalize_shift",
    """SELECT exec_id, CASE WHEN status = 'open' THEN NULL ELSE split_part(turno, ' ', 1) END AS shift FROM executions""",
)
def normalize_shift(p: Plant):
    rows = p.executions().join(p.templates().drop("Active"), "WorkShiftTemplateId")
    text = F.when(F.col("Status") == "open", "turno extra").otherwise(F.concat(F.lit("  "), F.upper("Name")))
    return rows.select(F.col("WorkShiftExecutionId").alias("exec_id"), texts.normalize_shift(text).alias("shift"))


@query("round_sql", "SELECT l_orderkey, l_linenumber, l_partkey, round(l_quantity / 2, 0) AS half, round(l_extendedprice / 7, 3) AS seventh FROM lineitem")
def round_sql(p: Plant):
    return p.raw("lineitem").select(
        *LINE,
        "l_partkey",
        numbers.round_sql(F.col("l_quantity") / 2, 0).alias("half"),
        numbers.round_sql(F.col("l_extendedprice") / 7, 3).alias("seventh"),
    )


@query(
    "round_py",
    """SELECT l_orderkey, l_linenumber, l_partkey, round_even(l_quantity / 2, 0) AS half,
      round_even(l_extendedprice / 7 * 1000, 0) / 1000 AS seventh FROM lineitem""",
)
def round_py(p: Plant):
    return p.raw("lineitem").select(
        *LINE,
        "l_partkey",
        numbers.round_py(F.col("l_quantity") / 2, 0).alias("half"),
        numbers.round_py(F.col("l_extendedprice") / 7, 3).alias("seventh"),
    )


@query(
    "fmt_number",
    """SELECT l_orderkey, l_linenumber, l_partkey, format('{:.1f}%', l_extendedprice / 7) AS pct, format('{:,.0f}', l_extendedprice / 7) AS kg,
      format('{:.2f}', l_extendedprice / 7) AS two, l_linenumber || ' ev.' AS events FROM lineitem""",
)
def fmt_number(p: Plant):
    value = F.col("l_extendedprice") / 7
    return p.raw("lineitem").select(
        *LINE,
        "l_partkey",
        numbers.fixed(value, 1, "%").alias("pct"),
        numbers.grouped(value).alias("kg"),
        numbers.fixed(value, 2).alias("two"),
        numbers.events_text(F.col("l_linenumber")).alias("events"),
    )


@query(
    "period_label",
    """SELECT exec_id, CASE WHEN start_date::DATE = end_date::DATE THEN start_date::DATE::VARCHAR ELSE start_date::DATE || ' a ' || end_date::DATE END AS label FROM executions""",
)
def period_label(p: Plant):
    return p.executions().select(
        F.col("WorkShiftExecutionId").alias("exec_id"),
        times.period_label(F.to_date("StartDate"), F.to_date("EndDate")).alias("label"),
    )


@query(
    "num_coerce",
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN value WHEN 1 THEN NULL ELSE event_id::DOUBLE END AS number,
      CASE event_id % 3 WHEN 0 THEN value WHEN 1 THEN 0 ELSE event_id::DOUBLE END AS or_zero FROM events""",
)
def num_coerce(p: Plant):
    rest = F.col("event_id") % 3
    text = F.when(rest == 0, F.col("value").cast("string")).when(rest == 1, F.col("props"))
    text = text.otherwise(F.concat(F.lit(" "), F.col("event_id").cast("string")))
    return p.raw("events").select(
        "event_id", numbers.num_coerce(text).alias("number"), numbers.num_coerce(text, 0.0).alias("or_zero")
    )


@query("numeric_columns", "SELECT event_id, user_id, value FROM events")
def numeric_columns(p: Plant):
    return charts.select_numeric(p.raw("events"))


def _duck_corr() -> str:
    names = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    value = {n: n for n in names} | {"l_tax": "CASE WHEN l_linenumber <> 3 THEN l_tax END"}
    cells = [
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round_even(corr({value[a]}, {value[b]}) * 1e4, 0) / 1e4 AS corr FROM lineitem"
        for a in names
        for b in names
    ]
    return " UNION ALL ".join(cells)


@query("corr_matrix", _duck_corr())
def corr_matrix(p: Plant):
    tax = F.when(F.col("l_linenumber") != 3, F.col("l_tax")).alias("l_tax")
    rows = p.raw("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", tax)
    return rounded(charts.correlation(rows), 4, "corr")


@query(
    "profile_columns",
    """SELECT count(*) AS row_count, count(DISTINCT raw_id) AS distinct_keys, count(DISTINCT t) AS distinct_times, min(t) AS min_time, max(t) AS max_time FROM reads""",
)
def profile_columns(p: Plant):
    return charts.profile(p.reads(), "ProductionLineControlVariableId", "LocalTime")
