"""Queries on sensor excursions that go with stops."""

from __future__ import annotations

from pyspark.sql import functions as F

from shiftloom.operators import association as assoc
from shiftloom.operators import sensors
from shiftloom.plans.registry import query, rounded
from shiftloom.sources.bindings import Plant

WIDTH, FIRST_LAG, LAST_LAG = 1800, -4, 12

LAGS = f"""
WITH span AS (SELECT line_id, min(floor(epoch(t) / {WIDTH}))::BIGINT AS b0, (max(floor(epoch(t) / {WIDTH})) - min(floor(epoch(t) / {WIDTH})) + 1)::BIGINT AS n
    FROM reads GROUP BY line_id),
  ev AS (SELECT DISTINCT line_id, var_id, floor(epoch(t0) / {WIDTH})::BIGINT - b0 AS b, span.n FROM episodes JOIN span USING (line_id)),
  halt AS (SELECT * FROM (SELECT DISTINCT line_id, type, floor(epoch(start_date) / {WIDTH})::BIGINT - b0 AS b, span.n FROM interval_stops JOIN span USING (line_id))
    WHERE b BETWEEN 0 AND n - 1),
  lags AS (SELECT unnest(range({FIRST_LAG}, {LAST_LAG + 1}))::INTEGER AS lag),
  evs AS (SELECT line_id, var_id, count(*) AS ne, any_value(n) AS n FROM ev GROUP BY ALL),
  halts AS (SELECT line_id, type, lag, count(*) FILTER (WHERE b - lag BETWEEN 0 AND n - 1) AS nh FROM halt, lags GROUP BY ALL),
  met AS (SELECT ev.line_id, var_id, type, lag, count(*) AS k FROM ev JOIN halt USING (line_id) JOIN lags ON halt.b = ev.b + lag GROUP BY ALL),
  found AS (SELECT line_id, var_id, type, lag, coalesce(k, 0) AS together, ne * nh / n::DOUBLE AS expected
    FROM evs JOIN halts USING (line_id) LEFT JOIN met USING (line_id, var_id, type, lag))"""


def onset_lags(p: Plant):
    onsets = sensors.episodes(p.reads()).select(
        F.col("ProductionLineId").alias("line_id"), F.lower("ProductionLineControlVariableId").alias("var_id"), "t0"
    )
    stops = p.interval_stops().select(F.col("ProductionLineId").alias("line_id"), F.col("Type").alias("type"), "StartDate")
    observed = p.reads().select(F.col("ProductionLineId").alias("line_id"), "LocalTime")
    return assoc.lag_counts(
        onsets, stops, observed, "line_id", ["var_id"], ["type"], width=WIDTH, first=FIRST_LAG, last=LAST_LAG
    )


@query(
    "excursion_stop_lags",
    f"{LAGS} SELECT line_id, var_id, type, lag, together, round_even(expected * 1e6, 0) / 1e6 AS expected FROM found",
)
def excursion_stop_lags(p: Plant):
    return rounded(onset_lags(p), 6, "expected")


@query(
    "excursion_stop_association",
    f"""{LAGS}, total AS (SELECT var_id, type, lag, sum(together)::BIGINT AS together, sum(expected::DECIMAL(38,10))::DOUBLE AS e FROM found GROUP BY ALL),
      scored AS (SELECT *, CASE WHEN e > 0 THEN round(together / e, 4) END AS lift, CASE WHEN e > 0 THEN round((together - e) / sqrt(e), 4) END AS strength FROM total),
      best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY var_id, type ORDER BY strength DESC NULLS LAST, abs(lag), lag DESC) = 1)
    SELECT var_id, type, lag, together, round_even(e * 1e4, 0) / 1e4 AS expected, lift, strength,
      row_number() OVER (PARTITION BY var_id ORDER BY strength DESC NULLS LAST, type)::INTEGER AS rank FROM best""",
)
def excursion_stop_association(p: Plant):
    return rounded(assoc.association(onset_lags(p), ["var_id"], ["type"]), 4, "expected")
