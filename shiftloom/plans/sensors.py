"""Queries over sensor reads and the sensor catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from shiftloom.functions.texts import slug, translate_name
from shiftloom.functions.times import date_spine
from shiftloom.operators import catalog as cat
from shiftloom.operators import charts, matching, quantiles, sensors, states, stops
from shiftloom.operators import intervals as iv
from shiftloom.operators.bundle import day_bundle
from shiftloom.plans.intervals import plant_shifts, plant_star
from shiftloom.plans.oracle import pareto_columns
from shiftloom.plans.registry import EVENT_FIRST, EVENT_LAST, query, rounded
from shiftloom.sources import reads as rd
from shiftloom.session import scratch_path
from shiftloom.sources.bindings import Plant

SUMMARY = "SELECT var_id, name, device, points, out_points, out_pct, avg_value, min_value, max_value FROM summary"
WORST = "out_pct DESC NULLS LAST, out_points DESC, var_id"


def summary(p: Plant):
    return sensors.summary(p.reads(), p.catalog())


@query("sensor_summary", SUMMARY)
def sensor_summary(p: Plant):
    return summary(p)


@query("flt_high_deviation", f"{SUMMARY} WHERE out_pct > 5")
def flt_high_deviation(p: Plant):
    return sensors.high_deviation(summary(p))


@query("worst_variables", f"{SUMMARY} ORDER BY {WORST} LIMIT 3")
def worst_variables(p: Plant):
    return sensors.worst(summary(p))


@query(
    "process_health",
    f"""SELECT format('{{:.1f}}%', 100 - m) AS health, CASE WHEN 100 - m < 70 THEN 'Intervención necesaria' ELSE 'Operación estable' END AS status,
      hot || ' / ' || n AS critical_variables, (SELECT device FROM summary ORDER BY {WORST} LIMIT 1) AS worst_device,
      format('{{:.2f}}%', m) AS mean_out_pct, calm || ' / ' || n AS in_range_variables
    FROM (SELECT avg(coalesce(out_pct, 0)) AS m, count(*) FILTER (WHERE out_pct >= 75) AS hot,
      count(*) FILTER (WHERE coalesce(out_pct, 0) <= 10) AS calm, count(*) AS n FROM summary)""",
)
def process_health(p: Plant):
    return sensors.process_health(summary(p))


@query(
    "exec_summary",
    f"""WITH s AS (SELECT *, row_number() OVER (ORDER BY {WORST}) AS i FROM summary)
    SELECT 'Resumen ejecutivo ({EVENT_FIRST} a {EVENT_LAST}):' || chr(13) || chr(10) || '- Variables críticas analizadas: ' || (SELECT count(*) FROM s)
      || chr(13) || chr(10) || '- Mayor % fuera de crítico: ' || max(CASE WHEN i = 1 THEN name || ' — ' || device || ' (' || out_pct || '%)' END) || chr(13) || chr(10)
      || string_agg('  ' || i || ') ' || name || ' — ' || device || ': ' || out_pct || '% fuera (' || out_points || '/' || points || ' pts)', chr(13) || chr(10) ORDER BY i) AS text
    FROM s WHERE i <= 3""",
)
def exec_summary(p: Plant):
    return sensors.exec_summary(summary(p), EVENT_FIRST, EVENT_LAST)


@query("join_catalog", "SELECT r.var_id, r.seq, coalesce(c.name, r.var_id) AS name, coalesce(c.device, '') AS device FROM reads r LEFT JOIN critical c ON c.var_id = r.var_id")
def join_catalog(p: Plant):
    rows = p.reads().select(F.lower("ProductionLineControlVariableId").alias("var_id"), F.col("ReadSeq").alias("seq"))
    return cat.with_names(rows, p.catalog())


READ_COLUMNS = """var_id AS "ProductionLineControlVariableId", t AS "LocalTime", value AS "Value", lo AS "CriticalMinValue", hi AS "CriticalMaxValue", day AS "Day", shift AS "Shift" """
CRITICAL_READS = f"SELECT {READ_COLUMNS} FROM reads WHERE var_id IN (SELECT var_id FROM critical)"


@query("flt_critical_ids", CRITICAL_READS)
def flt_critical_ids(p: Plant):
    return sensors.critical_reads(p.reads(), p.catalog())


@query(
    "is_out_row",
    "SELECT seq, is_out FROM flagged",
)
def is_out_row(p: Plant):
    return p.reads().select(F.col("ReadSeq").alias("seq"), sensors.is_out_row().alias("is_out"))


BAND = """band AS (SELECT r.*, s.min_val, s.max_val, coalesce(value < min_val, false) OR coalesce(value > max_val, false) AS out_band
  FROM reads r JOIN sensors s ON s.var_id = upper(r.var_id))"""


@query("is_out_band", f"WITH {BAND} SELECT seq, upper(var_id) AS var_id, out_band AS is_out FROM band")
def is_out_band(p: Plant):
    banded = sensors.against_catalog_band(p.reads(), cat.all_sensors(p.catalog()))
    return banded.select(F.col("ReadSeq").alias("seq"), "var_id", "is_out")


@query("split_series", f"WITH {BAND} SELECT seq, upper(var_id) AS var_id, CASE WHEN out_band THEN 'out' ELSE 'in' END AS point_class FROM band WHERE value IS NOT NULL")
def split_series(p: Plant):
    banded = sensors.against_catalog_band(p.reads(), cat.all_sensors(p.catalog()))
    return sensors.split_points(banded).select(F.col("ReadSeq").alias("seq"), "var_id", "point_class")


@query(
    "variable_out_pct",
    f"""WITH {BAND} SELECT upper(var_id) AS var_id, count(*) AS points, count(*) FILTER (WHERE out_band) AS out_points,
      round_even(count(*) FILTER (WHERE out_band)::DOUBLE / count(*) * 100 * 100, 0) / 100 AS out_pct FROM band GROUP BY 1""",
)
def variable_out_pct(p: Plant):
    return sensors.variable_out_pct(sensors.against_catalog_band(p.reads(), cat.all_sensors(p.catalog())))


@query("sensor_median_band", "SELECT var_id, median(lo)::DOUBLE AS band_min, median(hi)::DOUBLE AS band_max FROM reads GROUP BY var_id")
def sensor_median_band(p: Plant):
    return sensors.median_band(p.reads())


QUANTILES = (0.05, 0.5, 0.95)


@query(
    "sensor_value_quantiles",
    f"""SELECT var_id, q::DOUBLE AS quantile, count(value) AS n, CASE q {' '.join(f'WHEN {x} THEN round_even(quantile_cont(value, {x}) * 1e6, 0) / 1e6' for x in QUANTILES)} END AS value
    FROM reads, (SELECT unnest({list(QUANTILES)}) AS q) WHERE value IS NOT NULL GROUP BY var_id, q""",
)
def sensor_value_quantiles(p: Plant):
    reads = p.reads().select(F.lower("ProductionLineControlVariableId").alias("var_id"), F.col("Value").alias("value"))
    return rounded(quantiles.quantiles(reads, "var_id", "value", list(QUANTILES)), 6, "value")


@query(
    "sensor_median_band_unique",
    """SELECT var_id, round_even(median(lo + seq / 1024) * 1e6, 0) / 1e6 AS band_min, round_even(median(hi - seq / 4096) * 1e6, 0) / 1e6 AS band_max FROM reads GROUP BY var_id""",
)
def sensor_median_band_unique(p: Plant):
    """Limits that hardly ever repeat, as those of a control loop that adapts them."""
    drift = {"CriticalMinValue": F.expr("CriticalMinValue + ReadSeq / 1024D"), "CriticalMaxValue": F.expr("CriticalMaxValue - ReadSeq / 4096D")}
    return rounded(quantiles.median_band(p.reads().withColumns(drift)), 6, "band_min", "band_max")


@query(
    "is_out_median_band",
    """SELECT r.seq, r.var_id, coalesce(value < band_min, false) OR coalesce(value > band_max, false) AS is_out
    FROM reads r JOIN (SELECT var_id, median(lo) AS band_min, median(hi) AS band_max FROM reads GROUP BY var_id) b ON b.var_id = r.var_id""",
)
def is_out_median_band(p: Plant):
    return sensors.against_median_band(p.reads()).select(F.col("ReadSeq").alias("seq"), "var_id", "is_out")


@query("series_span", "SELECT var_id, min(t) AS first_time, max(t) AS last_time FROM reads GROUP BY var_id")
def series_span(p: Plant):
    return sensors.span(p.reads())


@query("series_sort", "SELECT seq, t::VARCHAR AS x, value FROM reads ORDER BY x")
def series_sort(p: Plant):
    rows = p.reads().select(F.col("ReadSeq").alias("seq"), F.col("LocalTime").cast("string").alias("x"), F.col("Value").alias("value"))
    return charts.sort_series(rows, "x")


@query("value_counts", "SELECT raw_id AS value, count(*) AS n FROM reads GROUP BY 1 ORDER BY n DESC, value LIMIT 10")
def value_counts(p: Plant):
    return sensors.value_counts(p.reads(), "ProductionLineControlVariableId")


@query("distinct_variables", "SELECT DISTINCT var_id FROM reads ORDER BY 1")
def distinct_variables(p: Plant):
    return sensors.distinct_variables(p.reads())


@query(
    "missing_days",
    f"""SELECT d::DATE AS day FROM (SELECT unnest(generate_series(DATE '{EVENT_FIRST}', DATE '{EVENT_LAST}', INTERVAL 1 DAY)) AS d)
    WHERE d::DATE NOT IN (SELECT day FROM reads)""",
)
def missing_days(p: Plant):
    first, last = F.lit(EVENT_FIRST).cast("date"), F.lit(EVENT_LAST).cast("date")
    return sensors.missing_days(p.reads(), first, last)


@query(
    "date_spine",
    "SELECT line_id, unnest(generate_series(min(day), max(day), INTERVAL 1 DAY))::DATE AS day FROM reads GROUP BY line_id",
)
def date_spine_query(p: Plant):
    ends = p.reads().groupBy(F.col("ProductionLineId").alias("line_id")).agg(F.min("Day").alias("a"), F.max("Day").alias("b"))
    return ends.select("line_id", F.explode(date_spine(F.col("a"), F.col("b"))).alias("day"))


@query("excursion_episodes", "SELECT line_id, var_id, t0, t1, n FROM episodes")
def excursion_episodes(p: Plant):
    return sensors.episodes(p.reads()).select(*_series(), "t0", "t1", "n")


def _series():
    return F.col("ProductionLineId").alias("line_id"), F.lower("ProductionLineControlVariableId").alias("var_id")


@query(
    "excursion_stop_overlap",
    """SELECT e.line_id, e.var_id, t0, t1, n, start_date, end_date, type,
      round_even(extract('epoch' FROM least(t1, end_date) - greatest(t0, start_date)) * 1e4, 0) / 1e4 AS overlap_sec
    FROM episodes e JOIN interval_stops s ON e.line_id = s.line_id AND t0 < end_date AND start_date <= t1""",
)
def excursion_stop_overlap(p: Plant):
    found = sensors.episode_stops(sensors.episodes(p.reads()), p.interval_stops())
    named = found.select(
        *_series(), "t0", "t1", "n", F.col("StartDate").alias("start_date"),
        F.col("EndDate").alias("end_date"), F.col("Type").alias("type"), "overlap_sec",
    )
    return rounded(named, 4, "overlap_sec")


BUNDLE_DAY = "2024-01-15"


@query(
    "day_bundle",
    f"""WITH f AS (SELECT * FROM flagged WHERE day = DATE '{BUNDLE_DAY}' AND var_id IN (SELECT var_id FROM critical)),
      s AS (SELECT g.var_id, c.name, c.device, points, out_points, round_even(out_points::DOUBLE / points * 100 * 100, 0) / 100 AS out_pct,
        round_even(avg_value * 1000, 0) / 1000 AS avg_value, min_value, max_value
        FROM (SELECT var_id, count(value) AS points, count(*) FILTER (WHERE is_out) AS out_points, avg(value) AS avg_value,
          min(value) AS min_value, max(value) AS max_value FROM f GROUP BY var_id) g JOIN critical c ON c.var_id = g.var_id),
      r AS (SELECT type_name, motive_name, stoppage_type, type, sum(seconds)::BIGINT AS seconds, count(seconds) AS timed, count(*) AS events
        FROM plant_stop_rows WHERE fecha = DATE '{BUNDLE_DAY}' GROUP BY ALL
        ORDER BY seconds DESC NULLS LAST, type_name NULLS FIRST, motive_name NULLS FIRST, stoppage_type NULLS FIRST, type NULLS FIRST LIMIT 10),
      rn AS (SELECT {pareto_columns(mean=False)} FROM r),
      o AS (SELECT e.turno, e.tid, x.line_id, x.oee FROM plant_summaries x JOIN plant_executions e ON x.exec_id = e.exec_id WHERE e.fecha = DATE '{BUNDLE_DAY}')
    SELECT 'sensor_summary' AS section, row_number() OVER (ORDER BY {WORST}) AS rank, device || ' — ' || name AS name, out_pct AS value FROM s
    UNION ALL SELECT 'sensors_with_deviations', row_number() OVER (ORDER BY {WORST}), device || ' — ' || name || ': ' || out_pct || '% fuera de rango (avg='
      || avg_value || ', min=' || min_value || ', max=' || max_value || ')', out_pct FROM s WHERE out_pct > 5
    UNION ALL SELECT 'top_paros_del_dia', row_number() OVER (ORDER BY "Duracion_Min" DESC NULLS LAST, "Tipo_General", "Motivo_Particular", "Clasificacion", "Eventos"),
      "Tipo_General" || ' / ' || "Motivo_Particular" || ' / ' || "Clasificacion", "Duracion_Min" FROM rn
    UNION ALL SELECT 'oee_por_turno', row_number() OVER (ORDER BY tid, line_id), turno || ' / ' || line_id, oee FROM o""",
)
def day_bundle_query(p: Plant):
    day = F.lit(BUNDLE_DAY).cast("date")
    reads = sensors.critical_reads(p.reads().where(F.col("Day") == day), p.catalog())
    wanted = plant_shifts(p, "pareto", BUNDLE_DAY, BUNDLE_DAY)
    reasons = stops.pareto(stops.reason_totals(p.plant_stopages(), p.motives(), p.motive_types(), wanted), 10)
    star = plant_star(p, BUNDLE_DAY, BUNDLE_DAY)
    execs = plant_shifts(p, "shift_day", BUNDLE_DAY, BUNDLE_DAY).rows()
    shifts = iv.shift_day(star, p.intervals(), executions=execs)
    return day_bundle(sensors.summary(reads, p.catalog()), reasons, shifts)


@query("src_catalog", "SELECT * FROM sensors")
def src_catalog(p: Plant):
    return cat.all_sensors(p.catalog())


@query(
    "src_critical_catalog",
    "SELECT upper(var_id) AS var_id, trim(name) AS name, trim(device) AS device, min_val AS min, max_val AS max, crit_min, crit_max FROM critical",
)
def src_critical_catalog(p: Plant):
    return cat.critical_sensors(p.catalog())


WORDS = r"list_distinct(regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]+'))"
SHARED = f"list_intersect({WORDS.format('q')}, {WORDS.format('concat_ws(chr(32), name, device)')})"
PHRASES = ("red ring SMALL", "VAR-7", "Gizmo, promo cold!", "zzz nothing")


@query(
    "match_catalog_fuzzy",
    f"""WITH q AS (SELECT unnest([{', '.join(repr(x) for x in PHRASES)}]) AS q),
      k AS (SELECT q, s.*, var_id = upper(trim(q)) AS exact, len({SHARED})::INT AS score FROM q, sensors s)
    SELECT q AS query, var_id, name, device, exact, score FROM k WHERE exact OR score >= 1
    QUALIFY row_number() OVER (PARTITION BY q ORDER BY exact DESC, score DESC, is_critical DESC, device, name, var_id) = 1""",
)
def match_catalog_fuzzy(p: Plant):
    found = [cat.find_sensor(p.catalog(), q).withColumn("query", F.lit(q)) for q in PHRASES]
    return charts.union_all(found).select("query", "var_id", "name", "device", "exact", "score")


# Requests for sensors by id and by words, one for each part.
REQUEST = "CASE p_partkey % 4 WHEN 0 THEN ' var-' || p_partkey || ' ' WHEN 1 THEN upper(p_name) || ', por favor' WHEN 2 THEN p_type || ': ' || p_name || ' zinc' ELSE p_brand END"


@query(
    "match_requests",
    f"""WITH q AS (SELECT p_partkey AS request, {REQUEST} AS q FROM part), s AS (SELECT DISTINCT q FROM q),
      k AS (SELECT q, s2.*, var_id = upper(trim(q)) AS exact, len({SHARED})::INT AS score FROM s, sensors s2),
      best AS (SELECT q, var_id, name, device, exact, score FROM k WHERE exact OR score >= 1
        QUALIFY row_number() OVER (PARTITION BY q ORDER BY exact DESC, score DESC, is_critical DESC, device, name, var_id) = 1)
    SELECT request, var_id, name, device, exact, score FROM q JOIN best USING (q)""",
)
def match_requests(p: Plant):
    requests = p.raw("part").selectExpr("p_partkey AS request", f"{REQUEST} AS text")
    found = matching.find_sensors(p.catalog(), requests, "text")
    return found.select("request", "var_id", "name", "device", "exact", "score")


@query(
    "token_intersection",
    f"""SELECT var_id, array_to_string(list_sort({SHARED}), ' ') AS shared_words FROM sensors, (SELECT 'red ring SMALL bolt' AS q)""",
)
def token_intersection(p: Plant):
    return cat.word_overlap(p.catalog(), "red ring SMALL bolt")


@query(
    "slug",
    """SELECT var_id, regexp_replace(regexp_replace(lower(trim(CASE WHEN device = '' THEN name ELSE device || '_' || name END)), '[^a-zA-Z0-9_-]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug,
      regexp_replace(regexp_replace(lower(trim(' ' || tag || ' / ' || name || ' ñ!')), '[^a-zA-Z0-9_-]+', '_', 'g'), '^_+|_+$', '', 'g') AS tag_slug FROM sensors""",
)
def slug_query(p: Plant):
    rows = cat.file_slug(cat.all_sensors(p.catalog()))
    text = F.concat(F.lit(" "), "tag", F.lit(" / "), "name", F.lit(" ñ!"))
    return rows.select("var_id", "slug", slug(text).alias("tag_slug"))


# A Spanish sensor name for each part, from its number.
SPANISH = (
    "Temperatura interna",
    "temperatura del agua CHILLER {0}",
    "IQF molino {0}",
    "Tiempo de Hidratación volteador",
    "{0}",
    "ALERTAS detector de metales {0}",
    "Presión diferencial IQF",
)


def _duck_steps() -> str:
    """One step per phrase, in order."""
    from shiftloom.functions.texts import SENSOR_PHRASES

    steps = ["t0 AS (SELECT p_partkey, n, trim(n) AS v FROM names)"]
    for i, (phrase, english) in enumerate(SENSOR_PHRASES.items()):
        steps.append(
            f"t{i + 1} AS (SELECT p_partkey, n, CASE WHEN contains(lower(trim(n)), '{phrase}') THEN regexp_replace(v, '{phrase}', '{english}', 'gi') ELSE v END AS v FROM t{i})"
        )
    exact = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SENSOR_PHRASES.items())
    named = " ".join(f"WHEN {i} THEN {chr(39)}{t.replace('{0}', chr(39) + ' || p_name || ' + chr(39))}{chr(39)}" for i, t in enumerate(SPANISH))
    names = f"names AS (SELECT p_partkey, CASE p_partkey % {len(SPANISH)} {named} END AS n FROM part)"
    return (
        f"WITH {names}, " + ", ".join(steps)
        + f" SELECT p_partkey, n AS name, coalesce(CASE lower(trim(n)) {exact} END, v) AS english, n AS spanish FROM t{len(SENSOR_PHRASES)}"
    )


@query("translate_name", _duck_steps())
def translate_name_query(p: Plant):
    number = F.col("p_partkey") % len(SPANISH)
    name = F.lit(None).cast("string")
    for i, template in enumerate(SPANISH):
        before, _, after = template.partition("{0}")
        text = F.concat(F.lit(before), "p_name", F.lit(after)) if "{0}" in template else F.lit(template)
        name = F.when(number == i, text).otherwise(name)
    rows = p.raw("part").select("p_partkey", name.alias("name"))
    return rows.select(
        "p_partkey", "name", translate_name(F.col("name"), "en").alias("english"), translate_name(F.col("name")).alias("spanish")
    )


# --- files -------------------------------------------------------------------


@query("src_critical_reads", f"{CRITICAL_READS} AND shift = 'Segundo'")
def src_critical_reads(p: Plant):
    return sensors.critical_reads(rd.load_reads(p.spark, p.reads_path(), shift="Segundo"), p.catalog())


@query("src_variable_reads", """SELECT t::VARCHAR AS "LocalTime", value AS "Value" FROM reads WHERE var_id = 'var-3' """)
def src_variable_reads(p: Plant):
    return sensors.variable_reads(rd.load_reads(p.spark, p.reads_path()), " var-3")


@query("src_day", f"{CRITICAL_READS} AND day = DATE '2024-01-15'")
def src_day(p: Plant):
    return sensors.critical_reads(rd.load_reads(p.spark, p.reads_path(), "2024-01-15"), p.catalog())


@query("src_range", f"{CRITICAL_READS} AND day BETWEEN DATE '{EVENT_FIRST}' AND DATE '{EVENT_LAST}'")
def src_range(p: Plant):
    return sensors.critical_reads(rd.load_reads(p.spark, p.reads_path(), EVENT_FIRST, EVENT_LAST), p.catalog())


STATES_FIRST, STATES_LAST = "2024-01-10", "2024-02-05"


def stored_states(p: Plant):
    target = scratch_path(p.spark, "states")
    states.refresh(p.spark, p.reads_path(), target)
    return states.stored_states(p.spark, target)


@query("sensor_summary_states", SUMMARY)
def sensor_summary_states(p: Plant):
    return states.merged(stored_states(p), p.catalog())


@query(
    "sensor_summary_states_range",
    f"""SELECT g.var_id, coalesce(c.name, g.var_id) AS name, coalesce(c.device, '') AS device, points, out_points,
      round_even(CASE WHEN points > 0 THEN out_points::DOUBLE / points END * 100 * 100, 0) / 100 AS out_pct,
      round_even(avg_value * 1000, 0) / 1000 AS avg_value, min_value, max_value
    FROM (SELECT var_id, count(value) AS points, count(*) FILTER (WHERE is_out) AS out_points, avg(value) AS avg_value,
        min(value) AS min_value, max(value) AS max_value FROM flagged WHERE day BETWEEN DATE '{STATES_FIRST}' AND DATE '{STATES_LAST}' GROUP BY var_id) g
      LEFT JOIN critical c ON c.var_id = g.var_id""",
)
def sensor_summary_states_range(p: Plant):
    return states.merged(stored_states(p), p.catalog(), STATES_FIRST, STATES_LAST)


UNION = "SELECT var_id, seq, value, day, shift FROM reads"


def _union_columns(df):
    return df.select(
        F.lower("ProductionLineControlVariableId").alias("var_id"), F.col("ReadSeq").alias("seq"),
        F.col("Value").alias("value"), F.col("Day").alias("day"), F.col("Shift").alias("shift"),
    )


@query("union_shifts", UNION)
def union_shifts(p: Plant):
    frames = [rd.load_reads(p.spark, p.reads_path(), shift=s) for s in ("Primer", "Segundo", "Tercer")]
    return _union_columns(charts.union_all(frames))


@query("union_days", UNION)
def union_days(p: Plant):
    halves = [(EVENT_FIRST, "2024-01-15"), ("2024-01-16", EVENT_LAST)]
    return _union_columns(charts.union_all([rd.load_reads(p.spark, p.reads_path(), a, b) for a, b in halves]))


@query("union_files", "SELECT event_id, user_id, ts FROM events UNION ALL SELECT event_id, user_id, ts FROM events")
def union_files(p: Plant):
    path = f"{p.folder}/events.parquet"
    return charts.union_all([p.spark.read.parquet(path)] * 2).select("event_id", "user_id", "ts")


LISTING = """listing AS (
  SELECT 'reads/' || day || '/ ' || shift || '_Turno_' || count(*) || '.parquet' AS path FROM reads GROUP BY day, shift
  UNION ALL SELECT 'reads/' || day || '/z-' || upper(shift) || '.PARQUET' FROM reads GROUP BY day, shift
  UNION ALL SELECT 'reads/' || day || '/' || shift || '_Turno.csv' FROM reads GROUP BY day, shift
  UNION ALL SELECT 'reads/' || day || '/otro.parquet' FROM reads GROUP BY day)"""


@query(
    "src_discover",
    f"""WITH {LISTING} SELECT split_part(path, '/', 2)::DATE AS day, s AS shift, min(path) AS path
    FROM listing, (SELECT unnest(['Primer', 'Segundo', 'Tercer']) AS s)
    WHERE lower(path) LIKE '%.parquet' AND contains(lower(split_part(path, '/', 3)), lower(s)) GROUP BY 1, 2""",
)
def src_discover(p: Plant):
    groups = p.reads().groupBy("Day", "Shift").agg(F.count("*").alias("n"))
    folder = F.concat(F.lit("reads/"), F.col("Day").cast("string"), F.lit("/"))
    names = F.array(
        F.concat(folder, F.lit(" "), "Shift", F.lit("_Turno_"), F.col("n").cast("string"), F.lit(".parquet")),
        F.concat(folder, F.lit("z-"), F.upper("Shift"), F.lit(".PARQUET")),
        F.concat(folder, "Shift", F.lit("_Turno.csv")),
        F.concat(folder, F.lit("otro.parquet")),
    )
    return rd.pick_files(groups.select(F.explode(names).alias("path")).distinct())
