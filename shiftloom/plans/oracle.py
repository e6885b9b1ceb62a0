"""Check SQL: the plant tables as common table expressions over the benchmark tables."""

from __future__ import annotations

import re

CLOCK = "lpad(({0} // 3600)::VARCHAR, 2, '0') || ':' || lpad(({0} % 3600 // 60)::VARCHAR, 2, '0') || ':' || lpad(({0} % 60)::VARCHAR, 2, '0')"

TABLES: dict[str, str] = {
    "templates": """
        SELECT * FROM (VALUES
          (0, 'Primer Turno', '07:00', '15:30', true, 25200, 55800),
          (1, 'Segundo Turno', '15:30', '23:00', true, 55800, 82800),
          (2, 'Tercer Turno', '23:00', '07:00', true, 82800, 111600)
        ) t(tid, name, start_time, end_time, active, s0, s1)""",
    "executions": """
        SELECT o_orderkey AS exec_id, tid, name AS turno, start_time, end_time,
          o_orderdate + to_seconds(s0) AS start_date, o_orderdate + to_seconds(s1) AS end_date,
          CASE WHEN o_orderstatus = 'P' THEN 'open' ELSE 'closed' END AS status,
          o_orderkey % 50 <> 0 AS active, o_orderpriority = '5-LOW' AS day_off
        FROM orders JOIN templates ON o_orderkey % 3 = tid""",
    "dated": """
        SELECT *, CASE WHEN end_time < start_time THEN CAST(end_date AS DATE) - 1
          ELSE CAST(start_date AS DATE) END AS fecha FROM executions""",
    "summaries": """
        SELECT l_orderkey AS exec_id, l_suppkey AS line_id,
          100 * (1 - l_discount) * (1 - l_discount) * (1 - l_tax) AS oee,
          100 * (1 - l_discount) AS availability, 100 * (1 - l_discount) AS performance,
          CASE WHEN l_linenumber = 6 THEN NULL WHEN l_tax = 0.08 THEN 0.0::DOUBLE ELSE 100 * (1 - l_tax) END AS quality,
          CASE WHEN l_linenumber <> 4 THEN l_linenumber END AS np_cnt,
          CASE WHEN l_returnflag <> 'A' THEN l_linenumber % 3 END AS p_cnt,
          CASE WHEN l_linenumber <> 3 THEN l_quantity * 10 - l_quantity * 10 * (1 - l_discount) END AS np_min,
          l_linenumber * 5.0::DOUBLE AS p_min, l_quantity * 10 + l_linenumber * 5.0::DOUBLE AS duration_min,
          l_quantity * 10 AS available_min, l_quantity * 10 * (1 - l_discount) AS productive_min,
          l_extendedprice * 1.1::DOUBLE AS expected_orig, l_extendedprice AS expected_kg,
          l_extendedprice * (1 - l_discount) AS real_kg,
          CASE WHEN l_linenumber <> 5 THEN l_extendedprice * (1 - l_discount) * l_tax END AS confiscation_kg,
          l_extendedprice / (l_quantity * 10 / 60.0::DOUBLE) AS v_exp,
          l_extendedprice * (1 - l_discount) / (l_quantity * 10 / 60.0::DOUBLE) AS v_cur,
          l_linenumber <> 7 AS active
        FROM lineitem""",
    # Recipes: chat (closed, execution, summary, template), detail (closed, execution,
    # summary, no day off), plain (closed, execution, summary).
    "star_plain": """
        SELECT s.*, d.turno, d.fecha, d.day_off, d.start_date, d.end_date
        FROM summaries s JOIN dated d ON s.exec_id = d.exec_id
        WHERE d.status = 'closed' AND d.active AND s.active""",
    "star_chat": """
        SELECT p.* FROM star_plain p JOIN templates t ON p.turno = t.name WHERE t.active""",
    "star_detail": "SELECT * FROM star_plain WHERE NOT day_off",
    "detail": """
        SELECT fecha AS "Fecha", turno AS "Turno", oee AS "OEE", available_min AS "AvailableTimeMin",
          productive_min AS "ProductiveTimeMin", coalesce(np_min, 0.0::DOUBLE) AS "TiempoNoProdNoProgramadoMin",
          coalesce(p_min, 0.0::DOUBLE) AS "TiempoNoProdProgramadoMin", real_kg AS "CurrentProduction",
          expected_kg AS "ExpectedProduction", quality AS "Quality",
          coalesce(np_cnt, 0) AS "ParosNoProgramadosCont", coalesce(p_cnt, 0) AS "ParosProgramadosCont"
        FROM star_detail""",
    "stopages": """
        SELECT l_partkey AS motive_id, l_orderkey AS exec_id, l_shipdate AS start_date,
          CASE WHEN l_linenumber <> 2 OR l_discount <> 0
            THEN l_shipdate + to_seconds(l_quantity::INT * 60 + l_linenumber * 7) END AS end_date,
          CASE WHEN l_returnflag = 'N' THEN 'P' ELSE 'NP' END AS type, l_linestatus = 'F' AS active
        FROM lineitem""",
    "motives": """
        SELECT p_partkey AS motive_id, p_brand AS type_id, p_name AS name,
          CASE WHEN p_size <= 25 THEN 'NP' WHEN p_size <= 40 THEN 'P' END AS stoppage_type
        FROM part WHERE p_size > 5""",
    "motive_types": """
        SELECT DISTINCT p_brand AS type_id, 'TIPO ' || p_brand AS name FROM part WHERE p_brand <> 'Brand#1'""",
    "stop_rows": """
        SELECT s.*, m.name AS motive_name, m.stoppage_type, mt.name AS type_name, d.fecha, d.turno, d.day_off,
          date_diff('second', s.start_date, s.end_date) AS seconds
        FROM stopages s JOIN dated d ON s.exec_id = d.exec_id
          LEFT JOIN motives m ON s.motive_id = m.motive_id
          LEFT JOIN motive_types mt ON m.type_id = mt.type_id""",
    "reasons": """
        SELECT type_name, motive_name, stoppage_type, type, sum(seconds)::BIGINT AS seconds,
          count(seconds) AS timed, count(*) AS events
        FROM stop_rows WHERE active GROUP BY ALL""",
    "reasons_work": """
        SELECT type_name, motive_name, stoppage_type, type, sum(seconds)::BIGINT AS seconds,
          count(seconds) AS timed, count(*) AS events
        FROM stop_rows WHERE active AND NOT day_off GROUP BY ALL""",
    "pareto50": "SELECT *, 50 AS n FROM (SELECT * FROM reasons ORDER BY seconds DESC NULLS LAST, type_name NULLS FIRST, motive_name NULLS FIRST, stoppage_type NULLS FIRST, type NULLS FIRST LIMIT 50)",
    "pareto20": "SELECT *, 20 AS n FROM (SELECT * FROM reasons_work ORDER BY seconds DESC NULLS LAST, type_name NULLS FIRST, motive_name NULLS FIRST, stoppage_type NULLS FIRST, type NULLS FIRST LIMIT 20)",
    "pareto10": "SELECT *, 10 AS n FROM (SELECT * FROM reasons_work ORDER BY seconds DESC NULLS LAST, type_name NULLS FIRST, motive_name NULLS FIRST, stoppage_type NULLS FIRST, type NULLS FIRST LIMIT 10)",
    "intervals": f"""
        SELECT *, {CLOCK.format('since')} AS since_shift, {CLOCK.format('(since // 2)')} AS productive_text,
          {CLOCK.format('(since // 8)')} AS scheduled_text, {CLOCK.format('(since // 4)')} AS unscheduled_text,
          CASE WHEN seq % 5 = 0 THEN (seq % 1000)::VARCHAR ELSE {CLOCK.format('(seq * 61 % 86400)')} END AS since_status,
          a * p * q / 10000 AS oee
        FROM (SELECT user_id AS line_id, ts AS t, ts + to_seconds(30) AS created_at, event_id AS seq,
          CASE WHEN event_id % 97 = 0 THEN 'MT' WHEN event_type = 'error' THEN 'US' WHEN event_type = 'signup' THEN 'SS'
            WHEN event_type = 'click' THEN 'LP' ELSE 'AV' END AS status,
          50 + value / 10 AS a, (60 + event_id % 50)::DOUBLE AS p, (100 - event_id % 6)::DOUBLE AS q,
          CASE WHEN sod >= 82800 THEN sod - 82800 WHEN sod >= 55800 THEN sod - 55800
            WHEN sod >= 25200 THEN sod - 25200 ELSE sod + 3600 END AS since,
          CASE WHEN event_id % 11 = 0 THEN 0.0::DOUBLE ELSE value * 3 END AS rate, (500 + event_id % 100)::DOUBLE AS rate_exp,
          value * 10 AS shift_kg, value * 9 + 5 AS shift_exp, value * 20 AS day_kg, (4000 + event_id % 500)::DOUBLE AS day_exp
          FROM (SELECT *, (hour(ts) * 3600 + minute(ts) * 60 + second(ts))::INT AS sod FROM events))""",
    "lines": "SELECT DISTINCT user_id AS line_id, 'Linea ' || user_id AS name FROM events",
    "plant_executions": """
        SELECT (year(d) * 10000 + month(d) * 100 + day(d))::BIGINT * 10 + tid AS exec_id, tid, name AS turno, d AS fecha,
          d::TIMESTAMP + to_seconds(s0) AS start_date, d::TIMESTAMP + to_seconds(s1) AS end_date, day(d) % 7 = 0 AS day_off
        FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events), templates""",
    "plant_summaries": """
        SELECT (year(d) * 10000 + month(d) * 100 + day(d))::BIGINT * 10 + tid AS exec_id, line_id, n, v, tid,
          (50 + n) * (80 + tid)::DOUBLE * (100 - tid)::DOUBLE / 10000 AS oee, 50 + n AS a, (80 + tid)::DOUBLE AS p, (100 - tid)::DOUBLE AS q
        FROM (SELECT user_id AS line_id, CAST(ts AS DATE) AS d, count(*)::DOUBLE AS n,
          sum(value::DECIMAL(18,2))::DOUBLE AS v FROM events GROUP BY ALL), templates""",
    "interval_exec": """
        SELECT s.exec_id, s.line_id, i.t, i.seq, i.status,
          lag(i.status) OVER (PARTITION BY s.exec_id, s.line_id ORDER BY i.t, i.seq) AS prev
        FROM plant_summaries s JOIN plant_executions e ON s.exec_id = e.exec_id
          JOIN intervals i ON i.line_id = s.line_id AND i.t >= e.start_date AND i.t < e.end_date""",
    "exec_counts": """
        SELECT s.exec_id, s.line_id,
          count(*) FILTER (WHERE status = 'US' AND (prev IS NULL OR prev <> 'US')) AS np_runs,
          count(*) FILTER (WHERE status = 'SS' AND (prev IS NULL OR prev <> 'SS')) AS p_runs
        FROM plant_summaries s LEFT JOIN interval_exec x ON s.exec_id = x.exec_id AND s.line_id = x.line_id
        GROUP BY ALL""",
    "newest_per_line": """
        SELECT * FROM intervals QUALIFY row_number() OVER (PARTITION BY line_id ORDER BY t DESC, created_at DESC, seq DESC) = 1""",
    "interval_stops": """
        SELECT line_id, t AS start_date, next_t AS end_date, CASE WHEN status = 'US' THEN 'NP' ELSE 'P' END AS type, seq
        FROM (SELECT *, lead(t) OVER (PARTITION BY line_id ORDER BY t, seq) AS next_t FROM intervals)
        WHERE status IN ('US', 'SS') AND next_t IS NOT NULL""",
    "plant_stop_rows": """
        SELECT s.*, m.name AS motive_name, m.stoppage_type, mt.name AS type_name, e.fecha, e.turno, e.day_off,
          date_diff('second', s.start_date, s.end_date) AS seconds
        FROM (SELECT *, CAST(start_date - to_hours(7) AS DATE) AS d,
            hour(start_date) * 3600 + minute(start_date) * 60 + second(start_date) AS sod FROM interval_stops) s
          JOIN plant_executions e ON e.exec_id = (year(s.d) * 10000 + month(s.d) * 100 + day(s.d))::BIGINT * 10
            + CASE WHEN sod BETWEEN 25200 AND 55799 THEN 0 WHEN sod BETWEEN 55800 AND 82799 THEN 1 ELSE 2 END
          LEFT JOIN motives m ON s.line_id = m.motive_id
          LEFT JOIN motive_types mt ON m.type_id = mt.type_id""",
    "plant_reasons": """
        SELECT type_name, motive_name, stoppage_type, type, sum(seconds)::BIGINT AS seconds,
          count(seconds) AS timed, count(*) AS events
        FROM plant_stop_rows WHERE NOT day_off GROUP BY ALL""",
    "plant_pareto10": "SELECT *, 10 AS n FROM (SELECT * FROM plant_reasons ORDER BY seconds DESC NULLS LAST, type_name NULLS FIRST, motive_name NULLS FIRST, stoppage_type NULLS FIRST, type NULLS FIRST LIMIT 10)",
    "catalog": """
        SELECT 'Var-' || p_partkey AS id, CASE WHEN p_size <> 50 THEN p_name END AS name, p_type AS device,
          CASE WHEN p_size <> 49 THEN p_brand END AS tag, CASE WHEN p_size % 10 <> 0 THEN p_size / 10.0::DOUBLE END AS min_value,
          50 + p_size * 2.0::DOUBLE AS max_value, 5.0::DOUBLE AS crit_min, 100 + p_size * 1.0::DOUBLE AS crit_max,
          p_partkey % 3 <> 0 AS is_critical, p_size > 5 AS active
        FROM part""",
    "sensors": """
        SELECT upper(id) AS var_id, coalesce(name, '') AS name, coalesce(device, '') AS device, coalesce(tag, '') AS tag,
          coalesce(min_value, 0.0::DOUBLE) AS min_val, coalesce(max_value, 0.0::DOUBLE) AS max_val, crit_min, crit_max,
          is_critical::INT AS is_critical, active::INT AS active
        FROM catalog WHERE active""",
    "critical": "SELECT lower(var_id) AS var_id, name, device, min_val, max_val, crit_min, crit_max FROM sensors WHERE is_critical = 1",
    "reads": """
        SELECT 'Var-' || ((user_id + event_id % 2) % 12) AS raw_id, 'var-' || ((user_id + event_id % 2) % 12) AS var_id, user_id AS line_id, event_id AS seq, ts AS t,
          CASE WHEN event_id % 37 <> 0 THEN value END AS value, (5 + event_id % 3)::DOUBLE AS lo, (100 + 10 * (event_id % 3))::DOUBLE AS hi,
          CAST(ts - to_hours(7) AS DATE) AS day,
          CASE WHEN sod BETWEEN 25200 AND 55799 THEN 'Primer' WHEN sod BETWEEN 55800 AND 82799 THEN 'Segundo' ELSE 'Tercer' END AS shift
        FROM (SELECT *, hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS sod FROM events)""",
    "flagged": "SELECT *, coalesce(value < lo, false) OR coalesce(value > hi, false) AS is_out FROM reads",
    "summary": """
        SELECT g.var_id, coalesce(c.name, g.var_id) AS name, coalesce(c.device, '') AS device, points, out_points,
          round_even(CASE WHEN points > 0 THEN out_points::DOUBLE / points END * 100 * 100, 0) / 100 AS out_pct,
          round_even(avg_value * 1000, 0) / 1000 AS avg_value, min_value, max_value
        FROM (SELECT var_id, count(value) AS points, count(*) FILTER (WHERE is_out) AS out_points, avg(value) AS avg_value,
            min(value) AS min_value, max(value) AS max_value FROM flagged GROUP BY var_id) g
          LEFT JOIN critical c ON c.var_id = g.var_id""",
    "episodes": """
        SELECT line_id, var_id, min(t) AS t0, max(t) AS t1, count(*) AS n
        FROM (SELECT *, row_number() OVER (PARTITION BY line_id, var_id ORDER BY t, seq)
            - row_number() OVER (PARTITION BY line_id, var_id, is_out ORDER BY t, seq) AS g FROM flagged)
        WHERE is_out GROUP BY line_id, var_id, g""",
    "messages": """
        SELECT 'thread_' || conv_id AS thread_id, conv_id, turn, role, text,
          CASE WHEN role = 'assistant' THEN '["static/plots/p_' || conv_id || '.html", "static/plots/q_' || turn || '.png"]'
            WHEN turn % 4 = 0 THEN '{bad' END AS images,
          TIMESTAMP '2024-01-01' + to_days((conv_id % 60)::INT) + to_minutes(turn) AS created_at
        FROM conversations""",
    "titles": """
        SELECT thread_id, CASE WHEN length(c) > 47 THEN left(c, 47) || '...' ELSE c END AS title
        FROM (SELECT thread_id, trim(regexp_replace(arg_min(text, turn), '[\\r\\n]', ' ', 'g')) AS c
          FROM messages WHERE role = 'user' GROUP BY thread_id)""",
    "threads": """
        SELECT m.thread_id, 'u' || (any_value(conv_id) % 5) AS user_name, coalesce(any_value(title), '') AS title,
          min(created_at) AS created_at, any_value(conv_id) % 7 <> 0 AS active
        FROM messages m LEFT JOIN titles t ON m.thread_id = t.thread_id GROUP BY m.thread_id""",
}


def with_tables(body: str) -> str:
    """Prefix the tables that ``body`` names, in order of dependence."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in TABLES:
            if name not in needed and re.search(rf"(\bFROM|\bJOIN|,)\s*{name}\b", text):
                visit(TABLES[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    body = body.strip()
    own = body[4:].lstrip() if body.upper().startswith("WITH ") else None
    ctes = ",\n".join(f"{n} AS ({TABLES[n]})" for n in needed)
    return f"WITH {ctes},\n{own}" if own else f"WITH {ctes}\n{body}"


def duration_text(minutes: str) -> str:
    """Spanish duration text of a minutes expression."""
    n = f"CAST(round_even(({minutes})::DOUBLE, 0) AS BIGINT)"

    def part(size: str, one: str, many: str) -> str:
        return f"CASE WHEN {size} = 1 THEN '1 {one}' WHEN {size} > 1 THEN ({size})::VARCHAR || ' {many}' END"

    parts = ", ".join(
        [
            part(f"({n} // 1440)", "día", "días"),
            part(f"({n} % 1440 // 60)", "hora", "horas"),
            part(f"({n} % 60)", "minuto", "minutos"),
        ]
    )
    return (
        f"CASE WHEN ({minutes}) > 0 AND {n} > 0 THEN "
        f"regexp_replace(concat_ws(', ', {parts}), ', ([^,]*)$', ' y \\1') ELSE '0 minutos' END"
    )


def minutes_text(expr: str) -> str:
    """Whole minutes of a clock text."""
    return f"(split_part({expr}, ':', 1)::INT * 60 + split_part({expr}, ':', 2)::INT)"


def pareto_columns(mean: bool = True) -> str:
    cols = """coalesce(type_name, 'Sin Clasificar') AS "Tipo_General", coalesce(motive_name, 'Sin Clasificar') AS "Motivo_Particular",
      coalesce(stoppage_type, type) AS "Clasificacion", seconds / 60.0::DOUBLE AS "Duracion_Min", events AS "Eventos" """
    mean_col = ', CASE WHEN timed > 0 THEN (seconds // timed) / 60.0::DOUBLE END AS "Duracion_Promedio_Min"'
    return cols + (mean_col if mean else "")
