"""Queries over conversations."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from shiftloom.functions import texts
from shiftloom.operators import conversations as ops
from shiftloom.plans.registry import query
from shiftloom.session import scratch_path
from shiftloom.sources import retention
from shiftloom.sources.bindings import Plant

NOW = "2024-02-20 00:00:00"


@query("message_order", "SELECT thread_id, turn, row_number() OVER (PARTITION BY thread_id ORDER BY created_at, turn) AS position FROM messages")
def message_order(p: Plant):
    return ops.message_order(p.messages()).select("thread_id", "turn", "position")


@query("thread_index", "SELECT user_name, thread_id, title, created_at FROM threads WHERE active ORDER BY user_name, created_at DESC")
def thread_index(p: Plant):
    return ops.thread_index(p.threads())


@query(
    "thread_history",
    """SELECT thread_id, turn, created_at, role, text,
      CASE WHEN role = 'assistant' THEN 'static/plots/p_' || conv_id || '.html|static/plots/q_' || turn || '.png' ELSE '' END AS images
    FROM messages WHERE NOT starts_with(text, '[system_date=') AND NOT starts_with(text, '[system:')""",
)
def thread_history(p: Plant):
    return ops.thread_history(p.messages()).withColumn("images", F.array_join("images", "|"))


@query(
    "thread_retention",
    f"""SELECT t.thread_id, t.user_name, t.created_at, count(m.turn) AS messages FROM threads t JOIN messages m ON t.thread_id = m.thread_id
    WHERE t.created_at >= TIMESTAMP '{NOW}' - INTERVAL 30 DAY GROUP BY ALL""",
)
def thread_retention(p: Plant):
    threads, messages = ops.retention(p.threads(), p.messages(), F.lit(NOW).cast("timestamp_ntz"))
    counts = messages.groupBy("thread_id").agg(F.count("*").alias("messages"))
    return threads.join(counts, "thread_id").select("thread_id", "user_name", "created_at", "messages")


@query(
    "thread_retention_months",
    f"""SELECT t.thread_id, strftime(t.created_at, '%Y-%m') AS month, count(m.turn) AS messages FROM threads t LEFT JOIN messages m ON t.thread_id = m.thread_id
    WHERE t.created_at >= TIMESTAMP '{NOW}' - INTERVAL 30 DAY GROUP BY ALL
    UNION ALL SELECT NULL, 'orphans', count(*) FILTER (WHERE thread_id NOT IN (SELECT thread_id FROM threads)) FROM messages""",
)
def thread_retention_months(p: Plant):
    """Conversations left in the stored tables after one run, and messages left whose conversation is not."""
    paths = [scratch_path(p.spark, name) for name in ("threads", "messages")]
    tables = p.threads(), p.messages()
    retention.write_months(*tables, *paths)
    retention.expire(p.spark, *paths, datetime.fromisoformat(NOW))
    threads, messages = (retention.read_months(p.spark, path, df.schema) for path, df in zip(paths, tables))
    counts = messages.groupBy("thread_id").agg(F.count("*").alias("messages"))
    kept = threads.join(counts, "thread_id", "left").select(
        "thread_id", F.col("Month").alias("month"), F.coalesce("messages", F.lit(0).cast("long")).alias("messages")
    )
    left = messages.join(threads, "thread_id", "left_anti").agg(F.count("*").alias("messages"))
    return kept.unionByName(left.select(F.lit(None).cast("string").alias("thread_id"), F.lit("orphans").alias("month"), "messages"))


# Endings that make the intent rules fire on some turns of each conversation.
ENDINGS = (
    " ¿Cuál es el OEE actual?",
    " Dame el turno de ayer",
    " ```sql select 1```",
    " Invalid object name: no existe la tabla",
    " SELECT a FROM b",
    "",
    " snapshot de la semana",
)


def _with_endings(p: Plant):
    turn = F.col("turn") + F.col("conv_id")
    ending = F.element_at(F.array(*[F.lit(e) for e in ENDINGS]), (turn % len(ENDINGS) + 1).cast("int"))
    text = F.when(turn % 10 == 9, F.lit("  Hola!? ")).otherwise(F.concat("text", ending))
    return p.messages().withColumn("text", text)


def _duck_any(words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(l, '{w}')" for w in words) + ")"


ENDING_SQL = f"""WITH m AS (SELECT thread_id, turn, lower(CASE WHEN (turn + conv_id) % 10 = 9 THEN '  Hola!? '
  ELSE text || list_extract([{', '.join(repr(e) for e in ENDINGS)}], ((turn + conv_id) % {len(ENDINGS)} + 1)::INT) END) AS l FROM messages)"""


@query(
    "message_intent",
    f"""{ENDING_SQL} SELECT thread_id, turn, rtrim(trim(l), '!?.') IN ({', '.join(repr(g) for g in texts.GREETINGS)}) AS greeting,
      {_duck_any(texts.KPI_WORDS)} AS asks_kpi, {_duck_any(texts.REALTIME_WORDS)} AND NOT {_duck_any(texts.HISTORY_WORDS)} AS realtime,
      contains(l, '```sql') OR (contains(l, 'select ') AND contains(l, ' from ')) AS looks_like_sql,
      contains(l, 'invalid object name') OR (contains(l, 'no existe') AND contains(l, 'tabla')) AS bad_object FROM m""",
)
def message_intent(p: Plant):
    flagged = ops.intent(_with_endings(p))
    return flagged.select("thread_id", "turn", "greeting", "asks_kpi", "realtime", "looks_like_sql", "bad_object")


@query(
    "plot_link_extract",
    """SELECT thread_id, turn,
      'static/plots/oee_' || conv_id || '.html|static/plots/s_' || turn || '.png' AS paths,
      CASE WHEN turn % 2 = 0 THEN 'Serie' ELSE 'Gráfico de OEE' END || '|Gráfico de Sensor' AS captions,
      regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS clean_text FROM messages""",
)
def plot_link_extract(p: Plant):
    conv, turn = F.col("conv_id").cast("string"), F.col("turn").cast("string")
    first = F.concat(F.lit("https://plant.example/static/plots/oee_"), conv, F.lit(".html"))
    mark = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("![Serie]("), first, F.lit(")"))).otherwise(
        F.concat(F.lit("[abrir]("), first, F.lit(")"))
    )
    second = F.concat(F.lit("sandbox:/static/plots/s_"), turn, F.lit(".png"))
    again = F.concat(F.lit("/static/plots/oee_"), conv, F.lit(".html"))
    text = F.concat_ws(" ", mark, "text", second, again)
    found = ops.plot_links(p.messages().withColumn("text", text))
    return found.select(
        "thread_id", "turn", F.array_join("paths", "|").alias("paths"), F.array_join("captions", "|").alias("captions"), "clean_text"
    )


@query(
    "speech_text",
    """SELECT doc_id, trim(regexp_replace(regexp_replace(text,
      '[*_`#>|\\[\\]()!]', '', 'g'), '\\s+', ' ', 'g')) AS spoken FROM documents""",
)
def speech_text(p: Plant):
    return p.raw("documents").select("doc_id", texts.speech_text(F.col("text")).alias("spoken"))
