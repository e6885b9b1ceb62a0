"""Queries through the sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from shiftloom.operators import conversations as conv
from shiftloom.plans.registry import query
from shiftloom.schemas import schema_of
from shiftloom.session import scratch_path
from shiftloom.sources import sinks, tables
from shiftloom.sources.bindings import Plant


@query("src_table", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def src_table(p: Plant):
    return tables.read_table(
        p.spark, f"{p.folder}/orders.parquet", ["o_orderkey", "o_orderdate", "o_totalprice"], F.col("o_orderstatus") == "F"
    )


@query(
    "src_inline",
    """SELECT label, count(*) AS n FROM (VALUES ('error', 'Paro No Programado'), ('signup', 'Paro Programado')) t(code, label)
    JOIN events ON event_type = code GROUP BY label""",
)
def src_inline(p: Plant):
    labels = tables.inline(p.spark, [["error", "Paro No Programado"], ["signup", "Paro Programado"]], ["code", "label"])
    events = p.raw("events")
    return events.join(labels, events["event_type"] == labels["code"]).groupBy("label").agg(F.count("*").alias("n"))


READS = """raw_id AS "ProductionLineControlVariableId", line_id AS "ProductionLineId", seq AS "ReadSeq", t AS "LocalTime", value AS "Value",
  0.0::DOUBLE AS "MinValue", 400.0::DOUBLE AS "MaxValue", lo AS "CriticalMinValue", hi AS "CriticalMaxValue", day AS "Day", shift AS "Shift" """


@query("sink_csv", f"SELECT {READS} FROM reads")
def sink_csv(p: Plant):
    path = sinks.write_csv(p.reads(), scratch_path(p.spark, "csv"))
    return sinks.read_csv(p.spark, path, schema_of("reads"))


@query(
    "sink_json",
    """SELECT to_json({'id': event_id, 'ts': ts::VARCHAR, 'kind': base64(event_type::BLOB), 'label': 'línea ' || user_id,
      'amount': value::DECIMAL(18,2)::VARCHAR, 'odd': CASE WHEN event_id % 2 = 1 THEN user_id END})::VARCHAR AS record FROM events""",
)
def sink_json(p: Plant):
    c = F.col
    rows = p.raw("events").select(
        c("event_id").alias("id"),
        "ts",
        c("event_type").cast("binary").alias("kind"),
        F.concat(F.lit("línea "), c("user_id").cast("string")).alias("label"),
        c("value").cast("decimal(18,2)").alias("amount"),
        F.when(c("event_id") % 2 == 1, c("user_id")).alias("odd"),
    )
    path = sinks.write_json(rows, scratch_path(p.spark, "json"))
    return p.spark.read.text(path).select(c("value").alias("record"))


@query(
    "sink_append_thread",
    """SELECT t.thread_id, t.user_name, t.title, t.created_at, true AS active, count(m.turn) AS messages
    FROM threads t JOIN messages m ON m.thread_id = t.thread_id GROUP BY ALL""",
)
def sink_append_thread(p: Plant):
    """Old conversations are stored first; then all messages arrive, with the conversations that are new."""
    cut = F.lit("2024-01-31").cast("timestamp_ntz")
    messages = p.messages().drop("conv_id")
    threads_path, messages_path = scratch_path(p.spark, "threads"), scratch_path(p.spark, "messages")
    old = p.threads().where(F.col("created_at") < cut).withColumn("active", F.lit(True))
    old.write.parquet(threads_path)
    messages.limit(0).write.parquet(messages_path)
    sinks.append_thread(threads_path, messages_path, messages, p.user_name())
    counts = p.spark.read.parquet(messages_path).groupBy("thread_id").agg(F.count("*").alias("messages"))
    stored = p.spark.read.parquet(threads_path)
    return stored.join(counts, "thread_id").select("thread_id", "user_name", "title", "created_at", "active", "messages")


@query("thread_titles", "SELECT thread_id, title FROM titles")
def thread_titles(p: Plant):
    return conv.titles(p.messages())
