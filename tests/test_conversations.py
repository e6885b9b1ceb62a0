from datetime import datetime, timedelta

from pyspark.sql import functions as F

from shiftloom.operators import conversations as ops
from shiftloom.schemas import schema_of
from shiftloom.sources import sinks

BEGIN = datetime(2026, 1, 1, 9)


def messages(spark, rows):
    """Rows are (thread, turn, role, text, images, minutes)."""
    return spark.createDataFrame(
        [(t, n, r, x, i, BEGIN + timedelta(minutes=m)) for t, n, r, x, i, m in rows], schema_of("messages")
    )


def test_order_and_titles(spark):
    rows = [("a", 2, "user", "segunda", None, 5), ("a", 1, "user", "primera\nlínea", None, 0), ("a", 0, "assistant", "hola", None, 0)]
    out = ops.message_order(messages(spark, rows)).orderBy("position").collect()
    assert [(r.turn, r.position) for r in out] == [(0, 1), (1, 2), (2, 3)]
    assert [tuple(r) for r in ops.titles(messages(spark, rows)).collect()] == [("a", "primera línea")]


def test_history_hides_system_and_reads_images(spark):
    rows = [
        ("a", 0, "user", "[system: x]", None, 0),
        ("a", 1, "user", "hola", "", 1),
        ("a", 2, "assistant", "ok", '["p.html"]', 2),
        ("a", 3, "assistant", "ok", "{bad", 3),
    ]
    out = ops.thread_history(messages(spark, rows)).collect()
    assert [(r.turn, r.images) for r in out] == [(1, []), (2, ["p.html"]), (3, [])]
    assert ops.thread_history(messages(spark, rows), hide_system=False).count() == 4


def test_index_and_retention(spark):
    threads = spark.createDataFrame(
        [("a", "u", "A", BEGIN, True), ("b", "u", "B", BEGIN + timedelta(days=1), True), ("c", "v", "C", BEGIN, False)],
        schema_of("threads"),
    )
    assert [r.thread_id for r in ops.thread_index(threads, "u").collect()] == ["b", "a"]
    rows = messages(spark, [("a", 0, "user", "x", None, 0), ("b", 0, "user", "x", None, 0)])
    kept, left = ops.retention(threads, rows, F.lit(BEGIN + timedelta(days=30, seconds=1)))
    assert [r.thread_id for r in kept.collect()] == ["b"] and [r.thread_id for r in left.collect()] == ["b"]
    assert ops.retention(threads, rows, F.lit(BEGIN + timedelta(days=30)))[0].count() == 3


def test_plot_links(spark):
    text = (
        "Ver ![Mi gráfica](https://h/static/plots/a.html) y [otra](/static/plots/OEE_b.png) "
        "sandbox:/static/plots/a.html static/plots/c.gif static/plots/d.JPG fin"
    )
    out = ops.plot_links(messages(spark, [("a", 0, "assistant", text, None, 0)])).first()
    assert out.paths == ["static/plots/a.html", "static/plots/OEE_b.png", "static/plots/d.JPG"]
    assert out.captions == ["Mi gráfica", "Gráfico de OEE", "Gráfico de Sensor"]
    assert out.clean_text == "Ver  y   static/plots/c.gif  fin"


def test_append_thread(spark, tmp_path):
    threads, store = str(tmp_path / "threads"), str(tmp_path / "messages")
    spark.createDataFrame([("a", "u", "viejo", BEGIN, True)], schema_of("threads")).write.parquet(threads)
    messages(spark, [("a", 0, "user", "x", None, 0)]).write.parquet(store)
    new = messages(spark, [("a", 1, "user", "más", None, 9), ("b", 0, "user", "nuevo hilo", None, 9), ("b", 1, "assistant", "ok", None, 10)])
    sinks.append_thread(threads, store, new, F.lit("w"))
    got = {r.thread_id: (r.user_name, r.title) for r in spark.read.parquet(threads).collect()}
    assert got == {"a": ("u", "viejo"), "b": ("w", "nuevo hilo")}
    assert spark.read.parquet(store).count() == 4
    sinks.append_thread(threads, store, new, F.lit("w"))
    assert spark.read.parquet(store).count() == 4 and spark.read.parquet(threads).count() == 2
    silent = messages(spark, [("c", 0, "assistant", "hola", None, 20)])
    sinks.append_thread(threads, store, silent, F.lit("w"))
    assert [r.title for r in spark.read.parquet(threads).where("thread_id = 'c'").collect()] == [""]


def test_message_order_keeps_messages_without_time_or_thread(spark):
    rows = messages(spark, [("a", 0, "user", "x", None, 0), ("a", 1, "user", "y", None, 1), (None, 0, "user", "z", None, 0)])
    rows = rows.withColumn("created_at", F.when(F.col("turn") == 0, F.col("created_at")))
    out = ops.message_order(rows).collect()
    assert sorted((r.thread_id or "", r.turn, r.position) for r in out) == [("", 0, 1), ("a", 0, 2), ("a", 1, 1)]
