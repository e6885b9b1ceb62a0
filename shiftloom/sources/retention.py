"""Conversations stored by the month they began, and retention that touches expired months only.

Threads and messages are partitioned by the month in which the thread was created, so all
that can expire lies in months up to that of the limit. Months before it go as folders,
without being read; of the limit's own month the rows that stay are written anew, by dynamic
partition overwrite; later months keep their files.

Messages go before their threads. A run that fails in between leaves threads that are still
expired, so the next run takes up where it ended, and a run that has nothing to do changes
nothing.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Month of threads without a creation time and of messages without a stored thread; these stay.
NO_MONTH = "none"


def write_months(threads: DataFrame, messages: DataFrame, threads_path: str, messages_path: str) -> None:
    """Both tables by the month in which a message's thread began, as column ``Month``."""
    month = F.coalesce(F.date_format("created_at", "yyyy-MM"), F.lit(NO_MONTH))
    dated = threads.withColumn("Month", month)
    _write(dated, threads_path)
    of_thread = dated.groupBy("thread_id").agg(F.max("Month").alias("Month"))
    placed = messages.join(of_thread, "thread_id", "left").withColumn("Month", F.coalesce("Month", F.lit(NO_MONTH)))
    _write(placed.select(*messages.columns, "Month"), messages_path)


def _write(df: DataFrame, path: str) -> None:
    # few files a month, and many tasks for a month that holds a large share of the rows
    df.hint("rebalance", "Month").write.partitionBy("Month").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def read_months(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table of ``write_months`` with its months as text; ``schema`` is that of its rows, as no file may be left."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("Month", T.StringType())])).parquet(path)


def _month(spark: SparkSession, path: str, month: str) -> DataFrame | None:
    """The rows of one month, none where nothing is stored of it."""
    if month not in dict(_months(spark, path)):
        return None
    return spark.read.parquet(path).withColumn("Month", F.col("Month").cast("string")).where(F.col("Month") == month)


def expire(spark: SparkSession, threads_path: str, messages_path: str, now: datetime, days: int = 30) -> list[str]:
    """Drop threads created before ``now`` less ``days``, and their messages; the months that were changed.

    The names of months reach the driver, one of the calendar each. A thread id is stored
    once: with several times of creation the month of its messages is that of the last.
    """
    limit = now - timedelta(days=days)
    own = f"{limit:%Y-%m}"
    changed = set()
    threads, messages = (_month(spark, path, own) for path in (threads_path, messages_path))
    old = F.col("created_at") < F.lit(limit).cast("timestamp_ntz")
    split = threads is not None and not threads.where(old).isEmpty()
    if split:
        if messages is not None:
            _replace(messages, messages.join(threads.where(old).select("thread_id"), "thread_id", "left_anti"), messages_path)
        changed.add(own)
    for path in (messages_path, threads_path):
        for month, folder in _months(spark, path):
            if month != NO_MONTH and month < own:
                _delete(spark, folder)
                changed.add(month)
    if split:
        _replace(threads, threads.where(~old), threads_path)
    return sorted(changed)


def _replace(before: DataFrame, after: DataFrame, path: str) -> None:
    """Put the rows that stay in place of a month; a month that none stays of is deleted."""
    if after.isEmpty():
        month = before.select("Month").first()
        if month is not None:
            for name, folder in _months(before.sparkSession, path):
                if name == month.Month:
                    _delete(before.sparkSession, folder)
        return
    _write(after.select(*before.columns), path)


def _files(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path in its form."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _months(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    system, where = _files(spark, path)
    folders = [entry.getPath() for entry in system.listStatus(where) if entry.isDirectory()]
    return [(f.getName().removeprefix("Month="), f.toString()) for f in folders if f.getName().startswith("Month=")]


def _delete(spark: SparkSession, folder: str) -> None:
    system, where = _files(spark, folder)
    system.delete(where, True)
