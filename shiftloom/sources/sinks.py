"""Sinks: CSV, JSON records, appended conversations, bucketed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftloom.operators.conversations import new_threads
from shiftloom.session import scratch_path


def write_once(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to the scratch folder and read from there by everything that follows."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str) -> str:
    """CSV with a header and no index."""
    df.write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path)
    return path


def read_csv(spark, path: str, schema: T.StructType) -> DataFrame:
    reader = spark.read.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return reader.schema(schema).csv(path)


def json_value(field: T.StructField) -> Column:
    """Binary as base64; decimals and clock values as text; other values as they are."""
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.BinaryType):
        return F.base64(col).alias(field.name)
    if isinstance(field.dataType, (T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return col.cast("string").alias(field.name)
    return col.alias(field.name)


def json_records(df: DataFrame) -> DataFrame:
    """One JSON text per row, null fields kept, letters outside ASCII as they are."""
    record = F.struct(*[json_value(f) for f in df.schema.fields])
    return df.select(F.to_json(record, {"ignoreNullFields": "false"}).alias("record"))


def write_json(df: DataFrame, path: str) -> str:
    json_records(df).write.text(path)
    return path


def append_thread(threads_path: str, messages_path: str, messages: DataFrame, user_name: Column) -> None:
    """Append messages, and first the conversations that are not stored yet.

    Messages that are stored already, by conversation and turn, are not stored again, so
    a run may be repeated.
    """
    spark = messages.sparkSession
    stored = spark.read.parquet(threads_path)
    new_threads(stored, messages, user_name).select(*stored.columns).write.mode("append").parquet(threads_path)
    known = spark.read.parquet(messages_path)
    new = messages.join(known.select("thread_id", "turn"), ["thread_id", "turn"], "left_anti")
    new.select(*known.columns).write.mode("append").parquet(messages_path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, sort: list[str] | None = None) -> None:
    """A table bucketed by its join key, so that joins on the key need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key, *(sort or [])).saveAsTable(table)
