"""The newest interval of each line, kept up to date as interval files arrive.

Takes the place of polling the interval table. The state is one row per line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shiftloom.operators.intervals import newest_per_line
from shiftloom.schemas import schema_of


def stream_intervals(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """Interval rows of Parquet files as they arrive in a folder."""
    reader = spark.readStream.schema(schema_of("intervals")).option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def start_newest(intervals: DataFrame, target: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Keep ``target`` holding the newest row of each line.

    Every batch writes the whole small result to one of two folders, by turns, so a
    batch that runs again after a failure replaces its own folder, and the one before
    stays readable meanwhile.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{target}/turn={number % 2}")

    writer = newest_per_line(intervals).writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.foreachBatch(write).start()


def read_newest(spark: SparkSession, target: str) -> DataFrame:
    """Rows of the latest finished batch."""
    batches = spark.read.parquet(target)
    last = batches.selectExpr("max(batch) AS b").scalar()
    return batches.where(batches["batch"] == last).drop("batch", "turn")
