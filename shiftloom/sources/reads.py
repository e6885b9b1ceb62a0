"""Sensor read files by day and shift.

Two layouts are read: ``{base}/{day}/{shift...}.parquet`` as delivered, and
``{base}/Day={day}/Shift={shift}`` as written by :func:`write_reads`.
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftloom.functions.texts import SHIFT_WORDS

def days_between(first: str, last: str, limit: int | None = None) -> list[str]:
    """Inclusive list of days; more than ``limit`` is an error."""
    start, end = date.fromisoformat(first), date.fromisoformat(last)
    days = [(start + timedelta(days=i)).isoformat() for i in range((end - start).days + 1)]
    if limit is not None and len(days) > limit:
        raise ValueError(f"at most {limit} days")
    return days


def file_day(path: Column) -> Column:
    """Day folder that holds a file."""
    return F.element_at(F.split(path, "/"), -2).try_cast("date")


def pick_files(paths: DataFrame) -> DataFrame:
    """One file per (day, shift): the first in name order whose name matches the shift.

    A file whose name holds several shift words is a candidate for each of them.
    """
    name = F.lower(F.ltrim(F.substring_index("path", "/", -1)))
    words = F.filter(F.array(*[F.lit(w) for w in SHIFT_WORDS]), lambda w: F.contains(name, F.lower(w)))
    named = paths.where(name.endswith(".parquet")).select("path", file_day(F.col("path")).alias("day"), words.alias("w"))
    return (
        named.select("path", "day", F.explode("w").alias("shift"))
        .groupBy("day", "shift")
        .agg(F.min("path").alias("path"))
    )


def list_files(spark: SparkSession, base: str, days: list[str]) -> DataFrame:
    """Parquet files of the given day folders, names only; days without a folder are left out."""
    folders = "{" + ",".join(days) + "}"
    try:
        files = spark.read.format("binaryFile").load(f"{base}/{folders}/*.[pP][aA][rR][qQ][uU][eE][tT]")
        return files.select("path")
    except AnalysisException as error:
        raise FileNotFoundError(f"no reads for {days[0]} to {days[-1]}") from error


def load_delivered(spark: SparkSession, base: str, days: list[str], shifts: tuple[str, ...] = SHIFT_WORDS) -> DataFrame:
    """Reads of the chosen files of each day and shift, with ``Day`` and ``Shift``.

    Missing shifts and days are skipped; nothing at all is an error. The file
    listing is two names per day and shift, not data.
    """
    chosen = pick_files(list_files(spark, base, days)).where(F.col("shift").isin(*shifts))
    files = sorted((r.shift, r.path) for r in chosen.collect())
    if not files:
        raise FileNotFoundError(f"no reads for {days[0]} to {days[-1]}")
    # a file may serve several shifts: it is read for each, as the reads of that shift
    frames = []
    for shift in sorted({s for s, _ in files}):
        df = spark.read.parquet(*(path for s, path in files if s == shift))
        frames.append(df.withColumns({"Day": file_day(F.col("_metadata.file_path")), "Shift": F.lit(shift)}))
    return reduce(DataFrame.unionByName, frames)


def sensor_key(sensor: Column) -> Column:
    """A sensor id without blanks around it, in upper case."""
    return F.upper(F.trim(sensor))


def write_reads(reads: DataFrame, path: str) -> str:
    """Reads partitioned by day and shift.

    Files are of even size, however many reads an hour has, and sorted by sensor, so that
    a scan for one sensor skips the other row groups. ``SensorKey`` is the sensor id in
    the form to filter by: a filter on a computed form would not reach the scan.
    """
    (
        reads.withColumn("SensorKey", sensor_key(F.col("ProductionLineControlVariableId")))
        .hint("rebalance", "Day", "Shift")
        .sortWithinPartitions("Day", "Shift", "SensorKey", "LocalTime")
        .write.partitionBy("Day", "Shift")
        .parquet(path)
    )
    return path


def load_reads(spark: SparkSession, path: str, first: str | None = None, last: str | None = None, shift: str | None = None) -> DataFrame:
    """Written reads of a day range and shift; both filters prune partitions."""
    df = spark.read.parquet(path)
    if first is not None:
        df = df.where(F.col("Day").between(F.lit(first).cast("date"), F.lit(last or first).cast("date")))
    return df if shift is None else df.where(F.col("Shift") == shift)
