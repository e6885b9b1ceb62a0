"""Sensor summaries of long ranges from stored states of single days.

A state holds what the summary of a sensor's reads on one day can be merged from: counts,
the sum, the extremes. States are stored by day. Only the days whose read files changed are
read again, and their partitions alone are replaced. A summary of any range then merges
states, one row for each day and sensor, and reads no raw read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftloom.operators.sensors import is_out_row, named_summary
from shiftloom.sources.reads import load_reads

SCHEMA = "var_id string, points long, out_points long, total decimal(38,10), min_value double, max_value double, mark string, Day date"


def daily_states(reads: DataFrame) -> DataFrame:
    """One row per day and sensor. Sums are exact to ten places, so merging follows no order."""
    value = F.col("Value").cast("double")
    return reads.groupBy("Day", F.lower("ProductionLineControlVariableId").alias("var_id")).agg(
        F.count(value).alias("points"),
        F.count_if(is_out_row()).alias("out_points"),
        F.sum(value.try_cast("decimal(38,10)")).alias("total"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
    )


def file_marks(spark: SparkSession, path: str) -> DataFrame:
    """Per day of written reads a mark of its files: names, sizes and times. Nothing of their content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    day = F.regexp_extract("path", r"/Day=([^/]+)/", 1).try_cast("date")
    each = F.xxhash64("path", "length", "modificationTime")
    mark = F.concat_ws("-", F.count("*"), F.sum("length"), F.bit_xor(each))
    return files.select("path", "length", "modificationTime").groupBy(day.alias("Day")).agg(mark.alias("mark")).where("Day IS NOT NULL")


def stored_states(spark: SparkSession, target: str) -> DataFrame | None:
    """Stored rows of ``refresh``: a day's states, and one row without a sensor that marks the files they came from."""
    try:
        return spark.read.schema(SCHEMA).parquet(target)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def refresh(spark: SparkSession, path: str, target: str) -> list[str]:
    """Bring the states in ``target`` up to date with the reads in ``path``; the days that were read again.

    The days of files that are gone keep a mark and no states. A refresh that failed half way
    is mended by the next one: a day counts as up to date only by the mark in its own
    partition, which is replaced as a whole. Files that change meanwhile have another mark
    than the one that is stored, so the next refresh reads them. Days are what reaches the
    driver, one of the calendar each.
    """
    marks = file_marks(spark, path)
    stored = stored_states(spark, target)
    known = spark.createDataFrame([], "Day date, mark string") if stored is None else stored.where("var_id IS NULL AND mark IS NOT NULL")
    both = marks.alias("f").join(known.select("Day", "mark").alias("s"), "Day", "full")
    changed = both.where("f.mark IS DISTINCT FROM s.mark").select("Day", "f.mark")
    changed = changed.where("f.mark IS NOT NULL OR s.mark <> ''").select("Day", F.coalesce("f.mark", F.lit("")).alias("mark"))
    rows = sorted(changed.collect(), key=lambda r: r.Day)
    if not rows:
        return []
    days = [r.Day for r in rows]
    own = daily_states(load_reads(spark, path).where(F.col("Day").isin(days))).withColumn("mark", F.lit(None).cast("string"))
    # reads without a sensor id are a sensor of their own, told from the mark by having none
    marked = spark.createDataFrame(rows, "Day date, mark string")
    new = own.unionByName(marked, allowMissingColumns=True)
    writer = new.repartition("Day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("Day").parquet(target)
    return [d.isoformat() for d in days]


def merged(states: DataFrame, catalog: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """The sensor summary of an inclusive range of days, merged from their states."""
    kept = states.where("mark IS NULL")
    if first is not None:
        kept = kept.where(F.col("Day").between(F.lit(first).cast("date"), F.lit(last or first).cast("date")))
    per_sensor = kept.groupBy("var_id").agg(
        F.sum("points").alias("points"),
        F.sum("out_points").alias("out_points"),
        F.sum("total").alias("_total"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
    )
    mean = F.try_divide(F.col("_total").cast("double"), F.col("points").cast("double"))
    return named_summary(per_sensor.withColumn("avg_value", mean).drop("_total"), catalog)
