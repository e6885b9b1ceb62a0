"""Sensor catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftloom.functions.texts import slug, word_set


def all_sensors(catalog: DataFrame) -> DataFrame:
    """Active sensors, empty text and 0 for nulls, critical ones first."""

    def text(name: str):
        return F.coalesce(F.col(name), F.lit(""))

    def number(name: str):
        return F.coalesce(F.col(name), F.lit(0.0))

    return (
        catalog.where("Active")
        .select(
            F.upper("ProductionLineControlVariableId").alias("var_id"),
            text("Name").alias("name"),
            text("DeviceName").alias("device"),
            text("Tag").alias("tag"),
            number("MinValue").alias("min_val"),
            number("MaxValue").alias("max_val"),
            number("CriticalMinValue").alias("crit_min"),
            number("CriticalMaxValue").alias("crit_max"),
            F.col("IsCritical").cast("int").alias("is_critical"),
            F.col("Active").cast("int").alias("active"),
        )
        .orderBy(F.desc("is_critical"), "device", "name", "var_id")
    )


def critical_sensors(catalog: DataFrame) -> DataFrame:
    """Critical and active sensors with their limits, names trimmed."""
    return (
        all_sensors(catalog.where("IsCritical"))
        .select(
            F.trim("var_id").alias("var_id"),
            F.trim("name").alias("name"),
            F.trim("device").alias("device"),
            F.col("min_val").alias("min"),
            F.col("max_val").alias("max"),
            "crit_min",
            "crit_max",
        )
        .orderBy("device", "name", "var_id")
    )


def critical_ids(catalog: DataFrame) -> DataFrame:
    return catalog.where("IsCritical AND Active").select(
        F.lower(F.trim("ProductionLineControlVariableId")).alias("var_id")
    )


def with_names(df: DataFrame, catalog: DataFrame, key: str = "var_id") -> DataFrame:
    """Name and device of critical sensors; an unknown id is its own name."""
    known = critical_sensors(catalog).select(
        F.lower("var_id").alias("_id"), F.col("name").alias("_name"), F.col("device").alias("_device")
    )
    joined = df.join(known, F.lower(F.col(key)) == F.col("_id"), "left")
    return joined.withColumns(
        {"name": F.coalesce("_name", F.col(key)), "device": F.coalesce("_device", F.lit(""))}
    ).drop("_id", "_name", "_device")


def file_slug(df: DataFrame) -> DataFrame:
    """File-safe name of a sensor: device and name, or the id where it is not in the catalog."""
    named = F.when(F.col("device") == "", F.col("name")).otherwise(F.concat_ws("_", "device", "name"))
    return df.withColumn("slug", slug(named))


def find_sensor(catalog: DataFrame, query: str) -> DataFrame:
    """The sensor meant by an id or by free words: an exact id wins, then most shared words.

    Ties go to the first in catalog order; at least one word must be shared.
    """
    sensors = all_sensors(catalog)
    wanted = word_set(F.lit(query))
    shared = F.size(F.array_intersect(wanted, word_set(F.concat_ws(" ", "name", "device"))))
    exact = F.col("var_id") == query.strip().upper()
    scored = sensors.withColumns({"exact": exact, "score": shared}).where("exact OR score >= 1")
    return scored.orderBy(
        F.desc("exact"), F.desc("score"), F.desc("is_critical"), "device", "name", "var_id"
    ).limit(1)


def word_overlap(catalog: DataFrame, query: str) -> DataFrame:
    """Shared distinct words of each active sensor with a query."""
    wanted = word_set(F.lit(query))
    words = word_set(F.concat_ws(" ", "name", "device"))
    return all_sensors(catalog).select(
        "var_id", F.array_join(F.array_sort(F.array_intersect(wanted, words)), " ").alias("shared_words")
    )
