"""Sensor reads: out-of-range rules, summaries, bands, episodes and their overlap with stops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftloom.functions.numbers import divide_or_null, fixed, round_py
from shiftloom.functions.times import epoch_second
from shiftloom.operators.catalog import critical_ids, with_names
from shiftloom.operators.ordered import runs
from shiftloom.sources.reads import sensor_key


def out_of(value: Column, low: Column, high: Column) -> Column:
    """Outside a band; a comparison with null counts as inside."""
    return F.coalesce(value < low, F.lit(False)) | F.coalesce(value > high, F.lit(False))


def is_out_row() -> Column:
    """Against the read's own critical limits."""
    return out_of(F.col("Value"), F.col("CriticalMinValue"), F.col("CriticalMaxValue"))


def critical_reads(reads: DataFrame, catalog: DataFrame) -> DataFrame:
    """Reads of critical sensors, id in lower case."""
    var_id = F.lower("ProductionLineControlVariableId")
    kept = reads.select(
        var_id.alias("ProductionLineControlVariableId"),
        "LocalTime",
        F.col("Value").cast("double").alias("Value"),
        F.col("CriticalMinValue").cast("double").alias("CriticalMinValue"),
        F.col("CriticalMaxValue").cast("double").alias("CriticalMaxValue"),
        "Day",
        "Shift",
    )
    ids = critical_ids(catalog)
    return kept.join(ids, kept["ProductionLineControlVariableId"] == ids["var_id"], "left_semi")


def of_sensor(reads: DataFrame, var_id: str) -> DataFrame:
    """Reads of one sensor. On written reads the filter reaches the scan."""
    wanted = var_id.strip().upper()
    if "SensorKey" in reads.columns:
        return reads.where(F.col("SensorKey") == wanted)
    return reads.where(sensor_key(F.col("ProductionLineControlVariableId")) == wanted)


def variable_reads(reads: DataFrame, var_id: str) -> DataFrame:
    """Time and value of one sensor, critical or not."""
    return of_sensor(reads, var_id).select(
        F.col("LocalTime").cast("string").alias("LocalTime"), F.col("Value").cast("double").alias("Value")
    )


def summary(reads: DataFrame, catalog: DataFrame) -> DataFrame:
    """Per sensor: non-null reads, reads out of their critical limits, mean, extremes, name; worst first."""
    per_sensor = reads.groupBy(F.lower("ProductionLineControlVariableId").alias("var_id")).agg(
        F.count("Value").alias("points"),
        F.count_if(is_out_row()).alias("out_points"),
        F.avg("Value").alias("avg_value"),
        F.min("Value").alias("min_value"),
        F.max("Value").alias("max_value"),
    )
    return named_summary(per_sensor, catalog)


def named_summary(per_sensor: DataFrame, catalog: DataFrame) -> DataFrame:
    """Counts, mean and extremes of each sensor with its share of reads that are out, and its name; worst first."""
    return with_names(per_sensor, catalog).select(
        "var_id",
        "name",
        "device",
        "points",
        "out_points",
        round_py(divide_or_null(F.col("out_points"), F.col("points")) * 100, 2).alias("out_pct"),
        round_py(F.col("avg_value"), 3).alias("avg_value"),
        "min_value",
        "max_value",
    ).orderBy(F.desc_nulls_last("out_pct"), F.desc("out_points"), "var_id")


def worst(summary_rows: DataFrame, n: int = 3) -> DataFrame:
    return summary_rows.orderBy(F.desc_nulls_last("out_pct"), F.desc("out_points"), "var_id").limit(n)


def high_deviation(summary_rows: DataFrame, limit: float = 5.0) -> DataFrame:
    return summary_rows.where(F.coalesce("out_pct", F.lit(0.0)) > limit)


def _median(reads: DataFrame, column: str) -> DataFrame:
    """Exact median per sensor, from running counts over its distinct limit values.

    The window holds one row for each limit value and spills; nothing is buffered whole.
    """
    counted = (
        reads.where(F.col(column).isNotNull())
        .groupBy(F.lower("ProductionLineControlVariableId").alias("var_id"), F.col(column).cast("double").alias("_v"))
        .agg(F.count("*").alias("_n"))
    )
    sensor = Window.partitionBy("var_id")
    upto = sensor.orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counted.withColumns({"_upto": F.sum("_n").over(upto), "_all": F.sum("_n").over(sensor)})

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("_upto") >= rank, F.col("_v")))

    middle = (at(F.floor((F.col("_all") + 1) / 2)) + at(F.floor((F.col("_all") + 2) / 2))) / 2
    return placed.groupBy("var_id").agg(middle.alias("_m"))


def median_band(reads: DataFrame) -> DataFrame:
    """Median critical limits of each sensor's series.

    Reads are counted per (sensor, limit value) first, so a sensor with many reads
    arrives at its median as few rows as it had limit settings.
    """
    low = _median(reads, "CriticalMinValue").withColumnRenamed("_m", "band_min")
    high = _median(reads, "CriticalMaxValue").withColumnRenamed("_m", "band_max")
    return low.join(high, "var_id", "full")


def against_median_band(reads: DataFrame) -> DataFrame:
    """Reads with ``is_out`` against the series' median limits."""
    keyed = reads.withColumn("var_id", F.lower("ProductionLineControlVariableId"))
    banded = keyed.join(median_band(reads), "var_id", "left")
    return banded.withColumn("is_out", out_of(F.col("Value"), F.col("band_min"), F.col("band_max")))


def against_catalog_band(reads: DataFrame, sensors: DataFrame) -> DataFrame:
    """Reads with ``is_out`` against the fixed operating band of the catalog (``min_val``, ``max_val``)."""
    keyed = reads.withColumn("var_id", F.upper("ProductionLineControlVariableId"))
    banded = keyed.join(sensors.select("var_id", "min_val", "max_val"), "var_id")
    return banded.withColumn("is_out", out_of(F.col("Value"), F.col("min_val"), F.col("max_val")))


def split_points(banded: DataFrame) -> DataFrame:
    """``point_class`` in or out; reads without a value are left out of both series."""
    return banded.where(F.col("Value").isNotNull()).withColumn("point_class", F.when(F.col("is_out"), "out").otherwise("in"))


def variable_out_pct(banded: DataFrame) -> DataFrame:
    """Per sensor: all reads (nulls counted), out reads and percentage, against the catalog band."""
    return banded.groupBy("var_id").agg(F.count("*").alias("points"), F.count_if("is_out").alias("out_points")).withColumn(
        "out_pct", round_py(F.col("out_points") / F.col("points") * 100, 2)
    )


def span(reads: DataFrame) -> DataFrame:
    """First and last time of each series."""
    return reads.groupBy(F.lower("ProductionLineControlVariableId").alias("var_id")).agg(
        F.min("LocalTime").alias("first_time"), F.max("LocalTime").alias("last_time")
    )


def distinct_variables(reads: DataFrame) -> DataFrame:
    return (
        reads.where(F.col("ProductionLineControlVariableId").isNotNull())
        .select(F.lower("ProductionLineControlVariableId").alias("var_id"))
        .distinct()
        .orderBy("var_id")
    )


def value_counts(df: DataFrame, column: str, top: int = 10) -> DataFrame:
    """Most frequent values."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "value")
        .limit(top)
    )


def missing_days(reads: DataFrame, first: Column, last: Column) -> DataFrame:
    """Days of an inclusive range without any read."""
    seen = reads.select(F.col("Day").alias("day")).distinct()
    spine = reads.sparkSession.range(1).select(F.explode(F.sequence(first, last)).alias("day"))
    return spine.join(seen, "day", "left_anti")


def process_health(summary_rows: DataFrame) -> DataFrame:
    """Health figures over the sensors of a summary."""
    pct = F.coalesce("out_pct", F.lit(0.0))
    figures = summary_rows.agg(
        F.avg(pct).alias("mean_out"),
        F.count_if(pct >= 75).alias("critical"),
        F.count_if(pct <= 10).alias("in_range"),
        F.count("*").alias("sensors"),
        F.min(F.struct((-pct).alias("p"), (-F.col("out_points")).alias("o"), F.col("var_id").alias("v"), "device")).alias("w"),
    )
    health = 100 - F.col("mean_out")
    return figures.where("sensors > 0").select(
        fixed(health, 1, "%").alias("health"),
        F.when(health < 70, "Intervención necesaria").otherwise("Operación estable").alias("status"),
        F.concat_ws(" / ", F.col("critical").cast("string"), F.col("sensors").cast("string")).alias("critical_variables"),
        F.coalesce("w.device", F.lit("N/A")).alias("worst_device"),
        fixed(F.col("mean_out"), 2, "%").alias("mean_out_pct"),
        F.concat_ws(" / ", F.col("in_range").cast("string"), F.col("sensors").cast("string")).alias("in_range_variables"),
    )


def exec_summary(summary_rows: DataFrame, first: str, last: str, top: int = 3) -> DataFrame:
    """Summary text: number of sensors, the worst one and the top three."""
    total = summary_rows.agg(F.count("*")).scalar()
    c = F.col
    ranked = worst(summary_rows, top).select(
        F.struct(
            (-F.coalesce("out_pct", F.lit(-1.0))).alias("k"), (-c("out_points")).alias("o"), "var_id",
            F.concat_ws(" — ", "name", "device").alias("label"), c("out_pct").cast("string").alias("pct"),
            F.concat(c("out_points").cast("string"), F.lit("/"), c("points").cast("string")).alias("ratio"),
        ).alias("r")
    )
    rows = ranked.agg(F.array_sort(F.collect_list("r")).alias("rows")).where(F.size("rows") > 0)
    lines = F.transform(
        "rows",
        lambda r, i: F.concat(
            F.lit("  "), (i + 1).cast("string"), F.lit(") "), r["label"], F.lit(": "), r["pct"], F.lit("% fuera ("), r["ratio"],
            F.lit(" pts)"),
        ),
    )
    head = F.array(
        F.lit(f"Resumen ejecutivo ({first} a {last}):"),
        F.concat(F.lit("- Variables críticas analizadas: "), total.cast("string")),
        F.concat(F.lit("- Mayor % fuera de crítico: "), c("rows")[0]["label"], F.lit(" ("), c("rows")[0]["pct"], F.lit("%)")),
    )
    return rows.select(F.array_join(F.concat(head, lines), "\r\n").alias("text"))


def deviation_text() -> Column:
    """One line about a deviating sensor of a summary."""
    c = F.col
    return F.concat(
        c("device"), F.lit(" — "), c("name"), F.lit(": "), c("out_pct").cast("string"), F.lit("% fuera de rango (avg="),
        c("avg_value").cast("string"), F.lit(", min="), c("min_value").cast("string"), F.lit(", max="),
        c("max_value").cast("string"), F.lit(")"),
    )


SERIES = ["ProductionLineId", "ProductionLineControlVariableId"]


def episodes(reads: DataFrame) -> DataFrame:
    """Runs of consecutive out-of-range reads of each line's sensors: first read, last read, reads."""
    by = SERIES
    flagged = reads.select(*by, "LocalTime", "ReadSeq", is_out_row().alias("is_out"))
    return runs(flagged, by, "LocalTime", "ReadSeq", "is_out")


# Bucket widths, in seconds, at which spans of time meet: second, minute, hour, day.
SPAN_WIDTHS = (1, 60, 3600, 86400)


def _levelled(df: DataFrame, start: str, end: str) -> DataFrame:
    """Spans with their first and last second, and the smallest width that is not shorter than they are."""
    spans = df.withColumns({"_s": epoch_second(F.col(start)), "_e": epoch_second(F.col(end))})
    length = F.col("_e") - F.col("_s")
    level = F.lit(SPAN_WIDTHS[-1])
    for width in reversed(SPAN_WIDTHS[:-1]):
        level = F.when(length <= width, F.lit(width)).otherwise(level)
    return spans.withColumn("_level", level)


def _listed(spans: DataFrame, widths: Column) -> DataFrame:
    """Spans listed under each bucket they cover, at each of the given widths."""
    at_width = spans.withColumn("_width", F.explode(widths))
    first, last = F.floor(F.col("_s") / F.col("_width")), F.floor(F.col("_e") / F.col("_width"))
    return at_width.withColumn("_bucket", F.explode(F.sequence(first, F.greatest(first, last)))).drop("_s", "_e", "_level")


def episode_stops(episodes_df: DataFrame, stops: DataFrame) -> DataFrame:
    """Episodes and stops of the same line that overlap in time, with the sensor and the overlap in seconds.

    An episode lasts from its first to its last read, both included, so a single
    read is a moment; a stop ends when the next status begins.

    Two spans meet in buckets as wide as the longer one. So short spans only meet
    within seconds, however many there are in an hour, and a long span is listed
    under few buckets. A pair is reported in the bucket in which its overlap begins.
    """
    left = _levelled(episodes_df.select(*SERIES, "t0", "t1", "n"), "t0", "t1")
    right = _levelled(stops.select("ProductionLineId", "StartDate", "EndDate", "Type"), "StartDate", "EndDate")
    widths = F.array(*[F.lit(w) for w in SPAN_WIDTHS])
    own = F.array("_level")
    from_own, above_own = (
        F.filter(widths, lambda w: w >= F.col("_level")),
        F.filter(widths, lambda w: w > F.col("_level")),
    )
    keys = ["ProductionLineId", "_width", "_bucket"]
    stop_is_longer = _listed(left, from_own).join(_listed(right, own), keys)
    episode_is_longer = _listed(left, own).join(_listed(right, above_own), keys)
    begins = F.floor(epoch_second(F.greatest("t0", "StartDate")) / F.col("_width"))
    pairs = stop_is_longer.unionByName(episode_is_longer).where(
        (F.col("t0") < F.col("EndDate")) & (F.col("StartDate") <= F.col("t1")) & (F.col("_bucket") == begins)
    )
    overlap = F.least("t1", "EndDate") - F.greatest("t0", "StartDate")
    seconds = F.extract(F.lit("DAY"), overlap) * 86400 + F.extract(F.lit("HOUR"), overlap) * 3600
    seconds = seconds + F.extract(F.lit("MINUTE"), overlap) * 60 + F.extract(F.lit("SECOND"), overlap)
    return pairs.withColumn("overlap_sec", seconds.cast("double")).drop("_width", "_bucket")
