"""Exact quantiles of many series at once, by selecting ranks in histograms.

No series is ordered. Each round counts the values of the ranges that still hold a wanted
rank in a bounded number of bins, and keeps the one bin that the rank falls into. The first
round has a bin for each power of two, so that what is left is one of them at most; each
later round divides that by ``BINS``. A range that holds one value only is decided, which
leaves five rounds for any doubles and two or three for usual ones.

A round reads the rows once and sends one row for each bin in use and task. A series of any
size is never in one task: windows run over the bins of a range, ``BINS`` at most.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftloom.session import scratch_path

BINS = 4096
# Above the exponent of any double, so that infinities have bins of their own.
BEYOND = 1100


def quantiles(df: DataFrame, by: str, value: str, wanted: list[float]) -> DataFrame:
    """``by``, ``quantile``, ``n`` and ``value`` for each series and wanted quantile from 0 to 1.

    Between two ranks the value is interpolated. Nulls and NaN are left out, and so are
    series without other values. Rows of a null series are a series. 0 and -0 are equal; the
    middle of two infinities of unlike sign is NaN.
    """
    if not wanted or not all(0 <= q <= 1 for q in wanted):
        raise ValueError("quantiles from 0 to 1")
    rows = df.select(F.col(f"`{by}`").alias("_by"), F.col(f"`{value}`").cast("double").alias("_v"))
    rows = rows.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    bins = _counted(rows.withColumns({"_lo": F.lit(0.0), "_hi": F.lit(0.0), "_bin": _power(F.col("_v"))}))
    places = _placed(_stored(bins, "bins"), wanted)
    wide = F.col("_lo") < F.col("_hi")
    while True:
        places = _stored(places, "ranks")
        open_ranges = places.where(wide).select("_by", "_lo", "_hi").distinct()
        if open_ranges.isEmpty():
            break
        places = places.where(~wide).unionByName(_narrowed(rows, open_ranges, places.where(wide)))
    return _interpolated(places).withColumnRenamed("_by", by)


def median_band(reads: DataFrame) -> DataFrame:
    """Median critical limits of each sensor, as ``sensors.median_band``, for limits with any number of values."""
    sensor = F.lower("ProductionLineControlVariableId")
    limits = [
        F.struct(F.struct(sensor.alias("var_id"), F.lit(out).alias("end")).alias("series"), F.col(column).cast("double").alias("v"))
        for column, out in (("CriticalMinValue", "band_min"), ("CriticalMaxValue", "band_max"))
    ]
    medians = quantiles(reads.select(F.inline(F.array(*limits))), "series", "v", [0.5])
    ends = [F.max(F.when(F.col("series.end") == end, F.col("value"))).alias(end) for end in ("band_min", "band_max")]
    return medians.groupBy(F.col("series.var_id").alias("var_id")).agg(*ends)


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _power(v: Column) -> Column:
    """Sign and power of two of a value as one number that never falls as the value grows."""
    power = F.least(F.greatest(F.floor(F.log2(F.abs(v))), F.lit(-BEYOND)), F.lit(BEYOND)) + BEYOND + 1
    return F.when(v > 0, power).when(v < 0, -power).otherwise(0).cast("long")


def _counted(binned: DataFrame) -> DataFrame:
    """Rows, least and largest value of each bin of each range."""
    return binned.groupBy("_by", "_lo", "_hi", "_bin").agg(
        F.count("*").alias("_n"), F.min("_v").alias("_from"), F.max("_v").alias("_to")
    )


def _placed(bins: DataFrame, wanted: list[float]) -> DataFrame:
    """The bins that hold the two ranks about each wanted quantile, after the first round."""
    series = Window.partitionBy("_by")
    upto = F.sum("_n").over(series.orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    bins = bins.withColumns({"_upto": upto, "_all": F.sum("_n").over(series)})
    each = F.explode(F.array(*[F.lit(float(q)) for q in sorted(set(wanted))]))
    at = bins.select("*", each.alias("quantile")).withColumn("_at", F.col("quantile") * (F.col("_all") - 1))
    ends = F.explode(F.array(F.floor("_at").cast("long"), F.ceil("_at").cast("long")))
    return _held(at.select("*", ends.alias("_rank")).withColumn("_below", F.lit(0).cast("long")).distinct())


def _held(met: DataFrame) -> DataFrame:
    """Of ranks that met the bins of their range, those with the bin that holds them."""
    before = F.col("_below") + F.col("_upto") - F.col("_n")
    held = met.where((before <= F.col("_rank")) & (F.col("_rank") < F.col("_below") + F.col("_upto")))
    return held.select(
        "_by", "quantile", "_all", "_at", "_rank", before.alias("_below"), F.col("_from").alias("_lo"), F.col("_to").alias("_hi")
    )


def _narrowed(rows: DataFrame, ranges: DataFrame, places: DataFrame) -> DataFrame:
    """One more round. Ranges of a series are equal or apart, so a row meets one at most."""
    a, b = rows.alias("a"), ranges.alias("b")
    inside = F.col("a._by").eqNullSafe(F.col("b._by")) & F.col("a._v").between(F.col("b._lo"), F.col("b._hi"))
    share = (F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
    number = F.least(F.floor(share * BINS), F.lit(BINS - 1).cast("long"))
    bins = _counted(a.join(b, inside).select("a._by", "_v", "_lo", "_hi").withColumn("_bin", number))
    order = Window.partitionBy("_by", "_lo", "_hi").orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = bins.withColumn("_upto", F.sum("_n").over(order))
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"h.{c}")) for c in ("_by", "_lo", "_hi")]
    met = places.alias("p").join(bins.alias("h"), reduce(Column.__and__, same))
    return _held(met.select("p.*", "h._upto", "h._n", "h._from", "h._to").drop("_lo", "_hi"))


def _interpolated(places: DataFrame) -> DataFrame:
    low, high = F.min("_lo"), F.max("_hi")
    part = F.first(F.col("_at") - F.floor("_at"))
    between = F.when(low == high, low).otherwise(low + (high - low) * part)
    return places.groupBy("_by", "quantile").agg(F.first("_all").alias("n"), between.alias("value"))
