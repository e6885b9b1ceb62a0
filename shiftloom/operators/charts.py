"""Chart-ready frames: grouping, weighting, sorting, series split, correlation and percent scale."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftloom.functions.numbers import num_coerce
from shiftloom.operators import oee

# Columns that split a chart into series, in order of preference.
SERIES_COLUMNS = ("Turno", "WorkShiftName", "WorkShift", "Shift", "Linea")
CHARTS = ("line", "bar", "heatmap", "corr")
AGGREGATES = {"mean": F.avg, "sum": F.sum, "max": F.max, "min": F.min}


@dataclass(frozen=True)
class ChartSpec:
    x: str | None = None
    ys: list[str] = field(default_factory=list)
    chart: str = "line"
    agg: str | None = None
    hue: str | None = None
    y_format: str | None = None
    sort_x: bool = True


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def select_numeric(df: DataFrame) -> DataFrame:
    return df.select(*[quoted(c) for c in numeric_columns(df)])


def repeated_values(df: DataFrame, x: str) -> DataFrame:
    """Values of ``x`` that occur more than once."""
    return df.groupBy(quoted(x).alias("value")).agg(F.count("*").alias("n")).where("n > 1")


def repeats(df: DataFrame, x: str) -> bool:
    """Whether any value of ``x`` repeats. Runs a small job; only the flag reaches the driver."""
    return not repeated_values(df, x).isEmpty()


def agg_by_x(df: DataFrame, x: str, ys: list[str], how: str) -> DataFrame:
    """Mean, sum, max or min of the ``ys`` for each non-null ``x``."""
    fn = AGGREGATES[how]
    return df.where(quoted(x).isNotNull()).groupBy(quoted(x)).agg(*[fn(quoted(y)).alias(y) for y in ys])


def correlation(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pearson correlation of each pair of columns, over the rows where both are present.

    All pairs are aggregated in one pass; the result is long and symmetric.
    """
    names = columns or numeric_columns(df)
    pairs = list(combinations_with_replacement(names, 2))
    row = df.agg(*[F.corr(quoted(a).cast("double"), quoted(b).cast("double")).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for left, right in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(left).alias("column_a"), F.lit(right).alias("column_b"), F.col(f"r{i}").alias("corr")))
    return row.select(F.inline(F.array(*cells)))


def percent_scale(df: DataFrame, ys: list[str]) -> DataFrame:
    """Fractions become percentages: multiply by 100 if no value of any ``ys`` exceeds 1."""
    tops = df.agg(*[F.max(quoted(y)).alias(f"m{i}") for i, y in enumerate(ys)])
    peak = tops.select(F.greatest(*tops.columns) if len(ys) > 1 else F.col("m0")).scalar()
    scaled = df.withColumn("_fraction", F.coalesce(peak <= 1.0, F.lit(False)))
    out = scaled.withColumns({y: F.when(F.col("_fraction"), quoted(y) * 100.0).otherwise(quoted(y)) for y in ys})
    return out.drop("_fraction")


def sort_series(df: DataFrame, x: str) -> DataFrame:
    """Order by ``x``; of texts, plain ones come first, then times, then numbers, each by what they say."""
    if not isinstance(df.schema[x].dataType, T.StringType):
        return df.orderBy(quoted(x))
    time = quoted(x).try_cast("timestamp_ntz")
    number = F.when(time.isNull(), quoted(x).try_cast("double"))
    return df.orderBy(number, time, quoted(x))


def series_column(df: DataFrame, x: str) -> str | None:
    return next((c for c in SERIES_COLUMNS if c in df.columns and c != x), None)


def long_frame(df: DataFrame, x: str, ys: list[str], hue: str | None) -> DataFrame:
    """One row per point: x, series name and y."""
    label = quoted(hue).cast("string") if hue and hue in df.columns else None

    def name(y: str) -> Column:
        if label is None:
            return F.lit(y)
        return label if len(ys) == 1 else F.concat_ws(", ", label, F.lit(y))

    points = F.array(*[F.struct(name(y).alias("series"), quoted(y).cast("double").alias("y")) for y in ys])
    return df.select(quoted(x).alias("x"), F.inline(points))


def chart_frame(df: DataFrame, spec: ChartSpec, stored_star: DataFrame | None = None) -> DataFrame:
    """Data of a chart.

    An OEE chart whose x repeats is weighted by raw inputs: from the frame itself
    if it has them, otherwise from ``stored_star``, whose daily values are put on
    the rows without collapsing them.
    """
    if spec.chart not in CHARTS:
        raise ValueError(f"unsupported chart: {spec.chart}")
    x, ys = spec.x, list(spec.ys)
    present = [y for y in ys if y in df.columns]
    df = df.withColumns({y: num_coerce(quoted(y)) for y in present})
    has_x = bool(x) and x in df.columns
    is_oee = any("OEE" in y.upper() for y in ys)
    repeated = None
    how = spec.agg
    if not how and has_x and is_oee:
        repeated = repeats(df, x)
        how = "weighted_oee" if repeated else None
    if how and has_x and ys:
        if is_oee and oee.can_weight(df):
            df = oee.weighted(df, x, ys)
        else:
            if is_oee and stored_star is not None:
                df = oee.map_back_weighted(df, oee.weighted_requery(stored_star), x, ys)
            if how in AGGREGATES:
                df = agg_by_x(df, x, present, how)
    if has_x and spec.sort_x:
        df = sort_series(df, x)
    hue = spec.hue
    if not hue and not how and has_x and (repeats(df, x) if repeated is None else repeated):
        hue = series_column(df, x)
    if spec.chart == "heatmap":
        return select_numeric(df)
    if spec.chart == "corr":
        return correlation(df)
    if not has_x or not ys:
        raise ValueError("a line or bar chart needs x and ys")
    if spec.y_format == "percent":
        df = percent_scale(df, ys)
    return long_frame(df, x, ys, hue)


def profile(df: DataFrame, key: str, time: str) -> DataFrame:
    """Rows, distinct keys, distinct times and time range of a table."""
    return df.agg(
        F.count("*").alias("row_count"),
        F.countDistinct(key).alias("distinct_keys"),
        F.countDistinct(time).alias("distinct_times"),
        F.min(time).alias("min_time"),
        F.max(time).alias("max_time"),
    )


def column_types(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
