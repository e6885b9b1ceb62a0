"""Ordered operations over long series.

One line or sensor may hold a large share of all rows, so a window over its whole
history would put that share into one task. Here the window runs per (series, time
bucket), and only what lies at the edges of the buckets, of which there are as many
as the calendar has, is looked at per series. A bucket is ``WIDTH`` seconds, one
minute; an operation takes another width as an argument, and no pass over the data
chooses it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftloom.functions.times import epoch_second

# Seconds of a bucket.
WIDTH = 60

_SO_FAR = (Window.unboundedPreceding, Window.currentRow)


def time_bucket(time: str, width: int = WIDTH) -> Column:
    """Bucket number of ``time``; null for a null time."""
    return F.floor(epoch_second(F.col(time)) / width)


def next_value(
    df: DataFrame, by: list[str], time: str, tie: str, column: str, out: str, width: int = WIDTH
) -> DataFrame:
    """``column`` of the next row of the same series, null on the last row of the series."""
    chunked = df.withColumn("_bucket", time_bucket(time, width))
    chunk = Window.partitionBy(*by, "_bucket").orderBy(time, tie)
    marked = chunked.withColumns(
        {
            out: F.lead(column).over(chunk),
            "_first": F.lag(F.lit(True)).over(chunk).isNull(),
            "_last": F.lead(F.lit(True)).over(chunk).isNull(),
        }
    )
    inner = marked.where(~F.col("_last"))
    edges = marked.where(F.col("_first") | F.col("_last"))
    series = Window.partitionBy(*by).orderBy(time, tie)
    last = edges.withColumn(out, F.lead(column).over(series)).where("_last")
    return inner.unionByName(last).drop("_bucket", "_first", "_last")


def row_numbers(df: DataFrame, by: list[str], time: str, tie: str, out: str, width: int = WIDTH) -> DataFrame:
    """Position of each row in its series, from 1."""
    chunked = df.withColumn("_bucket", time_bucket(time, width))
    return positions(chunked, by, "_bucket", [F.col(time), F.col(tie)], out).drop("_bucket")


def positions(df: DataFrame, by: list[str], bucket: str, order: list[Column], out: str) -> DataFrame:
    """Position in ``by`` from 1, by bucket and then by ``order``; buckets must not cross in that order.

    Rows of a null series are a series, and those of a null bucket come first.
    """
    counts = df.groupBy(*by, bucket).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    numbered = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*by, bucket).orderBy(*order)))
    keys = [*by, bucket]
    same = [F.col(f"_r.`{k}`").eqNullSafe(F.col(f"_o.`{k}`")) for k in keys]
    met = numbered.alias("_r").join(offsets.alias("_o"), same).select("_r.*", "_o._before")
    return (
        met.withColumn(out, (F.col("_before") + F.col("_rn")).cast("long"))
        .drop("_rn", "_before")
    )


def begun_runs(
    df: DataFrame, by: list[str], bucket: str, time: str, tie: str, starts: dict[str, Column]
) -> DataFrame:
    """How many unbroken runs of each condition begin per group, the group's first row included.

    Runs are counted per bucket; a run that goes on from the end of one bucket into
    the next is then counted once.
    """
    chunk = Window.partitionBy(*by, bucket).orderBy(time, tie)
    flags = df.withColumns({f"_is_{n}": F.coalesce(cond, F.lit(False)) for n, cond in starts.items()})
    marked = flags.withColumns(
        {
            "_first": F.lag(F.lit(True)).over(chunk).isNull(),
            "_last": F.lead(F.lit(True)).over(chunk).isNull(),
            **{f"_was_{n}": F.lag(f"_is_{n}", 1, False).over(chunk) for n in starts},
        }
    )
    local = marked.groupBy(*by, bucket).agg(
        *[F.count_if(F.col(f"_is_{n}") & ~F.col(f"_was_{n}")).alias(f"_n_{n}") for n in starts],
        *[F.max(F.col(f"_is_{n}") & F.col("_first")).alias(f"_opens_{n}") for n in starts],
        *[F.max(F.col(f"_is_{n}") & F.col("_last")).alias(f"_closes_{n}") for n in starts],
    )
    chain = Window.partitionBy(*by).orderBy(bucket)
    goes_on = {f"_on_{n}": F.col(f"_opens_{n}") & F.lag(f"_closes_{n}", 1, False).over(chain) for n in starts}
    return (
        local.withColumns(goes_on)
        .groupBy(*by)
        .agg(*[F.sum(F.col(f"_n_{n}") - F.col(f"_on_{n}").cast("long")).alias(n) for n in starts])
    )


def runs(df: DataFrame, by: list[str], time: str, tie: str, state: str, width: int = WIDTH) -> DataFrame:
    """Unbroken runs of rows whose boolean ``state`` is true: first time, last time, rows.

    Runs are built per bucket. Those that touch the edge of a bucket are then chained
    along the series; the others are final, and keep their bucket as part of the
    partition key so that they stay spread.
    """
    chunked = df.select(
        *by,
        F.col(time).alias("_t"),
        F.col(tie).alias("_tie"),
        F.col(state).alias("_state"),
        time_bucket(time, width).alias("_bucket"),
    )
    chunk = Window.partitionBy(*by, "_bucket").orderBy("_t", "_tie")
    marked = chunked.withColumns(
        {
            "_prev": F.lag("_state").over(chunk),
            "_last": F.lead(F.lit(True)).over(chunk).isNull(),
        }
    )
    changed = F.col("_prev").isNull() | (F.col("_prev") != F.col("_state"))
    marked = marked.withColumn("_run", F.sum(changed.cast("int")).over(chunk.rowsBetween(*_SO_FAR)))
    local = marked.groupBy(*by, "_bucket", "_run", "_state").agg(
        F.min("_t").alias("_from"),
        F.max("_t").alias("_to"),
        F.count("*").alias("_n"),
        F.max(F.col("_prev").isNull()).alias("_opens"),
        F.max("_last").alias("_closes"),
    )
    kept = local.where(F.col("_state") | F.col("_opens") | F.col("_closes"))
    spread = kept.withColumn("_part", F.when(~F.col("_opens") & ~F.col("_closes"), F.col("_bucket")))
    chain = Window.partitionBy(*by, "_part").orderBy("_bucket", "_run")
    joins = (
        F.col("_state") & F.col("_opens") & F.lag("_state", 1, False).over(chain) & F.lag("_closes", 1, False).over(chain)
    )
    chained = spread.withColumn("_joins", joins).where("_state")
    chained = chained.withColumn("_id", F.sum((~F.col("_joins")).cast("int")).over(chain.rowsBetween(*_SO_FAR)))
    return (
        chained.groupBy(*by, "_part", "_id")
        .agg(F.min("_from").alias("t0"), F.max("_to").alias("t1"), F.sum("_n").alias("n"))
        .drop("_part", "_id")
    )
