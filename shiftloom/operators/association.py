"""Which sensor excursions go with which stops: co-occurrence of their onsets at each lag.

Onsets become trains of time bins of a line. At a lag L a bin of a sensor and a bin of a
stop kind meet if the stop's is L bins later. How many would meet by chance follows from a
circular-shift null: turned round by any number of bins, a sensor's train keeps its size and
each of its bins is equally likely to lie anywhere in the line's observed span. So the
expected number is (sensor bins) * (stop bins that lie in the span after moving back by L) /
(bins of the span), without a single shift being made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftloom.functions.times import epoch_second


def spans(observed: DataFrame, line: str, time: str, width: int) -> DataFrame:
    """Per line the number of its first bin and how many bins its observations span."""
    bin_ = F.floor(epoch_second(F.col(time)) / width)
    ends = observed.where(F.col(line).isNotNull() & F.col(time).isNotNull()).groupBy(line)
    return ends.agg(F.min(bin_).alias("_first"), (F.max(bin_) - F.min(bin_) + 1).alias("_n"))


def trains(onsets: DataFrame, span: DataFrame, line: str, by: list[str], time: str, width: int) -> DataFrame:
    """Distinct bins with an onset, numbered from the start of the line's span.

    Onsets outside of the span, or without a line or time, are left out.
    """
    bins = onsets.select(line, *by, F.floor(epoch_second(F.col(time)) / width).alias("_bin")).distinct()
    at = (F.col("_bin") - F.col("_first")).alias("_at")
    return bins.join(span, line).select(line, *by, at, "_n").where("_at >= 0 AND _at < _n")


def _same(a: str, b: str, keys: list[str]) -> list[Column]:
    return [F.col(f"{a}.`{k}`").eqNullSafe(F.col(f"{b}.`{k}`")) for k in keys]


def _met(events: DataFrame, halts: DataFrame, line: str, by: list[str], kinds: list[str], first: int, last: int) -> DataFrame:
    """How many bins meet at each lag.

    Bins meet in blocks as long as the lags are many. A stop's bin, moved back by the first
    lag, is listed in its own block and the one before; a sensor's bin in its own. So each
    pair within the lags meets once, and rows are doubled at most, however many lags.
    """
    reach = last - first + 1
    left = events.withColumn("_block", F.floor(F.col("_at") / reach)).alias("e")
    block = F.floor((F.col("_at") - first) / reach)
    right = halts.withColumn("_block", F.explode(F.array(block, block - 1))).alias("s")
    lag = F.col("s._at") - F.col("e._at")
    pairs = left.join(right, [line, "_block"]).where(lag.between(first, last))
    keys = [F.col(line), *(F.col(f"e.`{k}`").alias(k) for k in by), *(F.col(f"s.`{k}`").alias(k) for k in kinds)]
    return pairs.groupBy(*keys, lag.cast("int").alias("lag")).agg(F.count("*").alias("together"))


def lag_counts(
    onsets: DataFrame,
    stops: DataFrame,
    observed: DataFrame,
    line: str,
    by: list[str],
    kinds: list[str],
    time: str = "t0",
    stop_time: str = "StartDate",
    observed_time: str = "LocalTime",
    width: int = 3600,
    first: int = 0,
    last: int = 6,
) -> DataFrame:
    """Per line, sensor (``by``), stop kind (``kinds``) and lag: together, expected.

    Every lag from ``first`` to ``last`` bins of ``width`` seconds has a row for every
    sensor and stop kind with an onset on the line; positive lags are stops after the
    excursion. Onsets count once a bin. Null sensors and kinds are groups of their own.
    """
    if last < first:
        raise ValueError("the first lag is after the last")
    span = spans(observed, line, observed_time, width)
    events = trains(onsets, span, line, by, time, width)
    halts = trains(stops, span, line, kinds, stop_time, width)
    lags = F.sequence(F.lit(first), F.lit(last))

    sensors = events.groupBy(line, *by).agg(F.count("*").alias("_events"), F.first("_n").alias("_n"))
    motives = halts.groupBy(line, *kinds).agg(F.count("*").alias("_halts"))
    # stop bins near an end of the span leave it when moved back by a lag
    edge = halts.where((F.col("_at") < last) | (F.col("_at") >= F.col("_n") + first))
    moved = edge.withColumn("lag", F.explode(lags)).where("_at - lag < 0 OR _at - lag >= _n")
    lost = moved.groupBy(line, *kinds, "lag").agg(F.count("*").alias("_lost"))
    motives = motives.withColumn("lag", F.explode(lags)).alias("m")
    motives = motives.join(lost.alias("l"), _same("m", "l", [line, *kinds, "lag"]), "left")
    motives = motives.select("m.*", (F.col("_halts") - F.coalesce("_lost", F.lit(0))).alias("_inside")).drop("_halts")

    grid = sensors.join(motives, line).alias("g")
    met = _met(events, halts, line, by, kinds, first, last).alias("c")
    expected = F.col("_events") * F.col("_inside") / F.col("_n").cast("double")
    return grid.join(met, _same("g", "c", [line, *by, *kinds, "lag"]), "left").select(
        *(F.col(f"g.`{k}`").alias(k) for k in (line, *by, *kinds, "lag")),
        F.coalesce("together", F.lit(0).cast("long")).alias("together"),
        expected.alias("expected"),
    )


def association(lags: DataFrame, by: list[str], kinds: list[str]) -> DataFrame:
    """Sensors and stop kinds with their strongest lag over all lines, ranked per sensor.

    Counts of lines add up, and so do expected numbers. strength is (together - expected) /
    sqrt(expected); the strongest lag is the one nearest to 0 of equal ones, and of two as
    near the positive one. rank numbers a sensor's stop kinds, the strongest first.
    """
    total = lags.groupBy(*by, *kinds, "lag").agg(
        F.sum("together").alias("together"),
        F.sum(F.col("expected").cast("decimal(38,10)")).cast("double").alias("expected"),
    )
    e = F.col("expected")
    strength = F.when(e > 0, F.round((F.col("together") - e) / F.sqrt(e), 4))
    scored = total.withColumns({"lift": F.when(e > 0, F.round(F.col("together") / e, 4)), "strength": strength})
    best = F.max_by(
        F.struct("lag", "together", "expected", "lift", "strength"),
        F.struct(F.coalesce("strength", F.lit(float("-inf"))), -F.abs("lag"), F.col("lag")),
    )
    found = scored.groupBy(*by, *kinds).agg(best.alias("_b")).select(*by, *kinds, "_b.*")
    order = Window.partitionBy(*by).orderBy(F.desc_nulls_last("strength"), *kinds)
    return found.withColumn("rank", F.row_number().over(order))
