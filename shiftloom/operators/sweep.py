"""Points in spans by a sweep: both kinds of event in one order, the open span carried along.

The bucketed join of ``intervals.in_spans`` lists a span under each day that it covers. A
sweep lists nothing: a span is one event, where it begins, and a point belongs to the last
span that began before it, if that one is still open. Events are swept per (line, time
bucket). What a bucket leaves open goes on to the buckets after it by a scan over one row
for each bucket, so a span of years costs what a span of a minute does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftloom.operators.intervals import count_runs, status_rows
from shiftloom.operators.ordered import time_bucket

#: Seconds of a bucket of events.
WIDTH = 3600


def within(points: DataFrame, spans: DataFrame, line: str, time: str, keys: list[str], width: int = WIDTH) -> DataFrame:
    """Points with the ``keys`` of the span of their line that holds them: ``_from <= time < _to``.

    The rows of ``points`` that are in no span are left out, as are null lines and times.
    Spans that end before they begin, or at once, hold nothing. The spans of a line must not
    overlap; two that do are an error when the rows are read. Each point and each span is
    one event, however long the span is.
    """
    span = F.struct(F.col("_from"), F.col("_to"), *keys)
    opens = spans.where((F.col("_to") > F.col("_from")) & F.col(line).isNotNull())
    opens = opens.select(F.col(line).alias("_line"), F.col("_from").alias("_at"), F.lit(0).alias("_kind"), span.alias("_span"))
    point = F.struct(*[F.col(c) for c in points.columns])
    seen = points.where(F.col(line).isNotNull() & F.col(time).isNotNull())
    seen = seen.select(F.col(line).alias("_line"), F.col(time).alias("_at"), F.lit(1).alias("_kind"), point.alias("_point"))
    # at equal times the span is met first, so a point at its beginning is in it
    events = opens.unionByName(seen, allowMissingColumns=True).withColumn("_bucket", time_bucket("_at", width))

    chunk = Window.partitionBy("_line", "_bucket").orderBy("_at", "_kind")
    before = chunk.rowsBetween(Window.unboundedPreceding, -1)
    swept = events.withColumn("_own", F.last("_span", ignorenulls=True).over(before))
    met = swept.join(_carried(opens, events, width), ["_line", "_bucket"], "left")
    held = F.coalesce("_own", "_carried")
    clash = F.coalesce(held["_to"] > F.col("_at"), F.lit(False))
    wrong = F.raise_error(F.concat(F.lit("spans overlap on line "), F.col("_line").cast("string")))
    inside = F.when(F.col("_kind") == 1, clash).otherwise(F.when(clash, wrong.cast("boolean")).otherwise(F.lit(False)))
    found = met.where(inside).select("_point.*", held.alias("_in"))
    return found.select(*points.columns, *(F.col("_in")[k].alias(k) for k in keys))


def _carried(opens: DataFrame, events: DataFrame, width: int) -> DataFrame:
    """The span that began last before each bucket: a scan over the buckets that hold events."""
    last = opens.groupBy("_line", time_bucket("_at", width).alias("_bucket")).agg(F.max_by("_span", "_at").alias("_last"))
    buckets = events.select("_line", "_bucket").distinct().join(last, ["_line", "_bucket"], "left")
    chain = Window.partitionBy("_line").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return buckets.select("_line", "_bucket", F.last("_last", ignorenulls=True).over(chain).alias("_carried"))


def in_spans(intervals: DataFrame, spans: DataFrame, width: int = WIDTH) -> DataFrame:
    """Status rows within the spans of their line, as ``intervals.in_spans`` gives them for spans that do not overlap."""
    rows = status_rows(intervals).withColumn("_bucket", time_bucket("IntervalBegin"))
    keys = [c for c in spans.columns if c not in ("ProductionLineId", "_from", "_to")]
    return within(rows, spans, "ProductionLineId", "IntervalBegin", keys, width)


def in_execution(intervals: DataFrame, shifts: DataFrame, ahead: Column | None = None, width: int = WIDTH) -> DataFrame:
    """Intervals within ``[StartDate, EndDate)`` of their line's shifts; ``ahead`` moves the shift clock back."""
    start, end = F.col("StartDate"), F.col("EndDate")
    if ahead is not None:
        start, end = start - ahead, end - ahead
    spans = shifts.select("WorkShiftExecutionId", "ProductionLineId", start.alias("_from"), end.alias("_to"))
    return in_spans(intervals, spans, width)


def shift_counts(intervals: DataFrame, shifts: DataFrame, ahead: Column | None = None) -> DataFrame:
    """Begun US and SS runs of each shift and line that has intervals."""
    return count_runs(in_execution(intervals, shifts, ahead), ["WorkShiftExecutionId", "ProductionLineId"])
