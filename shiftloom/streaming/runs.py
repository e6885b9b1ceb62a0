"""Status runs of the shift under way, counted as interval files arrive.

A line's shift is a group of its own, with a state of four numbers for what can change no
more, and the rows that later ones may still come before. Rows are counted in the order of
their time once the watermark has passed them; the rows after it are counted for the live
figure only. A timer ends the shift: when the watermark passes its end, the final counts go
out and the state goes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from shiftloom.functions.times import second_of_day
from shiftloom.operators.intervals import SCHEDULED, UNSCHEDULED, status_rows

#: The state store that timers and lists of states need.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

COUNTED = "np long, p long, status string, rows long"
PENDING = "at long, seq long, status string"
COUNTS = "shift_start long, shift_end long, np_runs long, p_runs long, intervals long, final boolean"

#: Begin and end of the shifts in minutes of the day; one that ends before it begins goes on to the next day.
SHIFTS = ((420, 930), (930, 1380), (1380, 420))


def with_shift(rows: DataFrame, time: str, shifts: tuple[tuple[int, int], ...] = SHIFTS) -> DataFrame:
    """Rows with the begin and end of the shift that holds ``time``, in microseconds; rows in no shift are left out."""
    at = F.col(time)
    midnight, second = F.unix_micros(F.date_trunc("day", at)), second_of_day(at)
    day, span = 86_400_000_000, None
    for begin, end in shifts:
        a, b = begin * 60_000_000, end * 60_000_000
        if begin < end:
            cases = [((second >= begin * 60) & (second < end * 60), a, b)]
        else:
            cases = [(second >= begin * 60, a, b + day), (second < end * 60, a - day, b)]
        for inside, start, stop in cases:
            pair = F.struct((midnight + start).alias("a"), (midnight + stop).alias("b"))
            span = F.when(inside, pair) if span is None else span.when(inside, pair)
    held = rows.withColumn("_span", span).where("_span IS NOT NULL")
    return held.withColumns({"shift_start": F.col("_span.a"), "shift_end": F.col("_span.b")}).drop("_span")


def folded(state: tuple, rows: list[tuple]) -> tuple:
    """(US runs, SS runs, last status, rows) after more rows, in the order of (time, sequence)."""
    np, p, last, n = state
    for _, _, status in rows:
        np += status == UNSCHEDULED and last != UNSCHEDULED
        p += status == SCHEDULED and last != SCHEDULED
        last, n = status, n + 1
    return np, p, last, n


class ShiftRuns(StatefulProcessor):
    """Counts of one line and shift."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counted = handle.getValueState("counted", COUNTED)
        self.pending = handle.getListState("pending", PENDING)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        if self.counted.exists():
            counted = tuple(self.counted.get())
        else:
            counted = (0, 0, None, 0)
            self.handle.registerTimer(key[2] // 1000)
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        # rows up to the watermark of the batch before are late and never get here
        waiting = [tuple(r) for r in self.pending.get()] + [(r["at"], r["seq"], r["status"]) for r in rows]
        waiting.sort(key=lambda r: r[:2])
        counted = folded(counted, [r for r in waiting if r[0] <= mark])
        waiting = [r for r in waiting if r[0] > mark]
        self.counted.update(counted)
        if waiting:
            self.pending.put(waiting)
        else:
            self.pending.clear()
        yield self._row(key, folded(counted, waiting), False)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        if self.counted.exists():
            waiting = sorted((tuple(r) for r in self.pending.get()), key=lambda r: r[:2])
            counted = folded(tuple(self.counted.get()), waiting)
            self.counted.clear()
            self.pending.clear()
            yield self._row(key, counted, True)

    def close(self) -> None:
        pass

    @staticmethod
    def _row(key: Any, counts: tuple, final: bool) -> Row:
        np, p, _, n = counts
        return Row(ProductionLineId=key[0], shift_start=key[1], shift_end=key[2], np_runs=np, p_runs=p, intervals=n, final=final)


def live_runs(intervals: DataFrame, delay: str = "10 minutes", shifts: tuple[tuple[int, int], ...] = SHIFTS) -> DataFrame:
    """Per line and shift the US and SS runs begun so far, whenever rows of it arrive, and once more when it has ended.

    Rows may be ``delay`` late, by the newest row seen of all lines. A status is trimmed, as
    in the batch counts; a stop under way when the shift begins counts once.
    """
    rows = status_rows(intervals).select(
        "ProductionLineId",
        F.col("IntervalBegin").cast("timestamp").alias("t"),
        F.col("IntervalSeq").cast("long").alias("seq"),
        F.col("_status").alias("status"),
    )
    rows = with_shift(rows.withWatermark("t", delay), "t", shifts).withColumn("at", F.unix_micros("t"))
    line = rows.schema["ProductionLineId"].dataType.simpleString()
    counted = rows.groupBy("ProductionLineId", "shift_start", "shift_end").transformWithState(
        ShiftRuns(), f"ProductionLineId {line}, {COUNTS}", "Update", "eventTime"
    )
    return counted.withColumns({c: F.timestamp_micros(c) for c in ("shift_start", "shift_end")})


def start_runs(
    intervals: DataFrame, target: str, checkpoint: str, delay: str = "10 minutes", available_now: bool = False
) -> StreamingQuery:
    """Keep the counts of ``live_runs`` in ``target``, a folder for each batch; one that runs again replaces its own.

    The session's state store must be ``STORE``.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    writer = live_runs(intervals, delay).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.foreachBatch(write).start()


def read_runs(spark: SparkSession, target: str) -> DataFrame:
    """The newest counts of each line and shift."""
    keys = ["ProductionLineId", "shift_start", "shift_end"]
    counts = F.max_by(F.struct("np_runs", "p_runs", "intervals", "final"), F.struct("batch", "final"))
    return spark.read.parquet(target).groupBy(*keys).agg(counts.alias("_c")).select(*keys, "_c.*")
