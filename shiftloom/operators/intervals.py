"""Line status intervals: snapshots, look-backs, status runs and shift counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftloom.functions.numbers import divide_or_null, fixed, round_sql
from shiftloom.functions.texts import shift_rank, status_code, status_label
from shiftloom.functions.times import format_duration, interval, minutes_of_time, parse_duration_text
from shiftloom.operators.ordered import begun_runs, next_value, time_bucket

# The two stop states of a line.
UNSCHEDULED, SCHEDULED = "US", "SS"

# Duration columns of a snapshot that are shown as text.
DURATION_COLUMNS = (
    "StatusTimeMin",
    "NaturalTimeMin",
    "ProductiveTimeMin",
    "ScheduledStopageMin",
    "UnscheduledStopageMin",
)


def with_line(intervals: DataFrame, lines: DataFrame, pattern: str | None = None) -> DataFrame:
    """Intervals with their line name, optionally only lines whose name contains ``pattern``."""
    named = lines.select("ProductionLineId", F.col("Name").alias("LineName"))
    if pattern:
        named = named.where(F.contains(F.lower("LineName"), F.lit(pattern.lower())))
    return intervals.join(named, "ProductionLineId")


def _snapshot_columns() -> list[Column]:
    c = F.col
    return [
        c("LineName"),
        c("IntervalBegin").alias("SnapshotAtLocal"),
        round_sql(c("OEE"), 2).alias("OEE"),
        round_sql(c("OEEAvailability"), 2).alias("Availability"),
        round_sql(c("OEEPerformance"), 2).alias("Performance"),
        round_sql(c("OEEQuality"), 2).alias("Producto Conforme"),
        c("ParosNoProgramadosCont"),
        minutes_of_time(c("UnscheduledStopageTime")).alias("UnscheduledStopageMin"),
        c("ParosProgramadosCont"),
        minutes_of_time(c("ScheduledStopageTime")).alias("ScheduledStopageMin"),
        status_label(status_code(c("IntervalProductionLineStatus"))).alias("StatusCode"),
        parse_duration_text(c("TimeSinceLastStatusChange")).alias("StatusTimeMin"),
        parse_duration_text(c("TimeSinceLastWorkshiftBegin")).alias("NaturalTimeMin"),
        minutes_of_time(c("EffectiveAvailableTime")).alias("ProductiveTimeMin"),
        c("CurrentRate"),
        c("ExpectedRate"),
        c("CurrentShiftProduction"),
        c("ExpectedShiftProduction"),
        c("CurrentProduction"),
        c("ExpectedDayProduction"),
    ]


def newest(intervals: DataFrame) -> DataFrame:
    """The newest interval of all lines: TOP 1 by begin, creation and sequence."""
    return intervals.orderBy(F.desc("IntervalBegin"), F.desc("CreatedAt"), F.desc("IntervalSeq")).limit(1)


def newest_per_line(intervals: DataFrame) -> DataFrame:
    """The newest interval of each line, by aggregation rather than a window over its history.

    Whole rows are only compared from the time on at which the line that is silent
    for longest was last heard.
    """
    rows, begin = intervals, F.col("IntervalBegin")
    if not intervals.isStreaming:
        last = intervals.groupBy("ProductionLineId").agg(F.max(begin).alias("_last"))
        rows = intervals.where((begin >= last.agg(F.min("_last")).scalar()) | begin.isNull())
    rest = [c for c in intervals.columns if c not in ("ProductionLineId", "IntervalBegin", "CreatedAt", "IntervalSeq")]
    row = F.struct("IntervalBegin", "CreatedAt", "IntervalSeq", *rest)
    return rows.groupBy("ProductionLineId").agg(F.max(row).alias("_r")).select("ProductionLineId", "_r.*")


def lookback_minutes(shift: bool) -> Column:
    """Minutes since the shift began, or a fixed hour."""
    return parse_duration_text(F.col("TimeSinceLastWorkshiftBegin")) if shift else F.lit(60)


def count_runs(rows: DataFrame, by: list[str]) -> DataFrame:
    """Begun US and SS runs per group of interval rows.

    A stop under way when the group begins counts once.
    """
    starts = {
        "ParosNoProgramadosCont": F.col("_status") == UNSCHEDULED,
        "ParosProgramadosCont": F.col("_status") == SCHEDULED,
    }
    return begun_runs(rows, by, "_bucket", "IntervalBegin", "IntervalSeq", starts)


def status_rows(intervals: DataFrame) -> DataFrame:
    """Line, time, sequence and clean status of the intervals."""
    return intervals.select(
        "ProductionLineId", "IntervalBegin", "IntervalSeq", status_code(F.col("IntervalProductionLineStatus")).alias("_status")
    )


def in_spans(intervals: DataFrame, spans: DataFrame, reach: DataFrame | None = None) -> DataFrame:
    """Status rows of a line from ``_from`` up to before ``_to``.

    Rows meet on (line, calendar day): a span is listed under each day it covers,
    so a line's history is spread over its days and the range test only sees one
    day's rows. ``reach`` holds spans that enclose all others; intervals outside of
    its first begin and last end are left out before anything is shuffled.
    """
    spans = spans.where(F.col("_to") > F.col("_from"))
    days = F.sequence(F.to_date("_from"), F.to_date("_to"))
    rows = status_rows(intervals)
    if reach is not None:
        ends = reach.agg(F.struct(F.min("_from").alias("a"), F.max("_to").alias("b")).alias("ends")).scalar()
        rows = rows.where((F.col("IntervalBegin") >= ends["a"]) & (F.col("IntervalBegin") < ends["b"]))
    rows = rows.withColumns(
        {"_day": F.to_date("IntervalBegin"), "_bucket": time_bucket("IntervalBegin")}
    )
    return (
        rows.join(spans.withColumn("_day", F.explode(days)), ["ProductionLineId", "_day"])
        .where((F.col("IntervalBegin") >= F.col("_from")) & (F.col("IntervalBegin") < F.col("_to")))
        .drop("_day", "_from", "_to")
    )


def lookback_counts(intervals: DataFrame, snapshots: DataFrame, shift: bool = True) -> DataFrame:
    """Status runs of each line from its look-back start to its snapshot, both ends included."""
    begin = F.col("IntervalBegin")
    spans = snapshots.select(
        "ProductionLineId",
        (begin - interval(lookback_minutes(shift), "minute")).alias("_from"),
        (begin + F.expr("INTERVAL '0.000001' SECOND")).alias("_to"),
    )
    return count_runs(in_spans(intervals, spans, spans), ["ProductionLineId"])


def snapshots(
    intervals: DataFrame, lines: DataFrame, pattern: str | None = None, shift: bool = True, per_line: bool = False
) -> DataFrame:
    """Newest snapshot with labels, parsed durations and run counts of its look-back.

    ``per_line`` gives one row for every line instead of the single newest one.
    """
    named = with_line(intervals, lines, pattern)
    latest = newest_per_line(named) if per_line else newest(named)
    counts = lookback_counts(intervals, latest, shift)
    joined = latest.join(counts, "ProductionLineId", "left").withColumns(
        {
            "ParosNoProgramadosCont": F.coalesce("ParosNoProgramadosCont", F.lit(0).cast("long")),
            "ParosProgramadosCont": F.coalesce("ParosProgramadosCont", F.lit(0).cast("long")),
        }
    )
    return joined.select(*_snapshot_columns())


def synced(snapshot: DataFrame, totals: DataFrame, lang: str = "es") -> DataFrame:
    """Snapshot whose stop counts and minutes are replaced by the day's totals, durations as text."""
    day = totals.select(F.struct("*").alias("t")).scalar()
    out = snapshot.withColumn("_t", day).withColumns(
        {
            "ParosNoProgramadosCont": F.col("_t.np_events"),
            "UnscheduledStopageMin": F.col("_t.np_minutes"),
            "ParosProgramadosCont": F.col("_t.p_events"),
            "ScheduledStopageMin": F.col("_t.p_minutes"),
        }
    )
    return out.withColumns({c: format_duration(F.col(c), lang) for c in DURATION_COLUMNS}).drop("_t")


def snapshot_metrics(snapshot: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Snapshot rows as (metric, value) text rows of the report table.

    ``by`` names columns that tell the snapshots apart; they stay on each row.
    """

    # Report names of the snapshot columns, in order.
    def number(col: str, suffix: str = "") -> Column:
        return fixed(F.col(f"`{col}`"), 2, suffix)

    def text(col: str, default: str) -> Column:
        return F.coalesce(F.col(f"`{col}`").cast("string"), F.lit(default))

    metrics = [
        ("OEE (%)", number("OEE", "%")),
        ("Disponibilidad (%)", number("Availability", "%")),
        ("Desempeño (%)", number("Performance", "%")),
        ("Producto Conforme (%)", number("Producto Conforme", "%")),
        ("Estatus Actual", text("StatusCode", "N/A")),
        ("Snapshot (Local)", text("SnapshotAtLocal", "N/A")),
        ("Línea", text("LineName", "N/A")),
        ("Producción Real (Kg)", number("CurrentShiftProduction")),
        ("Producción Esperada (Kg)", number("ExpectedShiftProduction")),
        ("Velocidad Real (Kg/h)", number("CurrentRate")),
        ("Velocidad Esperada (Kg/h)", number("ExpectedRate")),
        ("Paros No Programados (Eventos)", text("ParosNoProgramadosCont", "0")),
        ("Duración Paros No Prog.", text("UnscheduledStopageMin", "0 minutos")),
        ("Paros Programados (Eventos)", text("ParosProgramadosCont", "0")),
        ("Duración Paros Prog.", text("ScheduledStopageMin", "0 minutos")),
    ]
    pairs = F.array(*[F.struct(F.lit(n).alias("Métrica"), v.alias("Valor")) for n, v in metrics])
    return snapshot.select(*[F.col(c).alias(f"_{c}") for c in by or []], F.inline(pairs)).withColumnsRenamed(
        {f"_{c}": c for c in by or []}
    )


def day_target_outlook(snapshot: DataFrame) -> DataFrame:
    """Kilograms missing to the day's plan and hours needed at the current rate."""
    gap = F.col("ExpectedDayProduction") - F.col("CurrentProduction")
    return snapshot.select(
        "LineName",
        "SnapshotAtLocal",
        gap.alias("gap_kg"),
        F.when(gap <= 0, F.lit(0.0)).otherwise(divide_or_null(gap, F.when(F.col("CurrentRate") > 0, F.col("CurrentRate")))).alias(
            "hours_needed"
        ),
        (gap <= 0).alias("target_met"),
    )


def in_execution(
    intervals: DataFrame, shifts: DataFrame, offset_hours: int = 0, executions: DataFrame | None = None
) -> DataFrame:
    """Intervals within ``[StartDate, EndDate)`` of their line's shifts.

    ``offset_hours`` moves the shift clock where it runs ahead of the intervals'
    local clock. A shift without an end has no intervals. ``executions`` are the
    executions of these shifts, if at hand: they tell which time to read.
    """
    ahead = interval(offset_hours, "hour")

    def spans(df: DataFrame, *keys: str) -> DataFrame:
        return df.select(*keys, (F.col("StartDate") - ahead).alias("_from"), (F.col("EndDate") - ahead).alias("_to"))

    reach = None if executions is None else spans(executions)
    return in_spans(intervals, spans(shifts, "WorkShiftExecutionId", "ProductionLineId"), reach)


def with_counts(
    shifts: DataFrame, intervals: DataFrame, offset_hours: int = 0, executions: DataFrame | None = None
) -> DataFrame:
    """Shifts with the status runs of their line; shifts without intervals count 0."""
    keys = ["WorkShiftExecutionId", "ProductionLineId"]
    counted = count_runs(in_execution(intervals, shifts, offset_hours, executions), keys)
    zero = F.lit(0).cast("long")
    return shifts.join(counted, keys, "left").withColumns(
        {c: F.coalesce(F.col(c), zero) for c in ("ParosNoProgramadosCont", "ParosProgramadosCont")}
    )


def shift_day(
    star: DataFrame, intervals: DataFrame, offset_hours: int = 0, executions: DataFrame | None = None
) -> DataFrame:
    """Stored shift KPIs with stop counts recomputed from the intervals."""
    c = F.col
    return (
        with_counts(star, intervals, offset_hours, executions)
        .select(
            "Turno",
            "Fecha",
            "ProductionLineId",
            c("Oee").alias("OEE"),
            c("Availability").alias("Disponibilidad"),
            c("Performance").alias("Desempeno"),
            c("Quality").alias("Producto Conforme"),
            "ParosNoProgramadosCont",
            c("UnscheduledStopageMin").alias("TiempoNoProdNoProgramadoMin"),
            "ParosProgramadosCont",
            c("ScheduledStopageMin").alias("TiempoNoProdProgramadoMin"),
            c("WorkshiftDurationMin").alias("DuracionTurnoMin"),
            c("AvailableTimeMin").alias("TiempoDisponibleMin"),
            c("ProductiveTimeMin").alias("TiempoProductivoMin"),
            c("ExpectedProductionSummaryModified").alias("ProduccionEstimadaKg"),
            c("CurrentProductionSummary").alias("ProduccionRealKg"),
            c("AvgExpectedVelocity").alias("VelocidadPromedioEstimadaKgHr"),
            c("AvgCurrentVelocity").alias("VelocidadPromedioRealKgHr"),
        )
        .orderBy("Fecha", shift_rank(c("Turno")), "ProductionLineId")
    )


def status_stops(intervals: DataFrame) -> DataFrame:
    """Stops read off the intervals: a US or SS row lasts until the line's next row."""
    followed = next_value(
        status_rows(intervals), ["ProductionLineId"], "IntervalBegin", "IntervalSeq", "IntervalBegin", "EndDate"
    )
    return followed.where(F.col("_status").isin(UNSCHEDULED, SCHEDULED) & F.col("EndDate").isNotNull()).select(
        "ProductionLineId",
        F.col("IntervalBegin").alias("StartDate"),
        "EndDate",
        F.when(F.col("_status") == UNSCHEDULED, "NP").otherwise("P").alias("Type"),
        "IntervalSeq",
    )
