"""Stoppage Pareto family."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftloom.functions.numbers import round_py
from shiftloom.functions.texts import clip_label
from shiftloom.functions.times import int_avg, seconds_between
from shiftloom.operators.business import Shifts
from shiftloom.operators.prefix import running_sums

# Fixed value: label of stops without a motive or a motive type.
UNCLASSIFIED = "Sin Clasificar"


def stop_class_filter(df: DataFrame, stop_class: str | None, column: Column) -> DataFrame:
    """Keep class ``NP`` or ``P``; any other word keeps all."""
    wanted = (stop_class or "todos").strip().upper()
    return df.where(column == wanted) if wanted in ("NP", "P") else df


def stop_star(stopages: DataFrame, motives: DataFrame, motive_types: DataFrame, shifts: Shifts) -> DataFrame:
    """Each stop with its shift, and with motive and motive type where it has them."""
    stops = stopages.select(
        "MotiveId", "WorkShiftExecutionId", "Type", F.col("StartDate").alias("StopStart"), F.col("EndDate").alias("StopEnd")
    )
    return _named(shifts.attach(stops).drop("StartDate", "EndDate"), motives, motive_types)


def _named(stops: DataFrame, motives: DataFrame, motive_types: DataFrame) -> DataFrame:
    reasons = motives.select("MotiveId", "MotiveTypeId", F.col("Name").alias("MotiveName"), "StoppageType")
    types = motive_types.select("MotiveTypeId", F.col("Name").alias("TypeName"))
    return stops.join(reasons, "MotiveId", "left").join(types, "MotiveTypeId", "left")


def reason_totals(
    stopages: DataFrame, motives: DataFrame, motive_types: DataFrame, shifts: Shifts, stop_class: str | None = None
) -> DataFrame:
    """Seconds and events per (type name, motive name, motive class, stop class).

    Stops are summed to (motive id, stop class) before the motive joins, so a
    motive that holds a large share of all stops is one row by then.
    """
    seconds = seconds_between(F.col("StartDate"), F.col("EndDate"))
    stops = stopages.where("Active").select("MotiveId", "WorkShiftExecutionId", "Type", seconds.alias("seconds"))
    per_motive = (
        shifts.attach(stops)
        .groupBy("MotiveId", "Type")
        .agg(F.sum("seconds").alias("seconds"), F.count("seconds").alias("timed"), F.count("*").alias("events"))
    )
    named = stop_class_filter(_named(per_motive, motives, motive_types), stop_class, F.coalesce("StoppageType", "Type"))
    return named.groupBy("TypeName", "MotiveName", "StoppageType", "Type").agg(
        F.sum("seconds").alias("seconds"), F.sum("timed").alias("timed"), F.sum("events").alias("events")
    )


def reasons(totals: DataFrame) -> DataFrame:
    """All reasons in report columns. Groups stay apart even where their labels agree."""
    return totals.select(*_report_columns())


def _report_columns() -> list[Column]:
    return [
        F.coalesce("TypeName", F.lit(UNCLASSIFIED)).alias("Tipo_General"),
        F.coalesce("MotiveName", F.lit(UNCLASSIFIED)).alias("Motivo_Particular"),
        F.coalesce("StoppageType", "Type").alias("Clasificacion"),
        (F.col("seconds") / 60.0).alias("Duracion_Min"),
        F.col("events").alias("Eventos"),
        (int_avg(F.col("seconds"), F.col("timed")) / 60.0).alias("Duracion_Promedio_Min"),
    ]


def pareto(totals: DataFrame, top: int) -> DataFrame:
    """TOP ``top`` reasons by minutes."""
    listed = totals.orderBy(
        F.desc_nulls_last("seconds"),
        F.asc_nulls_first("TypeName"),
        F.asc_nulls_first("MotiveName"),
        F.asc_nulls_first("StoppageType"),
        F.asc_nulls_first("Type"),
    ).limit(top)
    return reasons(listed)


def _report_order() -> list[Column]:
    """Order of reason rows. Windows over it run on the few rows of a TOP n."""
    return [
        F.desc_nulls_last("Duracion_Min"),
        F.asc_nulls_first("Tipo_General"),
        F.asc_nulls_first("Motivo_Particular"),
        F.asc_nulls_first("Clasificacion"),
        F.asc("Eventos"),
    ]


def share(reasons: DataFrame) -> DataFrame:
    """Share and running share of the listed rows' own total, one decimal."""
    rows = Window.partitionBy(F.lit(0))
    running = rows.orderBy(*_report_order()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    minutes = F.coalesce("Duracion_Min", F.lit(0.0))
    total, cumulated = F.sum(minutes).over(rows), F.sum(minutes).over(running)
    return reasons.withColumns(
        {
            "Pct_Total": F.when(total > 0, round_py(minutes / total * 100, 1)).otherwise(0.0),
            "Pct_Acumulado": F.when(total > 0, round_py(cumulated / total * 100, 1)).otherwise(0.0),
        }
    )


def share_of_all(totals: DataFrame, parts: int | None = None) -> DataFrame:
    """All reasons with their share and running share of all stop time, without a TOP n.

    ``totals`` are those of :func:`reason_totals`, in the order of :func:`pareto`. Sums are
    over whole seconds; a reason without a timed stop has a share of 0, and so have all
    reasons where nothing was timed.
    """
    order = [
        F.desc_nulls_last("seconds"),
        *[F.asc_nulls_first(c) for c in ("TypeName", "MotiveName", "StoppageType", "Type")],
    ]
    summed = running_sums(totals, order, "seconds", "_running", "_total", parts)
    whole, running = F.col("_total").cast("double"), F.col("_running").cast("double")
    seconds = F.coalesce("seconds", F.lit(0)).cast("double")
    shares = [
        F.when(whole > 0, round_py(part / whole * 100, 1)).otherwise(0.0).alias(name)
        for part, name in ((seconds, "Pct_Total"), (running, "Pct_Acumulado"))
    ]
    return summed.select(*_report_columns(), *shares)


def vital_few(shared: DataFrame, limit: float = 80.0) -> DataFrame:
    return shared.where(F.col("Pct_Acumulado") <= limit)


def np_chart(reasons: DataFrame, top: int = 15, label_length: int = 45) -> DataFrame:
    """Chart rows of unscheduled stops, or of all stops if none is unscheduled.

    Minutes are rounded before they are cumulated.
    """
    rows = Window.partitionBy(F.lit(0))
    unscheduled = F.upper("Clasificacion") == "NP"
    flagged = reasons.withColumn("_np", F.coalesce(unscheduled, F.lit(False)))
    kept = flagged.withColumn("_any", F.max("_np").over(rows)).where(F.col("_np") | ~F.col("_any"))
    ordered = rows.orderBy(*_report_order())
    ranked = kept.withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") <= top)
    ranked = ranked.withColumn("minutes", round_py(F.coalesce("Duracion_Min", F.lit(0.0)), 1))
    running = rows.orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total, cumulated = F.sum("minutes").over(rows), F.sum("minutes").over(running)
    ranked = ranked.withColumn("cum_pct", F.when(total > 0, round_py(cumulated / total * 100, 1)).otherwise(0.0))
    return ranked.select(
        "rank",
        clip_label(F.col("Motivo_Particular"), label_length).alias("label"),
        F.col("Tipo_General").alias("category"),
        "minutes",
        F.col("Eventos").alias("events"),
        "cum_pct",
        (F.col("cum_pct") <= 80).alias("vital_few"),
    )


def class_totals(reasons: DataFrame) -> DataFrame:
    """Events and minutes of the reasons given, unscheduled and scheduled: of all, or of a TOP n."""

    def total(cls: str, column: str, zero: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("Clasificacion") == cls, F.col(column))), zero)

    return reasons.agg(
        total("NP", "Eventos", F.lit(0).cast("long")).alias("np_events"),
        total("NP", "Duracion_Min", F.lit(0.0)).alias("np_minutes"),
        total("P", "Eventos", F.lit(0).cast("long")).alias("p_events"),
        total("P", "Duracion_Min", F.lit(0.0)).alias("p_minutes"),
    )


def hierarchy(reasons: DataFrame, top: int = 20) -> DataFrame:
    """Type totals above their motives; nothing for fewer than two reasons."""
    rows = Window.partitionBy(F.lit(0))
    listed = (
        reasons.orderBy(*_report_order())
        .limit(top)
        .withColumn("_n", F.count("*").over(rows))
        .where(F.col("_n") >= 2)
        .withColumn("minutes", F.coalesce("Duracion_Min", F.lit(0.0)))
    )
    types = listed.groupBy("Tipo_General").agg(F.sum("minutes").alias("minutes"), F.sum("Eventos").alias("events"))
    parents = types.select(
        F.lit(1).alias("level"),
        F.concat(F.lit("T_"), F.col("Tipo_General")).alias("node"),
        F.lit("").alias("parent"),
        F.col("Tipo_General").alias("label"),
        F.lit(None).cast("string").alias("stop_class"),
        round_py(F.col("minutes"), 1).alias("minutes"),
        "events",
    )
    motive = clip_label(F.col("Motivo_Particular"), 45)
    children = listed.select(
        F.lit(2).alias("level"),
        F.concat(F.lit("M_"), F.col("Tipo_General"), F.lit("_"), motive).alias("node"),
        F.concat(F.lit("T_"), F.col("Tipo_General")).alias("parent"),
        motive.alias("label"),
        F.upper("Clasificacion").alias("stop_class"),
        round_py(F.col("minutes"), 1).alias("minutes"),
        F.col("Eventos").alias("events"),
    )
    return parents.unionByName(children)
