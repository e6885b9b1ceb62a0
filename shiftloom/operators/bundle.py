"""One day's sensors, stops and shifts side by side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftloom.functions.texts import shift_rank
from shiftloom.operators.ordered import positions
from shiftloom.operators.sensors import deviation_text, high_deviation


def _section(
    df: DataFrame, section: str, bucket: Column | None, order: list[Column], name: Column, value: Column
) -> DataFrame:
    """Ranked rows of one section.

    ``bucket`` is a coarse form of the order by which the ranking is spread; the few
    rows of a TOP n need none.
    """
    if bucket is None:
        rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)).cast("long")
        ranked = df.withColumn("rank", rank)
    else:
        ranked = positions(df.withColumn("_bucket", bucket), [], "_bucket", order, "rank")
    return ranked.select(
        F.lit(section).alias("section"), "rank", name.alias("name"), value.cast("double").alias("value")
    )


def day_bundle(summary: DataFrame, reasons: DataFrame, shifts: DataFrame) -> DataFrame:
    """Sensor summary, deviating sensors, top stop reasons and OEE per shift as (section, rank, name, value)."""
    c = F.col
    percent = F.floor(-F.coalesce("out_pct", F.lit(-1.0)))
    by_out = [F.desc_nulls_last("out_pct"), F.desc("out_points"), F.asc("var_id")]
    sections = [
        _section(summary, "sensor_summary", percent, by_out, F.concat_ws(" — ", "device", "name"), c("out_pct")),
        _section(high_deviation(summary), "sensors_with_deviations", percent, by_out, deviation_text(), c("out_pct")),
        _section(
            reasons,
            "top_paros_del_dia",
            None,
            [F.desc_nulls_last("Duracion_Min"), F.asc("Tipo_General"), F.asc("Motivo_Particular"), F.asc("Clasificacion"), F.asc("Eventos")],
            F.concat_ws(" / ", "Tipo_General", "Motivo_Particular", "Clasificacion"),
            c("Duracion_Min"),
        ),
        _section(
            shifts,
            "oee_por_turno",
            F.struct(shift_rank(c("Turno")).alias("shift"), F.floor(c("ProductionLineId") / 1000).alias("line")),
            [F.asc("ProductionLineId")],
            F.concat_ws(" / ", "Turno", c("ProductionLineId").cast("string")),
            c("OEE"),
        ),
    ]
    out = sections[0]
    for section in sections[1:]:
        out = out.unionByName(section)
    return out
