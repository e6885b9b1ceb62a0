"""OEE over shifts, days and ranges.

Percentages are never averaged: raw minutes and kilograms are summed first. The
variants differ in how they treat quality, nulls and zero denominators, and keep
those differences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftloom.functions.numbers import (
    divide_or,
    divide_or_null,
    divide_positive_or_one,
    divide_zero_as_one,
    events_text,
    fixed,
    grouped,
    num_coerce,
    round_py,
    round_sql,
    total,
)
from shiftloom.functions.texts import SHIFT_NAMES, shift_rank
from shiftloom.functions.times import format_duration

# Column names accepted for each weighting input.
WEIGHT_ALIASES = {
    "available": ("AvailableTimeMin", "TiempoDisponibleMin"),
    "productive": ("ProductiveTimeMin", "TiempoProductivoMin"),
    "real": ("CurrentProduction", "ProduccionRealKg", "CurrentShiftProduction"),
    "expected": ("ExpectedProduction", "ProduccionEstimadaKg", "ExpectedShiftProduction"),
    "quality": ("Quality", "Producto Conforme", "ProductoConforme", "[Producto Conforme]"),
}
AVAILABILITY_NAMES = ("Availability", "Disponibilidad")
PERFORMANCE_NAMES = ("Performance", "Desempeno", "Desempeño")
QUALITY_NAMES = ("Quality", "Producto Conforme", "ProductoConforme")


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0.0))


def detail(star: DataFrame) -> DataFrame:
    """One row per shift. Unordered, since other reports start from it; see :func:`detail_report`."""
    return star.select(
        "Fecha",
        "Turno",
        F.col("Oee").alias("OEE"),
        "AvailableTimeMin",
        "ProductiveTimeMin",
        _zero("UnscheduledStopageMin").alias("TiempoNoProdNoProgramadoMin"),
        _zero("ScheduledStopageMin").alias("TiempoNoProdProgramadoMin"),
        F.col("CurrentProductionSummary").alias("CurrentProduction"),
        F.col("ExpectedProductionSummaryModified").alias("ExpectedProduction"),
        "Quality",
        F.coalesce("UnscheduledStopagesCount", F.lit(0)).alias("ParosNoProgramadosCont"),
        F.coalesce("ScheduledStopagesCount", F.lit(0)).alias("ParosProgramadosCont"),
    )


def detail_report(star: DataFrame) -> DataFrame:
    """Shift rows, newest business date first."""
    return detail(star).orderBy(F.desc("Fecha"), "Turno")


def stored(star: DataFrame, by_rank: bool) -> DataFrame:
    """Stored shift KPIs and counts; a single day is ordered by shift rank, a range by shift name."""
    out = star.select(
        "Turno",
        "Fecha",
        F.col("Oee").alias("OEE"),
        F.col("Availability").alias("Disponibilidad"),
        F.col("Performance").alias("Desempeno"),
        F.col("Quality").alias("Producto Conforme"),
        F.coalesce("UnscheduledStopagesCount", F.lit(0)).alias("ParosNoProgramadosCont"),
        F.col("UnscheduledStopageMin").alias("TiempoNoProdNoProgramadoMin"),
        F.coalesce("ScheduledStopagesCount", F.lit(0)).alias("ParosProgramadosCont"),
        F.col("ScheduledStopageMin").alias("TiempoNoProdProgramadoMin"),
        F.col("WorkshiftDurationMin").alias("DuracionTurnoMin"),
        F.col("AvailableTimeMin").alias("TiempoDisponibleMin"),
        F.col("ProductiveTimeMin").alias("TiempoProductivoMin"),
        F.col("ExpectedProductionSummaryModified").alias("ProduccionEstimadaKg"),
        F.col("CurrentProductionSummary").alias("ProduccionRealKg"),
        F.col("AvgExpectedVelocity").alias("VelocidadPromedioEstimadaKgHr"),
        F.col("AvgCurrentVelocity").alias("VelocidadPromedioRealKgHr"),
    )
    return out.orderBy("Fecha", shift_rank(F.col("Turno")) if by_rank else F.col("Turno"))


def consolidated(star: DataFrame) -> DataFrame:
    """One row of totals and KPIs; quality comes from confiscated kilograms."""
    sums = star.agg(
        total("AvailableTimeMin").alias("avail"),
        total("ProductiveTimeMin").alias("prod"),
        total("CurrentProductionSummary").alias("real"),
        total("ExpectedProductionSummaryModified").alias("expected"),
        total(F.col("CurrentProductionSummary") - F.col("ConfiscationKg")).alias("conforming"),
    )
    availability = divide_or(F.col("prod"), F.col("avail"), 0.0)
    performance = divide_or(F.col("real"), F.col("expected"), 0.0)
    quality = divide_or_null(F.col("conforming"), F.col("real"))
    return sums.select(
        round_sql(F.col("avail"), 2).alias("TotalAvailableMin"),
        round_sql(F.col("prod"), 2).alias("TotalProductiveMin"),
        round_sql(F.col("real"), 2).alias("TotalRealKg"),
        round_sql(F.col("expected"), 2).alias("TotalExpectedKg"),
        round_sql(availability * 100, 2).alias("Availability"),
        round_sql(performance * 100, 2).alias("Performance"),
        round_sql(quality * 100, 2).alias("Quality"),
        round_sql(availability * performance * F.coalesce(quality, F.lit(1.0)) * 100, 2).alias("OEE"),
    )


def range_enrichment(summary: DataFrame, details: DataFrame) -> DataFrame:
    """The consolidated row with plan compliance, kilogram gap and total stop minutes."""
    stops = details.agg(
        F.struct(
            total(F.coalesce("TiempoNoProdNoProgramadoMin", F.lit(0.0))).alias("np"),
            total(F.coalesce("TiempoNoProdProgramadoMin", F.lit(0.0))).alias("p"),
        ).alias("s")
    ).scalar()
    real, expected = _zero("TotalRealKg"), _zero("TotalExpectedKg")
    return (
        summary.withColumn("_s", stops)
        .withColumns(
            {
                "CumplimientoPlan_Pct": round_py(divide_or(real, expected, 0.0) * 100, 1),
                "GapProduccion_Kg": round_py(expected - real, 1),
                "TotalParosNoProgramadosMin": round_py(F.coalesce(F.col("_s.np"), F.lit(0.0)), 1),
                "TotalParosProgramadosMin": round_py(F.coalesce(F.col("_s.p"), F.lit(0.0)), 1),
            }
        )
        .drop("_s")
    )


def daily(details: DataFrame, rounded: bool = True, zero_quality_as_100: bool = False) -> DataFrame:
    """Totals and KPIs per business date. The report form is unrounded and takes quality 0 as 100."""
    quality = F.coalesce(F.col("Quality"), F.lit(100.0))
    if zero_quality_as_100:
        quality = F.when(quality == 0, F.lit(100.0)).otherwise(quality)
    real = _zero("CurrentProduction")
    sums = details.groupBy("Fecha").agg(
        total(_zero("ProductiveTimeMin")).alias("prod"),
        total(_zero("AvailableTimeMin")).alias("avail"),
        total(real).alias("real"),
        total(_zero("ExpectedProduction")).alias("exp"),
        total(quality / 100 * real).alias("conf"),
        total("TiempoNoProdNoProgramadoMin").alias("np_min"),
        total("TiempoNoProdProgramadoMin").alias("p_min"),
        F.sum("ParosNoProgramadosCont").alias("np_cnt"),
        F.sum("ParosProgramadosCont").alias("p_cnt"),
    )
    c = F.col
    availability, performance = divide_or(c("prod"), c("avail"), 0.0), divide_or(c("real"), c("exp"), 0.0)
    oee = availability * performance * divide_or(c("conf"), c("real"), 1.0) * 100

    def shown(value: Column, places: int) -> Column:
        return round_py(value, places) if rounded else value

    return sums.select(
        "Fecha",
        shown(oee, 1).alias("OEE"),
        shown(availability * 100, 1).alias("Disponibilidad"),
        shown(performance * 100, 1).alias("Desempeno"),
        shown(c("real"), 0).alias("RealKg"),
        shown(c("exp"), 0).alias("EsperadaKg"),
        shown(c("np_min"), 1).alias("ParosNoProgMin"),
        shown(c("p_min"), 1).alias("ParosProgMin"),
        c("np_cnt").alias("ParosNoProgCont"),
        c("p_cnt").alias("ParosProgCont"),
    ).orderBy("Fecha")


def by_shift(details: DataFrame, label: str, lang: str = "es") -> DataFrame:
    """Range table of texts, one row per known shift. Quality is a plain mean here, null counted as 0."""
    sums = (
        details.where(F.col("Turno").isin(*SHIFT_NAMES))
        .groupBy("Turno")
        .agg(
            total(_zero("AvailableTimeMin")).alias("avail"),
            total(_zero("ProductiveTimeMin")).alias("prod"),
            total(_zero("CurrentProduction")).alias("real"),
            total(_zero("ExpectedProduction")).alias("exp"),
            total("TiempoNoProdNoProgramadoMin").alias("np_min"),
            total("TiempoNoProdProgramadoMin").alias("p_min"),
            F.sum("ParosNoProgramadosCont").alias("np_cnt"),
            F.sum("ParosProgramadosCont").alias("p_cnt"),
            (total(_zero("Quality")) / F.count("*")).alias("quality"),
        )
    )
    c = F.col
    availability = divide_positive_or_one(c("prod"), c("avail"))
    performance = divide_positive_or_one(c("real"), c("exp"))
    return sums.orderBy(shift_rank(c("Turno"))).select(
        F.lit(label).alias("Fecha"),
        "Turno",
        fixed(availability * performance * (c("quality") / 100) * 100, 1, "%").alias("OEE"),
        fixed(availability * 100, 1, "%").alias("Disponibilidad"),
        fixed(performance * 100, 1, "%").alias("Desempeno"),
        fixed(c("quality"), 1, "%").alias("Producto Conforme"),
        grouped(c("real")).alias("Producción Real (Kg)"),
        grouped(c("exp")).alias("Producción Esperada (Kg)"),
        format_duration(c("np_min"), lang).alias("Paros no programados (Duración)"),
        events_text(c("np_cnt")).alias("Paros No Prog (Eventos)"),
        format_duration(c("p_min"), lang).alias("Paros programados (Duración)"),
        events_text(c("p_cnt")).alias("Paros Prog (Eventos)"),
    )


def without_quality(star: DataFrame) -> DataFrame:
    """Shift count, sums, and OEE as availability times performance, from duration and the original plan."""
    sums = star.agg(
        F.count("WorkShiftExecutionId").alias("TotalTurnos"),
        total("AvailableTimeMin").alias("MinutosDisp"),
        total("WorkshiftDurationMin").alias("MinutosDur"),
        total("CurrentProductionSummary").alias("RealKg"),
        total("ExpectedProductionSummary").alias("EsperadaKg"),
    )
    availability = divide_or_null(F.col("MinutosDisp"), F.col("MinutosDur"))
    performance = divide_or_null(F.col("RealKg"), F.col("EsperadaKg"))
    return sums.withColumns({"Disponibilidad": availability, "Desempeno": performance, "OEE": availability * performance})


def resolve(df: DataFrame, aliases: tuple[str, ...]) -> str | None:
    """First column whose trimmed name is an accepted alias."""
    return next((name for name in df.columns if name.strip() in aliases), None)


def weight_columns(df: DataFrame) -> dict[str, str | None]:
    return {role: resolve(df, aliases) for role, aliases in WEIGHT_ALIASES.items()}


def can_weight(df: DataFrame) -> bool:
    found = weight_columns(df)
    return all(found[role] for role in ("available", "productive", "real", "expected"))


def _weighted_sums(df: DataFrame, x: str, null_quality: float) -> DataFrame:
    cols = weight_columns(df)
    number = {r: num_coerce(F.col(f"`{n}`"), null_quality if r == "quality" else 0.0) for r, n in cols.items() if n}
    conforming = number["quality"] / 100 * number["real"] if cols["quality"] else number["real"]
    sums = df.groupBy(x).agg(
        total(number["available"]).alias("_avail"),
        total(number["productive"]).alias("_prod"),
        total(number["real"]).alias("_real"),
        total(number["expected"]).alias("_exp"),
        total(conforming).alias("_conf"),
    )
    c = F.col
    quality = F.lit(100.0)
    if cols["quality"]:
        quality = F.when(c("_real") == 0, 100.0).otherwise(divide_zero_as_one(c("_conf"), c("_real")) * 100)
    out = sums.select(
        "*",
        (divide_zero_as_one(c("_prod"), c("_avail")) * 100).alias("_availability"),
        (divide_zero_as_one(c("_real"), c("_exp")) * 100).alias("_performance"),
        quality.alias("_quality"),
    )
    return out.withColumn("_oee", c("_availability") * c("_performance") * c("_quality") / 10000)


def kpi_source(y: str, oee_name: str) -> str | None:
    """Which weighted KPI fills a chart column."""
    if y == oee_name:
        return "_oee"
    for names, source in (
        (AVAILABILITY_NAMES, "_availability"),
        (PERFORMANCE_NAMES, "_performance"),
        (QUALITY_NAMES, "_quality"),
    ):
        if y in names:
            return source
    return None


def oee_column(ys: list[str]) -> str:
    return next((y for y in ys if "OEE" in y.upper()), ys[0])


def weighted(df: DataFrame, x: str, ys: list[str]) -> DataFrame:
    """OEE weighted by raw inputs for each ``x``. Null quality counts as 100, no quality column as 100."""
    sums = _weighted_sums(df.where(F.col(x).isNotNull()), x, null_quality=100.0)
    name, cols = oee_column(ys), weight_columns(df)
    raw = {cols["available"]: "_avail", cols["productive"]: "_prod", cols["real"]: "_real", cols["expected"]: "_exp"}
    return sums.select(x, *[F.col(src).alias(y) for y in ys if (src := kpi_source(y, name) or raw.get(y))])


def weighted_requery(star: DataFrame) -> DataFrame:
    """Weighted KPIs per business date from the stored raw inputs. Null quality counts as 0 here."""
    raw = star.select(
        "Fecha",
        "AvailableTimeMin",
        "ProductiveTimeMin",
        F.col("CurrentProductionSummary").alias("CurrentProduction"),
        F.col("ExpectedProductionSummaryModified").alias("ExpectedProduction"),
        "Quality",
    )
    return _weighted_sums(raw, "Fecha", null_quality=0.0)


def map_back_weighted(df: DataFrame, weights: DataFrame, x: str, ys: list[str]) -> DataFrame:
    """Put each date's weighted KPIs on the chart rows; rows without a match keep their value."""
    name = oee_column(ys)
    key = F.coalesce(F.col(f"`{x}`").try_cast("date"), F.left(F.trim(F.col(f"`{x}`").cast("string")), F.lit(10)).try_cast("date"))
    joined = df.withColumn("_day", key).join(weights.withColumnRenamed("Fecha", "_day"), "_day", "left")
    filled = {y: F.coalesce(F.col(src), F.col(f"`{y}`").try_cast("double")) for y in ys if (src := kpi_source(y, name))}
    return joined.withColumns(filled).select(*[F.col(f"`{c}`") for c in df.columns])


def from_times(df: DataFrame, duration: str, scheduled: str, unscheduled: str, real: str, expected: str, quality: str) -> DataFrame:
    """Time algebra and KPIs of a row from raw minutes: available, productive, A, P and OEE in percent."""
    c = F.col
    out = df.withColumn("available_min", c(duration) - c(scheduled))
    out = out.withColumn("productive_min", c("available_min") - c(unscheduled))
    out = out.withColumn("availability_pct", divide_or_null(c("productive_min"), c("available_min")) * 100)
    out = out.withColumn("performance_pct", divide_or_null(c(real), c(expected)) * 100)
    return out.withColumn("oee_pct", c("availability_pct") * c("performance_pct") * c(quality) / 10000)


def oee_band(oee: Column) -> Column:
    """World class from 85, at risk from 65, critical below."""
    return F.when(oee >= 85, "Clase Mundial").when(oee >= 65, "En Riesgo").when(oee < 65, "Crítico")


def limiting_kpi(availability: Column, performance: Column, quality: Column) -> Column:
    """Lowest of the three KPIs: its name, value, and whether it is under its own threshold."""
    # Thresholds under which each KPI points to a problem.
    kpis = ((availability, "Disponibilidad", 70.0), (performance, "Desempeño", 80.0), (quality, "Producto conforme", 95.0))
    ranked = [
        F.struct(
            value.cast("double").alias("value"),
            F.lit(order).alias("order"),
            F.lit(name).alias("kpi"),
            (value < limit).alias("below"),
        )
        for order, (value, name, limit) in enumerate(kpis)
    ]
    present = F.filter(F.array(*ranked), lambda k: k["value"].isNotNull())
    return F.when(F.size(present) > 0, F.array_min(present))


def worst_shifts(details: DataFrame, n: int = 5) -> DataFrame:
    """Rows with the lowest stored OEE, null counted as 0; ties by date, shift, output and plan."""
    return details.orderBy(
        F.coalesce("OEE", F.lit(0.0)), "Fecha", "Turno", "CurrentProduction", "ExpectedProduction"
    ).limit(n)


def kpi_fallback(details: DataFrame) -> DataFrame:
    """Plain mean OEE of the rows that have one, total output and unscheduled minutes."""
    return details.agg(
        F.avg("OEE").alias("oee_promedio"),
        total(_zero("CurrentProduction")).alias("produccion_total"),
        total(F.coalesce("TiempoNoProdNoProgramadoMin", F.lit(0.0))).alias("paros_no_prog_min"),
        F.count("*").alias("turnos"),
    )
