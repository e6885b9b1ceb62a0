"""The reports a plant user asks for, by day range, shift, stop class or sensor.

Each method takes plain parameters and gives DataFrames; nothing runs until they
are used, except where a value of one row decides what to read.
"""

from __future__ import annotations

from dataclasses import dataclass, fields
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftloom.functions.times import parse_day
from shiftloom.operators import catalog as cat
from shiftloom.operators import charts, intervals, oee, sensors, stops
from shiftloom.operators.bundle import day_bundle
from shiftloom.operators.business import RECIPES, Shifts, shift_star
from shiftloom.schemas import conform
from shiftloom.sources.reads import days_between


@dataclass(frozen=True)
class Tables:
    """The plant tables; columns as in :mod:`shiftloom.schemas`."""

    templates: DataFrame
    executions: DataFrame
    summaries: DataFrame
    stopages: DataFrame
    motives: DataFrame
    motive_types: DataFrame
    intervals: DataFrame
    lines: DataFrame
    catalog: DataFrame
    reads: DataFrame

    @classmethod
    def load(cls, spark: SparkSession, base: str) -> Tables:
        """Parquet folders named like the tables."""
        return cls(**{f.name: conform(spark.read.parquet(f"{base}/{f.name}"), f.name) for f in fields(cls)})


class Reports:
    """Reports over one set of plant tables. ``today`` stands in for the clock in tests."""

    def __init__(self, tables: Tables, lang: str = "es", today: date | None = None):
        self.t = tables
        self.lang = lang
        self._today = today

    @property
    def today(self) -> date:
        return self._today or date.today()

    # --- shared ------------------------------------------------------------

    def _shifts(self, recipe: str, first: str, last: str, shift: str | None) -> Shifts:
        return Shifts(self.t.executions, self.t.templates, RECIPES[recipe], first, last, shift)

    def _star(self, recipe: str, first: str, last: str, shift: str | None) -> DataFrame:
        return shift_star(self.t.summaries, self._shifts(recipe, first, last, shift))

    def _totals(self, recipe: str, first: str, last: str, shift: str | None, stop_class: str | None = None) -> DataFrame:
        shifts = self._shifts(recipe, first, last, shift)
        return stops.reason_totals(self.t.stopages, self.t.motives, self.t.motive_types, shifts, stop_class)

    def _reasons(self, recipe: str, first: str, last: str, shift: str | None, top: int, stop_class: str | None = None) -> DataFrame:
        return stops.pareto(self._totals(recipe, first, last, shift, stop_class), top)

    def _reads(self, first: str, last: str) -> DataFrame:
        return self.t.reads.where(F.col("Day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))

    # --- line and shifts -----------------------------------------------------

    def snapshot(self, line_pattern: str | None = None, lookback: str = "shift", per_line: bool = False) -> DataFrame:
        """Newest snapshot; stop counts since the shift began, or over the last ``hour``."""
        return intervals.snapshots(self.t.intervals, self.t.lines, line_pattern, lookback == "shift", per_line)

    def realtime(self, line_pattern: str | None = None) -> dict[str, DataFrame]:
        """Snapshot with today's stop totals, its metrics and plan outlook, and today's top 10 reasons."""
        snap = self.snapshot(line_pattern)
        totals = self._totals("pareto_day_off", str(self.today), str(self.today), None)
        reasons = stops.pareto(totals, 10)
        synced = intervals.synced(snap, stops.class_totals(stops.reasons(totals)), self.lang)
        return {
            "snapshot": synced,
            "metrics": intervals.snapshot_metrics(synced),
            "outlook": intervals.day_target_outlook(snap),
            "stop_reasons": reasons,
        }

    def shift_day(self, day: str | None = None, shift: str | None = None, recount: bool = False) -> DataFrame:
        """Shifts of a day, yesterday by default; ``recount`` counts stops from the intervals."""
        wanted = day or str(self.today - timedelta(days=1))
        if recount:
            return self._recounted(wanted, shift)
        return oee.stored(self._star("chat_day", wanted, wanted, shift), by_rank=True)

    def _recounted(self, day: str, shift: str | None) -> DataFrame:
        execs = self._shifts("shift_day", day, day, shift).rows()
        return intervals.shift_day(self._star("shift_day", day, day, shift), self.t.intervals, executions=execs)

    def shift_range(self, first: str | None = None, last: str | None = None, shift: str | None = None) -> DataFrame:
        """Shifts of a range, the last 7 days up to today by default."""
        begin, end = first or str(self.today - timedelta(days=7)), last or str(self.today)
        return oee.stored(self._star("chat_range", begin, end, shift), by_rank=False)

    def oee_range(self, first: str, last: str | None = None, shift: str | None = None) -> dict[str, DataFrame]:
        """Consolidated KPIs, top 20 reasons, shift rows, days, shifts, worst shifts and chart frames of a range."""
        last = last or first
        star = self._star("detail", first, last, shift)
        details = oee.detail(star)
        reasons = self._reasons("pareto_day_off", first, last, shift, 20)
        joiner = " to " if self.lang == "en" else " a "
        summary = oee.consolidated(star)
        return {
            "summary": summary,
            "enriched": oee.range_enrichment(summary, details),
            "stop_reasons": reasons,
            "pareto_chart": stops.np_chart(reasons),
            "hierarchy": stops.hierarchy(reasons),
            "details": oee.detail_report(star),
            "daily": oee.daily(details),
            "daily_report": oee.daily(details, rounded=False, zero_quality_as_100=True),
            "by_shift": oee.by_shift(details, first if first == last else f"{first}{joiner}{last}", self.lang),
            "worst": oee.worst_shifts(details),
            "kpis": oee.kpi_fallback(details),
        }

    def oee_charts(self, first: str | None = None, last: str | None = None, shift: str | None = None) -> DataFrame:
        """Consolidated OEE by day."""
        begin = first or str(self.today)
        return oee.daily(oee.detail(self._star("detail", begin, last or begin, shift)))

    def stop_reasons(
        self, first: str | None = None, last: str | None = None, shift: str | None = None, stop_class: str | None = None, top: int = 30
    ) -> dict[str, DataFrame]:
        """Stop reasons with shares, and those that make up 80 %."""
        begin = first or str(self.today)
        shared = stops.share(self._reasons("pareto", begin, last or begin, shift, top, stop_class))
        return {"reasons": shared, "pareto_80": stops.vital_few(shared)}

    # --- sensors -------------------------------------------------------------

    def control_variables(self, first: str, last: str | None = None) -> dict[str, DataFrame]:
        """Critical sensors of a range: summary, text, health, worst three."""
        begin, end = self._day(first), self._day(last or first)
        summary = sensors.summary(sensors.critical_reads(self._reads(begin, end), self.t.catalog), self.t.catalog)
        return {
            "summary": summary,
            "text": sensors.exec_summary(summary, begin, end),
            "health": sensors.process_health(summary),
            "worst": sensors.worst(summary),
        }

    def correlation(self, day: str | None = None) -> dict[str, DataFrame]:
        """One day's sensors, reasons and shifts, and which excursions overlap which stops of their line."""
        wanted = day or str(self.today)
        reads = self._reads(wanted, wanted)
        summary = sensors.summary(sensors.critical_reads(reads, self.t.catalog), self.t.catalog)
        reasons = self._reasons("pareto", wanted, wanted, None, 10)
        shifts = self._recounted(wanted, None)
        found = sensors.episodes(reads)
        return {
            "bundle": day_bundle(summary, reasons, shifts),
            "overlap": sensors.episode_stops(found, self._stops_of(wanted)),
        }

    def _stops_of(self, day: str) -> DataFrame:
        """Stops that may overlap a plant day, which ends the next morning.

        Only intervals of these days are read, with each line's last one before them and
        its first one after them, so that a stop has its true beginning and end.
        """
        begin, rows = F.col("IntervalBegin"), self.t.intervals
        first, last = F.lit(day).cast("date"), F.date_add(F.lit(day).cast("date"), 2)
        line = rows.groupBy("ProductionLineId")
        ends = line.agg(
            F.coalesce(F.max(F.when(begin < first, begin)), F.min(begin)).alias("_a"),
            F.coalesce(F.min(F.when(begin >= last, begin)), F.max(begin)).alias("_b"),
        )
        near = rows.join(ends, "ProductionLineId").where(begin.between(F.col("_a"), F.col("_b"))).drop("_a", "_b")
        return intervals.status_stops(near)

    def list_control_variables(self) -> DataFrame:
        return cat.all_sensors(self.t.catalog)

    def variable(
        self, query: str, first: str, last: str | None = None, most_days: int | None = None
    ) -> dict[str, DataFrame]:
        """Series of one sensor, found by id or words; a range over ``most_days`` is an error, if given.

        The one catalog row is fetched first, so that its id reaches the scan.
        """
        begin, end = self._day(first), self._day(last or first)
        days_between(begin, end, most_days)
        found = cat.find_sensor(self.t.catalog, query)
        row = found.first()
        if row is None:
            raise LookupError(f"no sensor for {query!r}")
        reads = sensors.of_sensor(self._reads(begin, end), row["var_id"])
        banded = sensors.against_catalog_band(reads, found.select("var_id", "min_val", "max_val"))
        return {
            "sensor": found,
            "points": sensors.split_points(banded).select("LocalTime", "Value", "point_class").orderBy("LocalTime"),
            "totals": sensors.variable_out_pct(banded),
            "span": sensors.span(reads),
        }

    # --- charts --------------------------------------------------------------

    def chart(self, df: DataFrame, spec: charts.ChartSpec) -> DataFrame:
        """Chart frame of rows a caller has.

        OEE over dates is not drawn from those rows: the stored shifts of the same
        dates, and of the same shift if the rows hold just one, are consolidated by
        day instead.
        """
        dates = next((c for c in df.columns if c.lower() in ("fecha", "date")), None)
        about_oee = any("OEE" in name.upper() for name in [*spec.ys, *df.columns])
        if not (about_oee and dates and (not spec.x or spec.x.lower() == dates.lower())):
            first, last = None, None
            star = None
            if dates:
                first, last = self._ends(df, dates)
                star = self._star("weighted_requery", first, last, None)
            return charts.chart_frame(df, spec, star)
        first, last = self._ends(df, dates)
        return self.oee_charts(first, last, self._single_shift(df))

    def _ends(self, df: DataFrame, column: str) -> tuple[str, str]:
        day = charts.quoted(column).cast("string").try_cast("date")
        row = df.agg(F.min(day).alias("a"), F.max(day).alias("b")).first()
        return str(row["a"] or self.today), str(row["b"] or self.today)

    def _single_shift(self, df: DataFrame) -> str | None:
        column = next((c for c in df.columns if c.lower() in ("turno", "shift")), None)
        if column is None:
            return None
        row = df.agg(F.min(charts.quoted(column)).alias("a"), F.max(charts.quoted(column)).alias("b")).first()
        return row["a"] if row["a"] == row["b"] else None

    def _day(self, text: str) -> str:
        """A day as the user writes it, as ``yyyy-MM-dd``."""
        spark = self.t.templates.sparkSession
        day = spark.range(1).select(parse_day(F.lit(text)).alias("day")).first()["day"]
        date.fromisoformat(day)
        return day
