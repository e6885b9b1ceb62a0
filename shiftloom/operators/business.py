"""Business date, recipe filters and the shift joins every report starts from."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftloom.functions.texts import ALL_SHIFTS

Day = str | date | Column


@dataclass(frozen=True)
class Recipe:
    """Which standard row filters a report applies."""

    closed: bool = False
    execution_active: bool = False
    summary_active: bool = False
    template_active: bool = False
    skip_day_off: bool = False
    stop_active: bool = False


# The filters of each report differ and must not be unified.
RECIPES = {
    "chat_day": Recipe(closed=True, execution_active=True, summary_active=True, template_active=True),
    "chat_range": Recipe(closed=True, execution_active=True, summary_active=True, template_active=True),
    "shift_day": Recipe(closed=True, execution_active=True, summary_active=True, template_active=True),
    "consolidated": Recipe(closed=True, execution_active=True, summary_active=True, skip_day_off=True),
    "detail": Recipe(closed=True, execution_active=True, summary_active=True, skip_day_off=True),
    "weighted_requery": Recipe(closed=True, execution_active=True, summary_active=True, skip_day_off=True),
    "pareto_day_off": Recipe(skip_day_off=True, stop_active=True),
    "pareto": Recipe(stop_active=True),
    "no_quality": Recipe(closed=True, execution_active=True, summary_active=True),
}


def day_col(day: Day) -> Column:
    return day if isinstance(day, Column) else F.lit(str(day)).cast("date")


def crosses_midnight() -> Column:
    """``HH:mm`` texts of equal length compare like times."""
    return F.col("EndTime") < F.col("StartTime")


def business_date() -> Column:
    """A shift that ends the next morning belongs to the day it began."""
    return F.when(crosses_midnight(), F.date_sub(F.to_date("EndDate"), 1)).otherwise(F.to_date("StartDate"))


def default_day(day: Day | None, today: Day | None = None) -> Column:
    """A missing day means yesterday."""
    now = F.current_date() if today is None else day_col(today)
    return F.date_sub(now, 1) if day is None else day_col(day)


def default_range(from_day: Day | None, to_day: Day | None, today: Day | None = None) -> tuple[Column, Column]:
    """A missing range means the last 7 days up to today."""
    now = F.current_date() if today is None else day_col(today)
    first = F.date_sub(now, 7) if from_day is None else day_col(from_day)
    last = now if to_day is None else day_col(to_day)
    return first, last


def shift_filter(df: DataFrame, shift: str | None, column: str = "Turno") -> DataFrame:
    """Exact shift name; no name and the words for "all" keep every shift."""
    if shift is None or not shift.strip() or shift in ALL_SHIFTS or shift.lower() in ("todos", "(todos)", "all", "(all)"):
        return df
    return df.where(F.col(column) == shift)


@dataclass(frozen=True)
class Shifts:
    """Shift executions and templates with a report's filters: recipe, business-date range, shift name."""

    executions: DataFrame
    templates: DataFrame
    recipe: Recipe
    from_day: Day | None = None
    to_day: Day | None = None
    shift: str | None = None

    def _executions(self) -> DataFrame:
        """Executions by the filters that need no template.

        The date filter on the computed date cannot reach the scan. What it implies
        for the two stored clock columns can, and holds for any shift length.
        """
        rows = self.executions
        if self.recipe.closed:
            rows = rows.where(F.col("Status") == "closed")
        if self.recipe.execution_active:
            rows = rows.where("Active")
        if self.recipe.skip_day_off:
            rows = rows.where(~F.col("DayOff"))
        if self.from_day is not None and self.to_day is not None:
            first, last = day_col(self.from_day), day_col(self.to_day)
            rows = rows.where(
                ((F.col("StartDate") >= first) & (F.col("StartDate") < F.date_add(last, 1)))
                | ((F.col("EndDate") >= F.date_add(first, 1)) & (F.col("EndDate") < F.date_add(last, 2)))
            )
        return rows.select("WorkShiftExecutionId", "WorkShiftTemplateId", "StartDate", "EndDate")

    def _dated(self, rows: DataFrame) -> DataFrame:
        """Add shift name (``Turno``) and business date (``Fecha``), and keep the wanted ones."""
        temps = self.templates.where("Active") if self.recipe.template_active else self.templates
        temps = temps.select("WorkShiftTemplateId", F.col("Name").alias("Turno"), "StartTime", "EndTime")
        out = rows.join(temps, "WorkShiftTemplateId").withColumn("Fecha", business_date())
        if self.from_day is not None and self.to_day is not None:
            out = out.where(F.col("Fecha").between(day_col(self.from_day), day_col(self.to_day)))
        return shift_filter(out, self.shift).drop("StartTime", "EndTime", "WorkShiftTemplateId")

    def rows(self) -> DataFrame:
        return self._dated(self._executions())

    def attach(self, facts: DataFrame) -> DataFrame:
        """Facts with their shift.

        Facts meet the executions first and the few templates last: the planner then
        compares the sizes of the two large tables, not of a table and a join.
        """
        return self._dated(facts.join(self._executions(), "WorkShiftExecutionId"))


def shift_star(summaries: DataFrame, shifts: Shifts) -> DataFrame:
    """Shift summaries with execution and template, filtered by a recipe."""
    rows = summaries.where("Active") if shifts.recipe.summary_active else summaries
    return shifts.attach(rows.drop("Active"))


def on_dates(star: DataFrame, days: list[Day]) -> DataFrame:
    """Rows whose business date is in a given list.

    What the list implies for the stored clock columns is stated too, so that it reaches
    the scan where the rows still have them.
    """
    wanted = star.where(F.col("Fecha").isin(*[day_col(d) for d in days]))
    if not days or not {"StartDate", "EndDate"} <= set(star.columns):
        return wanted

    def within(column: str, day: Day, after: int) -> Column:
        first = F.date_add(day_col(day), after)
        return (F.col(column) >= first) & (F.col(column) < F.date_add(first, 1))

    near = [within("StartDate", d, 0) | within("EndDate", d, 1) for d in days]
    return wanted.where(reduce(Column.__or__, near))


def null_defaults(df: DataFrame, labels: dict[str, str] | None = None, numbers: tuple[str, ...] = ()) -> DataFrame:
    """Named labels and zero for null labels and numbers."""
    filled = {c: F.coalesce(F.col(c), F.lit(text)) for c, text in (labels or {}).items()}
    filled |= {c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in numbers}
    return df.withColumns(filled)
