"""Numeric coercion, guarded division, rounding and number texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def num_coerce(col: Column, default: float | None = None) -> Column:
    """Text or number to double; text that is no number becomes null or ``default``."""
    value = col.try_cast("double")
    return value if default is None else F.coalesce(value, F.lit(default))


def divide_or_null(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double"))


def divide_or(num: Column, den: Column, default: float) -> Column:
    """``num / den`` where ``den`` is positive, otherwise ``default``."""
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(default))


def divide_zero_as_one(num: Column, den: Column) -> Column:
    """A zero denominator counts as 1."""
    return num.cast("double") / F.when(den == 0, F.lit(1.0)).otherwise(den.cast("double"))


def divide_positive_or_one(num: Column, den: Column) -> Column:
    """A denominator that is not positive counts as 1."""
    return num.cast("double") / F.when(den > 0, den.cast("double")).otherwise(F.lit(1.0))


def round_sql(col: Column, places: int) -> Column:
    """Half away from zero, as SQL warehouses round floats: scale, round to an integer, scale back."""
    scale = float(10**places)
    return F.round(col * F.lit(scale), 0) / F.lit(scale)


def round_py(col: Column, places: int) -> Column:
    """Half to even, as numpy rounds: scale, take the nearest even integer, scale back."""
    scale = float(10**places)
    return F.rint(col * F.lit(scale)) / F.lit(scale)


def total(col: Column | str) -> Column:
    """Sum of doubles that does not depend on the order of addition.

    Partial sums arrive in any order, and a task may run again elsewhere. Each value is
    added as a decimal of ten places, exactly; what is no finite number does not count.
    """
    value = F.col(col) if isinstance(col, str) else col
    return F.sum(value.try_cast("decimal(38,10)")).cast("double")


def fixed(col: Column, places: int, suffix: str = "") -> Column:
    """``1234.5`` as ``1234.50`` (no thousands separator)."""
    text = F.translate(F.format_number(col.cast("double"), places), ",", "")
    return F.concat(text, F.lit(suffix)) if suffix else text


def grouped(col: Column, places: int = 0) -> Column:
    """``1234567`` as ``1,234,567``."""
    return F.format_number(col.cast("double"), places)


def events_text(col: Column) -> Column:
    return F.concat(col.cast("long").cast("string"), F.lit(" ev."))
