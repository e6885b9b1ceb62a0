"""Day, time-of-day and duration functions.

They work on ``timestamp_ntz`` without going through the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A time of day as text, and the free-form day texts that are read, by
# shape. Day comes before month, but for texts that begin with the year, where month comes
# before day. A year of two digits is one of 2000 to 2099.
TIME_TEXT = r"^\s*([01]?[0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9](\.[0-9]+)?)?\s*$"
DAY_SHAPES = (
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{1,2}/\d{1,2}/\d{2}$", "d/M/yy"),
    (r"^\d{1,2}-\d{1,2}-\d{2}$", "d-M-yy"),
    (r"^\d{1,2}\.\d{1,2}\.\d{2}$", "d.M.yy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"),
    (r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2} [A-Za-z]{4,} \d{4}$", "d MMMM yyyy"),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy"),
    (r"^[A-Za-z]{4,} \d{1,2}, \d{4}$", "MMMM d, yyyy"),
    (r"^[A-Za-z]{3} \d{1,2} \d{4}$", "MMM d yyyy"),
    (r"^[A-Za-z]{4,} \d{1,2} \d{4}$", "MMMM d yyyy"),
    (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}$", "yyyy-MM-dd HH:mm"),
    (r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}$", "yyyy-MM-dd'T'HH:mm"),
    (r"^\d{1,2}\.\d{1,2}\.\d{4} \d{2}:\d{2}$", "d.M.yyyy HH:mm"),
    (r"^\d{1,2}\.\d{1,2}\.\d{4} \d{2}:\d{2}:\d{2}$", "d.M.yyyy HH:mm:ss"),
    (r"^\d{1,2}-\d{1,2}-\d{4} \d{2}:\d{2}$", "d-M-yyyy HH:mm"),
    (r"^\d{1,2}-\d{1,2}-\d{4} \d{2}:\d{2}:\d{2}$", "d-M-yyyy HH:mm:ss"),
    (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$", "yyyy-MM-dd HH:mm:ss"),
    (r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$", "yyyy-MM-dd'T'HH:mm:ss"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{2}:\d{2}:\d{2}$", "d/M/yyyy HH:mm:ss"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{2}:\d{2}$", "d/M/yyyy HH:mm"),
)

# Duration words by language (singular, plural), and the last joiner.
DURATION_WORDS = {
    "es": {"day": ("día", "días"), "hour": ("hora", "horas"), "minute": ("minuto", "minutos"), "and": " y "},
    "en": {"day": ("day", "days"), "hour": ("hour", "hours"), "minute": ("minute", "minutes"), "and": " and "},
}


def interval(n: Column | int, unit: str) -> Column:
    """``n`` whole units (second, minute, hour, day) as an interval, without decimal arithmetic."""
    return F.expr(f"INTERVAL '1' {unit.upper()}") * n


def second_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def epoch_second(ts: Column) -> Column:
    """Whole seconds since 1970 of a clock reading, whatever the session time zone."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + second_of_day(ts)


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed from ``start`` to ``end`` (0.9 s to 1.1 s counts 1)."""
    days = F.datediff(F.to_date(end), F.to_date(start)).cast("long")
    return days * 86400 + (second_of_day(end) - second_of_day(start)).cast("long")


def int_avg(total: Column, count: Column) -> Column:
    """Average of integers, truncated to an integer; null for no rows."""
    return F.try_divide(total, count).cast("long")


def minutes_of_time(text: Column) -> Column:
    """Whole minutes since midnight of ``HH:mm[:ss]``; null for anything else."""
    clean = F.trim(text)
    hours = F.split_part(clean, F.lit(":"), F.lit(1)).try_cast("int")
    minutes = F.split_part(clean, F.lit(":"), F.lit(2)).try_cast("int")
    return F.when(text.rlike(TIME_TEXT), hours * 60 + minutes)


def parse_duration_text(text: Column) -> Column:
    """Minutes of a time text; other text falls back to its last two characters."""
    return F.when(text.rlike(TIME_TEXT), minutes_of_time(text)).otherwise(F.right(text, F.lit(2)).try_cast("int"))


def format_duration(minutes: Column, lang: str = "es") -> Column:
    """1500 as ``1 día y 1 hora``; null, zero and negative as ``0 minutos``."""
    words = DURATION_WORDS["en" if lang == "en" else "es"]
    total = F.rint(minutes.cast("double")).cast("long")
    sizes = {"day": F.floor(total / 1440), "hour": F.floor(total % 1440 / 60), "minute": total % 60}

    def part(unit: str) -> Column:
        one, many = words[unit]
        size = sizes[unit]
        label = F.when(size == 1, one).otherwise(many)
        return F.when(size > 0, F.concat(size.cast("string"), F.lit(" "), label))

    joined = F.concat_ws(", ", part("day"), part("hour"), part("minute"))
    text = F.regexp_replace(joined, r", (?=[^,]*$)", words["and"])
    return F.when((minutes > 0) & (total > 0), text).otherwise(F.lit("0 " + words["minute"][1]))


def parse_day(text: Column) -> Column:
    """Day text to ``yyyy-MM-dd``; text that is no day stays as it is.

    A text is only parsed by the pattern whose shape it has: a failed parse costs an
    exception.
    """
    day = F.coalesce(F.trim(text), F.lit(""))
    slashes = r"^(\d{2})/(\d{2})/(\d{4})$"
    out = F.when(day.rlike(r"^\d{4}-\d{2}-\d{2}$"), day).when(
        day.rlike(slashes), F.regexp_replace(day, slashes, "$3-$2-$1")
    )
    for shape, pattern in DAY_SHAPES:
        parsed = F.try_to_timestamp(day, F.lit(pattern)).cast("date").cast("string")
        out = out.when(day.rlike(shape), F.coalesce(parsed, day))
    return out.otherwise(day)


def period_label(start: Column, end: Column, joiner: str = " a ") -> Column:
    """One day, or ``start a end``."""
    first, last = start.cast("string"), end.cast("string")
    return F.when(first == last, first).otherwise(F.concat(first, F.lit(joiner), last))


def date_spine(start: Column, end: Column) -> Column:
    """Inclusive array of days."""
    return F.sequence(start.cast("date"), end.cast("date"))
