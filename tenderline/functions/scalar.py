"""Column expressions shared by the jobs."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, functions as F

AsOf = date | datetime | str


def moment(value: AsOf, dtype: str = "timestamp_ntz") -> Column:
    """A date or time given by the caller, as a literal of the column type it meets.

    The text form keeps the driver's own time zone out of it.
    """
    text = value if isinstance(value, str) else str(value)
    return F.lit(text).cast(dtype)


def as_of_year(value: AsOf) -> int:
    return int(str(value)[:4])


def day_before(value: AsOf) -> datetime:
    """The default high-water mark of an incremental run."""
    return datetime.fromisoformat(str(value)) - timedelta(days=1)


def year_of(column: str | Column) -> Column:
    return F.year(column).cast("int")


def epoch_seconds(column: str) -> Column:
    """Seconds since 1970 with microseconds, read off the clock fields as written.

    Works from the fields of a zone-less timestamp, so the session zone has no say.
    """
    c = F.col(column)
    days = F.unix_date(c.cast("date")).cast("long")
    whole = days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60
    return (whole + F.expr(f"extract(SECOND FROM `{column}`)")).cast("decimal(20,6)")


def number(column: Column, dtype: str, lenient: bool = False) -> Column:
    """Text to number: a malformed value raises, or gives NULL when lenient."""
    return column.try_cast(dtype) if lenient else column.cast(dtype)


def empty_column(dtype: str) -> Column:
    """A NULL column that carries a type, so that any sink can store it."""
    return F.lit(None).cast(dtype)
