"""Date keys, boundary differences and the open-end sentinel."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from bodega.functions.base import as_col

# Open end of a validity interval, and the watermark of a table never loaded.
OPEN_END = "9999-12-31 23:59:59.999999"
NEVER_LOADED = "1900-01-01 00:00:00"


def moment(value: datetime | date | str) -> Column:
    """A timestamp literal that does not depend on the session time zone."""
    return F.lit(str(value)).cast("timestamp_ntz")


def open_end() -> Column:
    return moment(OPEN_END)


def date_key(c: Column | str) -> Column:
    """YYYYMMDD as an integer, 0 for NULL."""
    d = as_col(c)
    return F.coalesce(F.year(d) * 10000 + F.month(d) * 100 + F.day(d), F.lit(0))


def age_in_years(born: Column | str, as_of: Column | str) -> Column:
    """Number of calendar-year borders crossed, not completed years."""
    return F.year(as_col(as_of)) - F.year(as_col(born))


def borders_crossed(unit: str, start: Column | str, end: Column | str) -> Column:
    """How many borders of `unit` (SECOND, MINUTE, HOUR, DAY, MONTH, YEAR) lie between two moments."""
    return F.timestamp_diff(unit, F.date_trunc(unit, as_col(start)), F.date_trunc(unit, as_col(end)))


def is_month_end(c: Column | str) -> Column:
    d = as_col(c).cast("date")
    return d == F.last_day(d)


def period(c: Column | str) -> Column:
    """Reporting period YYYY-MM."""
    return F.date_format(as_col(c), "yyyy-MM")
