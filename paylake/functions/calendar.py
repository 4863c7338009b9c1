"""Calendar expressions.

Day-of-week numbers follow the 0 = Sunday convention; week numbers are ISO
weeks; long month and day names are blank-padded to 9 characters, as the
modelled warehouse's ``to_char`` pads them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAME_WIDTH = 9


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(d) -> Column:
    """Integer ``YYYYMMDD``."""
    return F.date_format(_col(d), "yyyyMMdd").cast("int")


def day_of_week_num(d) -> Column:
    """0 = Sunday … 6 = Saturday."""
    return (F.dayofweek(_col(d)) - F.lit(1)).cast("int")


def is_weekend_day(d) -> Column:
    """Saturday or Sunday."""
    return F.dayofweek(_col(d)).isin(1, 7)


def month_name(d) -> Column:
    return F.rpad(F.date_format(_col(d), "MMMM"), NAME_WIDTH, " ")


def month_short(d) -> Column:
    return F.date_format(_col(d), "MMM")


def day_name(d) -> Column:
    return F.rpad(F.date_format(_col(d), "EEEE"), NAME_WIDTH, " ")


def day_short(d) -> Column:
    return F.date_format(_col(d), "EEE")


def is_month_start(d) -> Column:
    return F.dayofmonth(_col(d)) == F.lit(1)


def is_month_end(d) -> Column:
    return _col(d) == F.last_day(_col(d))


def local_time(ts, zone: str = "Asia/Kolkata") -> Column:
    """Wall-clock time in ``zone`` of a UTC timestamp (display zone of panels)."""
    return F.from_utc_timestamp(_col(ts), zone)


def is_source_festival(d) -> Column:
    """The source rows' festival flag: the day is on the 41-day source list.
    A constant IN-list (no join), evaluated inside whole-stage codegen."""
    import datetime as dt

    from paylake.sources import fixed
    days = [dt.date.fromisoformat(x) for x, _ in fixed.SOURCE_FESTIVALS]
    return _col(d).isin(*days)
