"""Date helpers: date keys, quarter attributes, calendar columns (DM4, DM6)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(c) -> Column:
    """yyyyMMdd as int (20240131)."""
    d = _c(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def year_month(c) -> Column:
    return F.date_format(_c(c), "yyyy-MM")


def month_name(c) -> Column:
    return F.date_format(_c(c), "MMMM")


def quarter_year(label) -> Column:
    """Leading four digits of a quarter label such as ``2024Q3``."""
    return F.nullif(F.regexp_extract(_c(label), r"^(\d{4})", 1), F.lit("")).try_cast("int")


def quarter_number(label) -> Column:
    return F.nullif(F.regexp_extract(_c(label), r"Q([1-4])$", 1), F.lit("")).try_cast("int")


def quarter_start(label) -> Column:
    """First day of the quarter; NULL when the label does not parse."""
    y = quarter_year(label)
    q = quarter_number(label)
    return F.try_make_date(y, (q - 1) * 3 + 1, F.lit(1)) if hasattr(F, "try_make_date") \
        else F.when(y.isNotNull() & q.isNotNull(), F.make_date(y, (q - 1) * 3 + 1, F.lit(1)))


def wall_seconds(ts) -> Column:
    """Seconds since 1970-01-01 00:00:00 of a zone-free timestamp's wall
    clock, truncated to whole seconds.  Built from the date and time parts,
    so it does not depend on the session time zone (no DST shifts)."""
    t = _c(ts)
    return (F.unix_date(F.to_date(t)).cast("bigint") * 86400 + F.hour(t) * 3600
            + F.minute(t) * 60 + F.second(t))


def seconds_between(start, end) -> Column:
    """Whole-second boundary count, like SQL ``DATEDIFF(SECOND, a, b)``
    (00.9 → 01.1 counts one boundary)."""
    return wall_seconds(end) - wall_seconds(start)
