"""Filter predicates (FL*).  Keep predicates on bare columns so they reach
the Parquet scan as pushed filters."""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Valid coordinate box (degrees, inclusive)
LAT_RANGE = (51.0, 56.0)
LON_RANGE = (-11.0, -5.0)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_null(c) -> Column:
    return _c(c).isNull()


def not_null(c) -> Column:
    return _c(c).isNotNull()


def all_of(*preds: Column) -> Column:
    return reduce(lambda a, b: a & b, preds)


def any_of(*preds: Column) -> Column:
    return reduce(lambda a, b: a | b, preds)


def invalid_coordinates(lat="Latitude", lon="Longitude",
                        lat_range=LAT_RANGE, lon_range=LON_RANGE) -> Column:
    """NULL or outside the inclusive box counts as invalid."""
    la, lo = _c(lat), _c(lon)
    return (la.isNull() | lo.isNull()
            | ~la.between(*lat_range) | ~lo.between(*lon_range))


def year_between(c, lo: int, hi: int) -> Column:
    return _c(c).between(lo, hi)


def member_of(c, values: Iterable) -> Column:
    return _c(c).isin(list(values))


def slicer_values(df: DataFrame, c: str, exclude_null: bool = True) -> DataFrame:
    """FL8 + FL9: the distinct values a slicer offers, ordered."""
    out = df.select(c)
    if exclude_null:
        out = out.filter(F.col(c).isNotNull())
    return out.distinct()
