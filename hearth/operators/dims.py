"""Dimension builders (SC8, DM1-DM8, SE1).

Dimensions are deduplicated *before* keys are assigned, so key assignment
only ever sees one row per member.  Keys come from ``sequential_keys``
(distributed, no one-partition window).
"""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.functions.cleaning import NOT_RECORDED
from hearth.functions.dates import date_key, month_name
from hearth.operators.aggregates import first_per_key
from hearth.operators.keys import sequential_keys, stable_keys, with_unknown_member

# Calendar range of the date dimension
CALENDAR_START = "2010-01-01"
CALENDAR_END = "2030-12-31"


def calendar(spark: SparkSession, start: str = CALENDAR_START,
             end: str = CALENDAR_END, num_partitions: int | None = None) -> DataFrame:
    """SC8: one row per day in [start, end].

    Generated from ``spark.range`` over the day offset, so the rows are
    spread over partitions instead of exploding one array in one task.
    """
    d0 = dt.date.fromisoformat(start)
    n = (dt.date.fromisoformat(end) - d0).days + 1
    r = spark.range(0, n, 1, num_partitions) if num_partitions else spark.range(0, n)
    return r.select(F.date_add(F.lit(d0), F.col("id").cast("int")).alias("FullDate"))


def dim_date(spark: SparkSession, start: str = CALENDAR_START,
             end: str = CALENDAR_END) -> DataFrame:
    """DM4: DateKey yyyyMMdd, full date, year, quarter, month, month name."""
    d = F.col("FullDate")
    return calendar(spark, start, end).select(
        date_key(d).alias("DateKey"), d,
        F.year(d).cast("int").alias("Year"),
        F.quarter(d).cast("int").alias("Quarter"),
        F.month(d).cast("int").alias("Month"),
        month_name(d).alias("MonthName"))


def dim_from_values(df: DataFrame, value_col: str, key: str,
                    name: str | None = None, unknown: str | None = NOT_RECORDED,
                    existing: DataFrame | None = None) -> DataFrame:
    """DM1-DM3: distinct non-NULL values numbered in value order, plus an
    optional key-0 unknown member (S5).  With ``existing``, the dimension as
    stored, its members keep their keys and new values are numbered after
    them (S6); its unknown member is left as it is."""
    name = name or value_col
    members = (df.select(F.col(value_col).alias(name))
               .filter(F.col(name).isNotNull()).distinct())
    if existing is not None:
        return stable_keys(existing, members, key, [name])
    # a member's key is an INT in the declared tables
    dim = sequential_keys(members, [name], key=key).select(F.col(key).cast("int").alias(key), name)
    if unknown is not None:
        dim = with_unknown_member(dim, {key: 0, name: unknown})
    return dim


def dims_from_values(df: DataFrame, specs: Sequence[tuple[str, str, str]],
                     unknown: str | None = NOT_RECORDED) -> list[DataFrame]:
    """Several DM1-style dimensions in one pass: ``specs`` are
    ``(value column, key column, name column)``; the value columns must
    share one type.  All distinct (dimension, value) pairs are numbered by
    one grouped ``sequential_keys`` run instead of one job per dimension."""
    pairs = F.array(*[F.struct(F.lit(i).alias("_dim"), F.col(v).alias("_val"))
                      for i, (v, _, _) in enumerate(specs)])
    values = (df.select(F.inline(pairs)).filter(F.col("_val").isNotNull()).distinct())
    numbered = sequential_keys(values, ["_val"], key="_key", partition_by=["_dim"])
    out = []
    for i, (_, key, name) in enumerate(specs):
        d = numbered.filter(F.col("_dim") == i).select(F.col("_key").alias(key),
                                                       F.col("_val").alias(name))
        out.append(with_unknown_member(d, {key: 0, name: unknown}) if unknown is not None else d)
    return out


def dim_from_source_ids(df: DataFrame, id_col: str, key: str,
                        attrs: Sequence[tuple[str, str]],
                        unknown: dict | None = None) -> DataFrame:
    """DM7 / DM8: source ids as keys, one row per id (AG6), optional unknown
    member.  ``attrs`` are ``(source column, dimension column)`` pairs."""
    renamed = df.select(F.col(id_col).cast("int").alias(key),
                        *[F.col(s).alias(t) for s, t in attrs])
    dim = first_per_key(renamed, key, [t for _, t in attrs])
    if unknown is not None:
        dim = with_unknown_member(dim, unknown)
    return dim


def dim_quarter(gold_vacancy: DataFrame) -> DataFrame:
    """DM5: QuarterKey = int(quarter code), label, start date, year, number."""
    return (gold_vacancy.select("QuarterCode", "Quarter", "QuarterStartDate",
                                "Year", "QuarterNumber").distinct()
            .select(F.col("QuarterCode").try_cast("int").alias("QuarterKey"),
                    "Quarter", "QuarterStartDate", "Year", "QuarterNumber"))
