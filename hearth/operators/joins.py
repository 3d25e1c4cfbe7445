"""Joins of the dimensional model (JN1-JN7).

No join hint is given by default: dimensions and lookup tables are results
of aggregations or small scans, so AQE measures their real size at run time
and turns the sort-merge join into a broadcast join when it is below
``spark.sql.autoBroadcastJoinThreshold`` — a size-checked broadcast with the
shuffle join as the fallback.  Callers may pass ``bounded=True`` for code
tables whose size is fixed by construction (calendar, unknown members).
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _maybe_broadcast(df: DataFrame, bounded: bool) -> DataFrame:
    return F.broadcast(df) if bounded else df


def denormalise(fact: DataFrame, lookups: Iterable[tuple[DataFrame, str]],
                bounded: bool = False) -> DataFrame:
    """JN1: chain of left equi-joins ``USING (key)``; fact rows are kept."""
    return reduce(lambda acc, lk: acc.join(_maybe_broadcast(lk[0], bounded), lk[1], "left"),
                  lookups, fact)


def lookup_keys(fact: DataFrame,
                dims: Sequence[tuple[DataFrame, str, str, Sequence[str]]],
                bounded: Sequence[bool] | None = None) -> DataFrame:
    """JN2 / JN3 / JN6: left join a fact to dimensions on business values.

    ``dims`` items are ``(dim, fact_col, dim_col, take_cols)``: the fact's
    ``fact_col`` is matched to ``dim_col`` and ``take_cols`` of the
    dimension are added.  Unmatched fact rows keep NULL keys.
    """
    out = fact
    for i, (dim, fact_col, dim_col, take) in enumerate(dims):
        b = bool(bounded[i]) if bounded else False
        alias = f"_d{i}"
        d = dim.select(F.col(dim_col).alias(f"{alias}_k"), *[F.col(t) for t in take])
        d = _maybe_broadcast(d, b)
        out = out.join(d, out[fact_col] == d[f"{alias}_k"], "left").drop(f"{alias}_k")
    return out


def missing_keys(fact: DataFrame, dim: DataFrame, fact_key: str,
                 dim_key: str | None = None) -> DataFrame:
    """JN4: distinct fact keys with no dimension row (NULL keys count as
    missing: an equi-join never matches NULL)."""
    dim_key = dim_key or fact_key
    keys = fact.select(F.col(fact_key).alias("_k")).distinct()
    d = dim.select(F.col(dim_key).alias("_k"))
    return keys.join(d, keys["_k"].eqNullSafe(d["_k"]) & d["_k"].isNotNull(), "left_anti") \
        .select(F.col("_k").alias(fact_key))


def missing_members(fact: DataFrame, dim: DataFrame, fact_key: str,
                    dim_key: str | None, cols: Sequence[str]) -> DataFrame:
    """JN5: the distinct fact rows (``cols``) whose key has no dimension row."""
    dim_key = dim_key or fact_key
    d = dim.select(F.col(dim_key).alias("_dk")).filter(F.col("_dk").isNotNull())
    rows = fact.select(*cols).distinct()
    return rows.join(d, rows[fact_key] == d["_dk"], "left_anti")


def star_join(fact: DataFrame,
              relationships: Sequence[tuple[DataFrame, str, str]],
              bounded: Sequence[bool] | None = None) -> DataFrame:
    """JN6: many-to-one relationships fact → dimension, fact rows kept
    (unmatched rows fall into the blank member).  ``relationships`` items
    are ``(dim, fact_key, dim_key)``; all non-key dimension columns join."""
    out = fact
    for i, (dim, fk, dk) in enumerate(relationships):
        b = bool(bounded[i]) if bounded else False
        take = [c for c in dim.columns if c != dk and c not in out.columns]
        d = dim.select(F.col(dk).alias(f"_r{i}"), *take)
        d = _maybe_broadcast(d, b)
        out = out.join(d, out[fk] == d[f"_r{i}"], "left").drop(f"_r{i}")
    return out
