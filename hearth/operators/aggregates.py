"""Aggregations (AG1-AG13).

All are single ``groupBy().agg()`` passes: Spark runs a partial (map-side)
aggregate before the shuffle, so even a group key holding a third of all
rows sends one partial row per map task.  Quality-style counts are folded
into one aggregate with many ``count_if`` instead of one job per count.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.functions.dates import seconds_between


def price_metrics(df: DataFrame, by: Sequence = (), price: str = "SalePrice",
                  count_name: str = "SalesCount", round_avg: int | None = None
                  ) -> DataFrame:
    """AG1: count, average, minimum and maximum price per group."""
    avg = F.avg(price)
    if round_avg is not None:
        avg = F.round(avg, round_avg)
    aggs = [F.count(F.lit(1)).alias(count_name),
            avg.alias("AverageSalePrice"),
            F.min(price).alias("MinimumSalePrice"),
            F.max(price).alias("MaximumSalePrice")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def count_by(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """AG2: value distribution (present it with ``orderBy(desc(name))``)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name))


def distinct_count(df: DataFrame, col: str, count_null: bool = True) -> DataFrame:
    """AG3: number of distinct values; ``count_null`` counts NULL as a value
    (like ``select(c).distinct().count()``)."""
    n = F.count_distinct(col)
    if count_null:
        n = n + F.max(F.col(col).isNull().cast("int"))
    return df.agg(F.coalesce(n, F.lit(0)).cast("bigint").alias("DistinctCount"))


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """AG5: full-row (or subset) dedup; hash aggregate with map-side combine."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def first_per_key(df: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """AG6: one row per key; the smallest attribute tuple (deterministic).
    The distinct tuples come first (a hash aggregate), so that the minimum,
    which sorts, sees few rows."""
    return (df.select(key, *attrs).filter(F.col(key).isNotNull()).distinct()
            .groupBy(key)
            .agg(F.min(F.struct(*attrs)).alias("_m"))
            .select(key, *[F.col(f"_m.{a}").alias(a) for a in attrs]))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AG12 / DQ6: key values occurring more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("DuplicateCount"))
            .filter(F.col("DuplicateCount") > 1))


def table_totals(tables: Mapping[str, DataFrame], ts_col: str | None = None) -> DataFrame:
    """AG13 / SE2: per table row count (+ min/max load timestamp), UNION ALL."""
    parts = []
    for name, t in tables.items():
        aggs = [F.count(F.lit(1)).cast("bigint").alias("RowCount")]
        if ts_col:
            ts = F.col(ts_col) if ts_col in t.columns else F.lit(None).cast("timestamp")
            aggs += [F.min(ts).alias("MinLoadTimestamp"), F.max(ts).alias("MaxLoadTimestamp")]
        parts.append(t.agg(*aggs).select(F.lit(name).alias("TableName"), "*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def market_metrics(fact: DataFrame, by: Sequence[str] = ("DateKey", "CountyKey"),
                   price: str = "SalePrice") -> DataFrame:
    """AG11: the fact_market_metrics grain — money columns as decimal(18,2)."""
    m = price_metrics(fact, by, price=price)
    return m.select(
        *by,
        F.xxhash64(*[F.col(b) for b in by]).alias("MarketMetricKey"),
        F.col("SalesCount").cast("bigint").alias("SalesCount"),
        F.col("AverageSalePrice").cast("decimal(18,2)").alias("AverageSalePrice"),
        F.col("MinimumSalePrice").cast("decimal(18,2)").alias("MinimumSalePrice"),
        F.col("MaximumSalePrice").cast("decimal(18,2)").alias("MaximumSalePrice"))


def run_summary(run_log: DataFrame) -> DataFrame:
    """AG10: one row per parent run with duration and overall status."""
    failed = F.count_if(F.col("RunStatus") == "Failed")
    running = F.count_if(F.col("RunStatus") == "Running")
    s = run_log.groupBy("ParentRunID").agg(
        F.min("StartTime").alias("RunStartTime"),
        F.max("EndTime").alias("RunEndTime"),
        F.count(F.lit(1)).alias("ChildPipelineCount"),
        F.count_if(F.col("RunStatus") == "Succeeded").alias("SuccessfulChildCount"),
        failed.alias("FailedChildCount"),
        running.alias("_running"),
        F.max("LoadDate").alias("LoadDate"))
    secs = seconds_between("RunStartTime", "RunEndTime")
    return s.select(
        "ParentRunID", "RunStartTime", "RunEndTime",
        secs.alias("TotalDurationSeconds"),
        (secs / F.lit(60.0)).cast("decimal(10,2)").alias("TotalDurationMinutes"),
        "ChildPipelineCount", "SuccessfulChildCount", "FailedChildCount",
        F.when(F.col("FailedChildCount") > 0, "Failed")
        .when(F.col("_running") > 0, "Running")
        .otherwise("Succeeded").alias("OverallRunStatus"),
        "LoadDate")
