"""Totals of stored layers from their Parquet footers (AG13, SE2).

Row counts, and least and greatest values of integer, floating and date columns,
stand in every file's footer.  Spark's DataSource V2 reader answers such
aggregates from there: no column of the layer is read.  The two settings that
this needs are made in a session of its own, never in the caller's.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: integer microseconds beside a zone-free timestamp, whose footer values aren't used
MICROS = "LoadMicros"


def with_load_micros(df: DataFrame, ts_col: str = "LoadTimestamp") -> DataFrame:
    """``df`` with ``ts_col`` as microseconds since 1970 as well, for the footers."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return df.withColumn(MICROS, F.timestamp_diff("MICROSECOND", epoch, F.col(ts_col)))


def footer_aggregate(spark: SparkSession, path: str, minmax: str | None = None) -> DataFrame:
    """One row: ``RowCount``, and ``Least`` and ``Greatest`` of ``minmax``, in a session
    whose Parquet reader answers from footers."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    aggs = [F.count(F.lit(1)).alias("RowCount")]
    if minmax:
        aggs += [F.min(minmax).alias("Least"), F.max(minmax).alias("Greatest")]
    return own.read.parquet(path).agg(*aggs)


def footer_totals(spark: SparkSession, layers: Mapping[str, str]) -> DataFrame:
    """Per layer (name → path, stored ``with_load_micros``): row count, first and last
    load time.  One row per layer passes the driver."""
    rows = []
    for name, path in layers.items():
        got = footer_aggregate(spark, path, MICROS).first()
        rows.append((name, got["RowCount"], got["Least"], got["Greatest"]))
    totals = spark.createDataFrame(rows, "TableName string, RowCount bigint, _least bigint, _most bigint")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return totals.select("TableName", "RowCount", *[
        F.timestamp_add("MICROSECOND", F.col(c), epoch).alias(n)
        for c, n in (("_least", "MinLoadTimestamp"), ("_most", "MaxLoadTimestamp"))])
