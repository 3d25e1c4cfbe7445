"""Data-quality checks (DQ1-DQ11), each a single pass returning rows.

Where the source notebooks ran one ``count()`` job per check, these fold
all counts into one aggregate (``count_if`` per rule), so a profile of N
rules costs one scan.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.functions.predicates import invalid_coordinates as _invalid_coords


def _long(d: DataFrame, names: Sequence[str], name_col="Check", value_col="Value") -> DataFrame:
    """One wide row → (check, value) rows, via ``stack`` (no extra job)."""
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return d.selectExpr(f"stack({len(names)}, {pairs}) as ({name_col}, {value_col})")


def _total(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """DQ1: NULL count per column, one row per column."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return _long(wide, cols, "ColumnName", "NullCount")


def business_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """DQ2: number of rows breaking each rule (rule = a boolean Column that
    is true for a *bad* row), plus the row count, one row per rule."""
    aggs = [F.count(F.lit(1)).alias("RowCount")]
    aggs += [F.count_if(cond).alias(name) for name, cond in rules.items()]
    wide = df.agg(*aggs)
    return _long(wide, ["RowCount", *rules.keys()], "Rule", "Rows")


def lookup_quality(df: DataFrame, lookups: Sequence[tuple[str, str, str]]) -> DataFrame:
    """DQ3: per lookup, rows with a NULL source id, and rows whose non-NULL id
    found no lookup name (a broken reference)."""
    aggs = []
    for label, id_col, name_col in lookups:
        aggs += [F.count_if(F.col(id_col).isNull()).alias(f"{label}|null"),
                 F.count_if(F.col(id_col).isNotNull() & F.col(name_col).isNull())
                 .alias(f"{label}|broken")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{lab}', `{lab}|null`, `{lab}|broken`" for lab, _, _ in lookups)
    return wide.selectExpr(
        f"stack({len(lookups)}, {stack}) as (Lookup, NullSourceIds, UnmatchedIds)")


def unmatched_reference(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """DQ4: NULL names after the lookup joins (same shape as DQ1)."""
    return null_counts(df, names)


def rowcount_preserved(before: DataFrame, after: DataFrame) -> DataFrame:
    """DQ5: source rows, joined rows and their difference (0 = preserved)."""
    b = before.agg(F.count(F.lit(1)).alias("SourceRows"))
    a = after.agg(F.count(F.lit(1)).alias("JoinedRows"))
    u = (b.select(F.col("SourceRows").alias("n"), F.lit(0).alias("side"))
         .unionByName(a.select(F.col("JoinedRows").alias("n"), F.lit(1).alias("side"))))
    return u.agg(F.sum(F.when(F.col("side") == 0, F.col("n"))).alias("SourceRows"),
                 F.sum(F.when(F.col("side") == 1, F.col("n"))).alias("JoinedRows")) \
        .withColumn("Difference", F.col("JoinedRows") - F.col("SourceRows"))


def invalid_coordinates(df: DataFrame, lat="Latitude", lon="Longitude") -> DataFrame:
    """DQ7: rows with missing or out-of-box coordinates."""
    return df.agg(F.count(F.lit(1)).alias("RowCount"),
                  F.count_if(_invalid_coords(lat, lon)).alias("InvalidCoordinates"))


def missing_dimension_keys(fact: DataFrame,
                           dims: Sequence[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """DQ8: JN4 for many keys as one report: (Dimension, MissingKeys).

    One pass over the fact: every row yields its (dimension, key) pairs,
    the distinct pairs are anti-joined once against the union of all
    dimensions' keys, and the rest are counted per dimension.  A NULL fact
    key never matches, so it counts as missing (S8)."""
    spark = fact.sparkSession
    pairs = F.array(*[F.struct(F.lit(name).alias("Dimension"),
                               F.col(fk).cast("bigint").alias("_k"))
                      for name, _, fk, _ in dims])
    keys = fact.select(F.inline(pairs)).distinct()
    dim_keys = None
    for name, dim, _, dk in dims:
        d = dim.select(F.lit(name).alias("Dimension"), F.col(dk).cast("bigint").alias("_k"))
        dim_keys = d if dim_keys is None else dim_keys.unionByName(d)
    missing = (keys.join(dim_keys.filter(F.col("_k").isNotNull()).distinct(),
                         ["Dimension", "_k"], "left_anti")
               .groupBy("Dimension").agg(F.count(F.lit(1)).alias("_n")))
    names = spark.createDataFrame([(n,) for n, _, _, _ in dims], "Dimension string")
    return (names.join(missing, "Dimension", "left")
            .select("Dimension", F.coalesce(F.col("_n"), F.lit(0)).cast("bigint")
                    .alias("MissingKeys")))


def profile(df: DataFrame, keys: Sequence[str], mandatory: Sequence[str]) -> DataFrame:
    """DQ9: rows, duplicate keys and NULLs per mandatory column, as rows
    (Metric, Value).  One pass: counts per key, then their sums."""
    nulls = [f"Null {c}" for c in mandatory]
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(n) for n, c in zip(nulls, mandatory)])
    total = per_key.agg(_total("_n").alias("RowCount"), *[_total(n).alias(n) for n in nulls],
                        F.count_if(F.col("_n") > 1).alias("DuplicateKeys"))
    return _long(total, ["RowCount", *nulls, "DuplicateKeys"], "Metric", "Value")


def fact_checks(fact: DataFrame, key: str, county_key: str = "CountyKey") -> DataFrame:
    """DQ10: rows, rows without a county key, duplicated fact keys, in one pass."""
    per_key = fact.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col(county_key).isNull()).alias("_missing"))
    return per_key.agg(_total("_n").alias("RowCount"), _total("_missing").alias("MissingCountyKeys"),
                       F.count_if(F.col("_n") > 1).alias("DuplicateFactKeys"))


def schema_report(df: DataFrame) -> DataFrame:
    """DQ11: the schema as rows (position, name, type, nullable)."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "Position INT, ColumnName STRING, DataType STRING, Nullable BOOLEAN")
