"""Loads that keep what they reject (SK5, SK6, DQ5, SC1).

A row that breaks a rule is neither lost nor an end to the load: one job writes
the good rows and the rejected ones, each with the rules it breaks, as two parts
of one folder, and ``observe`` counts both while they are written.  Nothing is
counted before the write or read again after it.
"""

from __future__ import annotations

from typing import Mapping, NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.session import fresh_subdir

REASONS = "Reasons"


class CheckedLoad(NamedTuple):
    loaded: DataFrame
    rejected: DataFrame      # with ``Reasons``
    counts: dict[str, int]   # "rows", "rejected" and rows per rule


def write_checked(df: DataFrame, path: str, rules: Mapping[str, Column]) -> CheckedLoad:
    """Write ``df`` under ``path`` in one job.  ``rules`` are conditions that a row
    must not meet; one that is NULL is not met."""
    broken = {name: F.coalesce(cond, F.lit(False)) for name, cond in rules.items()}
    reasons = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in broken.items()])
                              if broken else F.array().cast("array<string>"))
    marked = df.withColumn(REASONS, reasons)
    bad = F.size(REASONS) > 0
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("rejected"),
              *[F.count_if(F.array_contains(REASONS, n)).alias(n) for n in broken]]
    (marked.observe(seen, *counts).withColumn("part", F.when(bad, "rejected").otherwise("loaded"))
     .write.mode("errorifexists").partitionBy("part").parquet(path))
    stored = df.sparkSession.read.schema(
        T.StructType([*marked.schema.fields, T.StructField("part", T.StringType())])).parquet(path)
    return CheckedLoad(stored.where("part = 'loaded'").drop("part", REASONS),
                       stored.where("part = 'rejected'").drop("part"), dict(seen.get))


def declared_rules(columns) -> dict[str, Column]:
    """Rules of a declared table (``sinks``): (column, type, greatest length, not null)."""
    rules = {}
    for name, kind, length, not_null in columns:
        c = F.col(name)
        rules[f"{name} is no {kind}"] = c.isNotNull() & c.try_cast(kind).isNull()
        if not_null:
            rules[f"{name} is NULL"] = c.isNull()
        if length is not None:
            rules[f"{name} is longer than {length}"] = F.length(c.cast("string")) > length
    return rules


def load_checked(df: DataFrame, columns, path: str, **more: Column) -> CheckedLoad:
    """SK5 with the rejects kept: rows as they came, checked against the declared
    columns and ``more`` rules; the loaded part has the declared types."""
    done = write_checked(df, path, declared_rules(columns) | more)
    return done._replace(loaded=done.loaded.select(
        *[F.col(name).cast(kind).alias(name) for name, kind, _, _ in columns]))


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType | str, into: str | None = None,
                     encoding: str = "ISO-8859-1", sep: str = ",") -> CheckedLoad:
    """SC1 over files with damaged lines: a file whose header names other columns
    fails the job; a line with too few or too many fields, an open quote, or a
    value that isn't of its column's type is kept apart with its ``Line`` and the
    name of its ``File``.  Both parts are written under ``into``, and counted."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = [f.name for f in schema.fields]
    lines = (spark.read.schema(T.StructType([*schema.fields, T.StructField("Line", T.StringType())]))
             .option("header", True).option("enforceSchema", False).option("encoding", encoding)
             .option("sep", sep).option("escape", '"').option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", "Line").csv(path))
    # after a closing quote the parser keeps what follows as part of the raw value
    open_quote = F.lit(False)
    for f in schema.fields:
        if isinstance(f.dataType, T.StringType):
            open_quote = open_quote | F.col(f"`{f.name}`").startswith('"')
    done = write_checked(
        lines.withColumn("File", F.col("_metadata.file_name")),
        into or fresh_subdir(spark, "checked-csv") + "/data",
        {"fields don't fit": F.col("Line").isNotNull(),
         "a quote isn't closed": F.coalesce(open_quote, F.lit(False)) & F.col("Line").isNull()})
    return done._replace(loaded=done.loaded.select(*[f"`{n}`" for n in names]))
