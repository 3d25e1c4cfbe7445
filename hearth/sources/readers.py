"""Readers (SC1-SC9).  Schemas are always explicit (no inference pass)."""

from __future__ import annotations

import datetime as dt
from typing import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALES_CSV_SCHEMA = T.StructType([
    T.StructField(n, T.StringType()) for n in (
        "Date of Sale (dd/mm/yyyy)", "Address", "County", "Eircode", "Price (€)",
        "Not Full Market Price", "VAT Exclusive", "Description of Property",
        "Property Size Description")
])
PLANNING_TABLES = ("PlanningApplication", "PlanningAuthority", "ApplicationType",
                   "ApplicationStatus", "DecisionType", "LandUseType")


def bronze_path(base: str, source: str, load_date: str | dt.date | None = None) -> str:
    """SC6: ``<base>/<source>/load_date=YYYY-MM-DD`` (default: today, UTC)."""
    d = load_date or dt.datetime.now(dt.timezone.utc).date()
    return f"{base.rstrip('/')}/{source}/load_date={d}"


def read_csv_snapshot(spark: SparkSession, path: str,
                      schema: T.StructType = SALES_CSV_SCHEMA,
                      encoding: str = "ISO-8859-1", header: bool = True) -> DataFrame:
    """SC1: headed CSV read *by position* into a declared text schema.

    ISO-8859-1 decodes every byte, so a file written in a Windows code page
    keeps its accents and the stray currency byte is removed by the price
    cleaner later."""
    return (spark.read.schema(schema).option("header", header)
            .option("encoding", encoding).option("enforceSchema", True).csv(path))


def read_json_documents(spark: SparkSession, path: str) -> DataFrame:
    """SC2: one whole file → one text row (column ``value``), on executors."""
    return spark.read.option("wholetext", True).text(path)


def read_parquet_extract(spark: SparkSession, base: str, table: str,
                         load_date: str | None = None) -> DataFrame:
    """SC3: one extract table.  With ``load_date`` exactly that dated folder is
    read; a date that isn't there, and a date asked of a table without dated
    folders, is an error.  Without it every dated folder is read."""
    root = f"{base.rstrip('/')}/{table}"
    if load_date is None:
        return spark.read.option("basePath", root).parquet(root)
    return spark.read.parquet(bronze_path(base, table, load_date))


def read_extracts(spark: SparkSession, base: str, load_date: str | None = None,
                  tables: Iterable[str] = PLANNING_TABLES) -> dict[str, DataFrame]:
    return {t: read_parquet_extract(spark, base, t, load_date) for t in tables}


def read_extract_window(spark: SparkSession, base: str, table: str, control: DataFrame,
                        dataset: str, date_col: str = "load_date") -> DataFrame:
    """SC3 + MG3: the dated folders in ``(LastLoadDate, CurrentLoadDate]`` of the control
    table's row for ``dataset``.  Nothing of the control table comes to the driver:
    its days are joined to the folders' date, so that the scan prunes folders while
    it runs (dynamic partition pruning).  The days of one window are broadcast, at
    most one row per calendar day.  No such row, or no new day: no rows."""
    day = F.explode(F.sequence(F.date_add("LastLoadDate", 1), F.col("CurrentLoadDate")))
    days = (control.where((F.col("DatasetName") == dataset)
                          & (F.col("LastLoadDate") < F.col("CurrentLoadDate")))
            .select(day.alias(date_col)))
    return read_parquet_extract(spark, base, table).join(F.broadcast(days), date_col)


def read_layer(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """SC4: read a layer table by path."""
    return spark.read.format(fmt).load(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """SC5."""
    return spark.table(name)


def inline_rows(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """SC7: a literal frame (code tables, control rows) as an expression, so
    that the planner knows its size and may broadcast it.  Empty: no rows."""
    empty = spark.createDataFrame([], ddl)
    if not rows:
        return empty
    literal = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name)
                          for v, f in zip(row, empty.schema.fields)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*literal)))
