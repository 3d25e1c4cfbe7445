"""Writers and warehouse loads (SK1-SK6, SC9) and round-trip helpers."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.operators.merge import SnapshotStore
from hearth.session import fresh_subdir
from hearth.sources import readers

# Declared warehouse tables: (column, type, max length or None, not null)
FACT_PROPERTY_SALES = (
    ("PropertySaleKey", "bigint", None, True),
    ("DateKey", "int", None, True),
    ("CountyKey", "int", None, True),
    ("PropertyTypeKey", "int", None, True),
    ("SaleTypeKey", "int", None, True),
    ("Address", "string", 500, False),
    ("Eircode", "string", 10, False),
    ("SalePrice", "decimal(18,2)", None, True),
    ("IsFullMarketPrice", "string", 3, False),
    ("LoadTimestamp", "timestamp_ntz", None, False),
)

DIM_COUNTY = (("CountyKey", "int", None, True), ("CountyName", "string", 100, True))
DIM_PROPERTY_TYPE = (("PropertyTypeKey", "int", None, True), ("PropertyType", "string", 100, True))
DIM_SALE_TYPE = (("SaleTypeKey", "int", None, True), ("SaleType", "string", 100, True))
DIM_DATE = (
    ("DateKey", "int", None, True),
    ("FullDate", "date", None, True),
    ("Year", "int", None, True),
    ("Quarter", "int", None, True),
    ("Month", "int", None, True),
    ("MonthName", "string", 20, True),
)
DIM_QUARTER = (
    ("QuarterKey", "int", None, True),
    ("Quarter", "string", 10, True),
    ("QuarterStartDate", "date", None, True),
    ("Year", "int", None, True),
    ("QuarterNumber", "int", None, True),
)
FACT_HOUSING_VACANCY = (
    ("HousingVacancyKey", "bigint", None, True),
    ("QuarterKey", "int", None, True),
    ("CountyKey", "int", None, True),
    ("VacantDwellings", "bigint", None, False),
    ("DwellingStock", "bigint", None, False),
    ("VacancyRate", "decimal(5,1)", None, False),
    ("SourceUpdatedTimestamp", "timestamp_ntz", None, False),
    ("LoadDate", "date", None, False),
    ("LoadTimestamp", "timestamp_ntz", None, False),
)


def save_staging(df: DataFrame, name: str, location: str | None = None) -> None:
    """SK3: overwrite a catalog table; with ``location`` the table's files
    live at that (shared) path instead of the session's warehouse folder."""
    w = df.write.mode("overwrite")
    if location:
        w = w.option("path", location)
    w.saveAsTable(name)


def save_all(tables: Mapping[str, DataFrame], root: str | None = None) -> None:
    """SK4."""
    for name, df in tables.items():
        save_staging(df, name, f"{root.rstrip('/')}/{name}" if root else None)


def list_tables(spark: SparkSession, pattern: str = "*") -> DataFrame:
    """SC9: catalog listing as rows (name, database, type, temporary)."""
    rows = [(t.name, t.database, t.tableType, bool(t.isTemporary))
            for t in spark.catalog.listTables(pattern=pattern)]
    return spark.createDataFrame(rows, "TableName STRING, DatabaseName STRING, "
                                       "TableType STRING, IsTemporary BOOLEAN")


def load_warehouse_table(df: DataFrame, columns, strict: bool = True) -> DataFrame:
    """SK5: cast to the declared schema, check lengths and NOT NULLs.

    Every check is an expression on the row (``raise_error``), so the load
    fails inside the job that writes, with no extra pass."""
    out = []
    for name, typ, length, not_null in columns:
        c = F.col(name).cast(typ)
        problems = []
        if not_null:
            problems.append((c.isNull(), f"NULL in NOT NULL column {name}"))
        if length is not None:
            problems.append((F.length(c) > length, f"value longer than {length} in {name}"))
        if strict:
            for cond, msg in problems:
                c = F.when(cond, F.raise_error(F.lit(msg)).cast(typ)).otherwise(c)
        out.append(c.alias(name))
    return df.select(*out)


def replace_warehouse_table(store: SnapshotStore, df: DataFrame, table: str, columns) -> DataFrame:
    """SK5 as the loads run it: the checked rows replace the table's content
    (a new version, so readers keep the old rows until it is complete)."""
    store.overwrite(load_warehouse_table(df, columns), table)
    return store.read(table)


def roundtrip_layer(spark: SparkSession, df: DataFrame, table: str) -> DataFrame:
    """SK1 + SK6 + SC4: write a snapshot version and read it back."""
    store = SnapshotStore(spark, fresh_subdir(spark, "layers"))
    store.overwrite(df, table)
    return store.read(table)


def roundtrip_csv(spark: SparkSession, raw: DataFrame, encoding: str = "UTF-8") -> DataFrame:
    """SC1 round trip: write the bronze rows as a headed CSV and read them
    back by position with the declared schema and the same encoding."""
    path = fresh_subdir(spark, "bronze") + "/sales"
    (raw.write.option("header", True).option("encoding", encoding)
     .mode("errorifexists").csv(path))
    return readers.read_csv_snapshot(spark, path, encoding=encoding)
