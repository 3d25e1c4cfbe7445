"""Property sales: bronze → silver → gold → star schema (DM1-DM4, DM9,
DM12, DM15, AG1, AG11)."""

from __future__ import annotations

from functools import cached_property
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearth.functions import cleaning as fc
from hearth.operators.aggregates import drop_duplicates, market_metrics, price_metrics
from hearth.operators.dims import dim_date, dim_from_values
from hearth.operators.joins import lookup_keys
from hearth.operators.keys import hash_key

SOURCE_SYSTEM = "PPR"
GOLD_COLUMNS = ("SaleDate", "County", "PropertyType", "PropertySizeCategory", "SaleType",
                "SalePrice", "IsFullMarketPrice", "Eircode", "Address", "LoadTimestamp",
                "SourceSystem")
NATURAL_KEY = ("SaleDate", "Address", "County", "Eircode", "SalePrice", "IsFullMarketPrice",
               "PropertyType", "PropertySizeCategory", "SaleType")


def silver_sales(raw: DataFrame, load_ts=None, normalise_first: bool = False) -> DataFrame:
    """DM15: clean price and date, canonical names, inverted market flag,
    full-row dedup, audit columns, English property types.

    ``normalise_first`` switches the S4 order (types normalised before the
    dedup, so one sale described in both languages collapses to one row).
    """
    df = raw.select(
        fc.parse_date(F.col("`Date of Sale (dd/mm/yyyy)`")).alias("SaleDate"),
        F.col("Address"), F.col("County"), F.col("Eircode"),
        fc.clean_price(F.col("`Price (€)`")).alias("SalePrice"),
        fc.invert_flag(F.col("`Not Full Market Price`")).alias("IsFullMarketPrice"),
        F.col("`VAT Exclusive`").alias("IsVATExclusive"),
        F.col("`Description of Property`").alias("PropertyType"),
        F.col("`Property Size Description`").alias("PropertySizeCategory"))
    if normalise_first:
        df = df.withColumn("PropertyType", fc.normalise_property_type("PropertyType"))
    df = drop_duplicates(df)
    if not normalise_first:
        df = df.withColumn("PropertyType", fc.normalise_property_type("PropertyType"))
    return fc.add_audit_columns(df, SOURCE_SYSTEM, load_ts)


def gold_sales(silver: DataFrame) -> DataFrame:
    """DM12: canonical analytical projection + sale type."""
    return silver.withColumn("SaleType", fc.sale_type("IsVATExclusive")).select(*GOLD_COLUMNS)


def dim_county(gold: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """DM1: CountyKey, CountyName; key 0 = unknown member.  With the stored
    dimension as ``existing`` its keys stay and new members follow (S6)."""
    return dim_from_values(gold, "County", "CountyKey", name="CountyName", existing=existing)


def dim_property_type(gold: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return dim_from_values(gold, "PropertyType", "PropertyTypeKey", existing=existing)


def dim_sale_type(gold: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return dim_from_values(gold, "SaleType", "SaleTypeKey", existing=existing)


# dimension of the star: (column of gold, column of the dimension, key)
FACT_KEYS = {
    "dim_date": ("SaleDate", "FullDate", "DateKey"),
    "dim_county": ("County", "CountyName", "CountyKey"),
    "dim_property_type": ("PropertyType", "PropertyType", "PropertyTypeKey"),
    "dim_sale_type": ("SaleType", "SaleType", "SaleTypeKey"),
}
FACT_VALUES = ("Address", "Eircode", "SalePrice", "IsFullMarketPrice", "LoadTimestamp")


def keyed_sales(gold: DataFrame, dims: dict[str, DataFrame], values: Sequence[str]) -> DataFrame:
    """DM9, the part that a report needs: the keys of the given dimensions
    (unmatched → member 0, S5) and the given values of every gold row."""
    j = lookup_keys(gold, [(d, FACT_KEYS[n][0], FACT_KEYS[n][1], [FACT_KEYS[n][2]])
                           for n, d in dims.items()],
                    bounded=[n == "dim_date" for n in dims])    # the calendar's range is fixed
    return j.select(*[F.coalesce(FACT_KEYS[n][2], F.lit(0)).alias(FACT_KEYS[n][2]) for n in dims],
                    *values)


def with_row_key(gold: DataFrame) -> DataFrame:
    """S7: PropertySaleKey, a hash of the natural columns, and an ordinal among
    the rows of one hash (equal sales, or unlike ones whose hashes meet), so
    that the two together name one row.  Silver rows differ, so a hash has as
    many rows as there are spellings of one sale."""
    by_hash = Window.partitionBy("PropertySaleKey").orderBy(*NATURAL_KEY)
    return (gold.withColumn("PropertySaleKey", hash_key(*NATURAL_KEY))
            .withColumn("PropertySaleOrdinal", F.row_number().over(by_hash)))


def fact_property_sales(gold: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """DM9: the whole fact: row key and ordinal, four dimension keys, values."""
    keyed = lookup_keys(with_row_key(gold), [
        (dims[n], src, name, [key]) for n, (src, name, key) in FACT_KEYS.items()],
        bounded=[n == "dim_date" for n in FACT_KEYS])
    return keyed.select("PropertySaleKey", "PropertySaleOrdinal",
                        *[F.coalesce(key, F.lit(0)).alias(key) for _, _, key in FACT_KEYS.values()],
                        *FACT_VALUES)


class SalesModel:
    """The whole sales star built lazily from one bronze frame."""

    def __init__(self, spark: SparkSession, raw: DataFrame, load_ts=None):
        self.spark = spark
        self.silver = silver_sales(raw, load_ts)
        self.gold = gold_sales(self.silver)
        self.dim_date = dim_date(spark)

    @cached_property
    def stored_silver(self) -> DataFrame:
        """The silver layer written once (Parquet under the shared folder) —
        the star is built from it, so the cleaning joins and the full-row
        dedup run once instead of once per dimension + fact."""
        from hearth.session import materialize
        return materialize(self.silver, "silver_sales")

    @property
    def stored_gold(self) -> DataFrame:
        """Gold is a projection of silver, so it needs no file of its own."""
        return gold_sales(self.stored_silver)

    @property
    def _dim_source(self) -> DataFrame:
        """Stored gold once it exists (fact builds); otherwise the lazy gold,
        where Catalyst prunes a dimension's distinct values down to the few
        source columns it needs (the full-row dedup is dropped)."""
        return self.stored_gold if "stored_silver" in self.__dict__ else self.gold

    # dimensions are built on first use only (a report needing one dimension
    # does not pay for the others)
    @cached_property
    def dim_county(self) -> DataFrame:
        return dim_county(self._dim_source)

    @cached_property
    def dim_property_type(self) -> DataFrame:
        return dim_property_type(self._dim_source)

    @cached_property
    def dim_sale_type(self) -> DataFrame:
        return dim_sale_type(self._dim_source)

    @cached_property
    def fact(self) -> DataFrame:
        gold = self.stored_gold
        return fact_property_sales(gold, {n: getattr(self, n) for n in FACT_KEYS})

    def star(self, dims: Sequence[str], values: Sequence[str] = ("SalePrice",)
             ) -> tuple[DataFrame, dict[str, DataFrame]]:
        """The star of one report: these values, these dimensions and their keys.
        A dimension made from the sales themselves reads gold a second time, so
        then the report's columns are written once and both read that."""
        from hearth.session import materialize
        source = self.gold.select(*[FACT_KEYS[n][0] for n in dims], *values)
        if set(dims) - {"dim_date"}:
            source = materialize(source, "star_sales")
        made = {"dim_county": dim_county, "dim_property_type": dim_property_type,
                "dim_sale_type": dim_sale_type}
        built = {n: made[n](source) if n in made else self.dim_date for n in dims}
        return keyed_sales(source, built, values), built

    # gold metric tables (AG1)
    def metrics_county(self) -> DataFrame:
        return price_metrics(self.gold, ["County"], round_avg=2)

    def metrics_year(self) -> DataFrame:
        return price_metrics(self.gold.withColumn("SaleYear", F.year("SaleDate")), ["SaleYear"])

    def metrics_county_year(self) -> DataFrame:
        return price_metrics(self.gold.withColumn("SaleYear", F.year("SaleDate")),
                             ["County", "SaleYear"])

    def metrics_type(self) -> DataFrame:
        return price_metrics(self.gold, ["PropertyType"])

    def market_summary(self) -> DataFrame:
        return price_metrics(self.gold, [], count_name="TotalSales")

    def fact_market_metrics(self) -> DataFrame:
        return market_metrics(self.star(["dim_date", "dim_county"])[0])
