"""Housing vacancy: cube documents → silver long table → gold county ×
quarter → dim_quarter + fact_housing_vacancy (JS1-JS5, AG7-AG9, DM5, DM6,
DM10, PR16)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.functions import cleaning as fc
from hearth.functions import dates as fd
from hearth.operators import cube as oc
from hearth.operators.dims import dim_quarter
from hearth.sources import standins as st

CUBE_UPDATED = "2024-06-30T00:00:00.000Z"
CUBE_LABEL = "Vacant dwellings by local authority and quarter"
CUBE_SOURCE = "Statistics office"
SILVER_KEYS = ["QuarterCode", "Quarter", "LocalAuthorityCode", "LocalAuthority",
               "SourceUpdatedTimestamp", "LoadDate"]


def to_utc_ntz(ts_ltz, spark: SparkSession):
    """Instant → zone-free UTC wall-clock (what a datetime2 column stores)."""
    tz = spark.conf.get("spark.sql.session.timeZone")
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), ts_ltz.cast("timestamp_ntz"))


def cube_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in bronze: one JSON-stat text per region; odd regions wrap the
    object in a one-element array (both shapes occur in the wild)."""
    long_df = st.cube_long(spark, sf_dir)
    docs = oc.cube_pack(long_df, ["RegionKey"], [
        (oc.DIM_STATISTIC, "StatisticCode", "Statistic"),
        (oc.DIM_QUARTER, "QuarterCode", "Quarter"),
        (oc.DIM_AUTHORITY, "LocalAuthorityCode", "LocalAuthority"),
    ], label=CUBE_LABEL, source=CUBE_SOURCE, updated=CUBE_UPDATED)
    text = F.to_json("doc")
    return docs.select("RegionKey", F.when(F.col("RegionKey") % 2 == 1,
                                           F.concat(F.lit("["), text, F.lit("]")))
                       .otherwise(text).alias("value"))


def parse_documents(texts: DataFrame, text_col: str = "value", keep=()) -> DataFrame:
    return texts.select(*keep, oc.cube_unwrap(text_col).alias("doc"))


def silver_vacancy(spark: SparkSession, texts: DataFrame, load_date: str,
                   load_ts=None, strict: bool = True) -> DataFrame:
    """JS1-JS4: typed long table with source / load / ingest stamps.

    ``strict`` fails the job on a size mismatch (like the source notebook);
    otherwise invalid documents are dropped here and can be listed with
    ``cube_validate``."""
    docs = parse_documents(texts)
    docs = (oc.require_valid(docs) if strict
            else oc.cube_validate(docs).filter("IsValid"))
    flat = oc.cube_flatten(docs.select("doc"), oc.VACANCY_DIMS)
    ingest = F.current_timestamp() if load_ts is None else F.lit(load_ts).cast("timestamp_ntz")
    return flat.select(
        F.col("0_code").alias("StatisticCode"), F.col("0_label").alias("Statistic"),
        F.col("1_code").alias("QuarterCode"), F.col("1_label").alias("Quarter"),
        F.col("2_code").alias("LocalAuthorityCode"), F.col("2_label").alias("LocalAuthority"),
        "Unit", F.col("Value").cast("double").alias("Value"),
        to_utc_ntz(fc.parse_iso_timestamp("updated"), spark).alias("SourceUpdatedTimestamp"),
        F.lit(load_date).cast("date").alias("LoadDate"),
        ingest.alias("IngestedTimestamp"))


def local_authority_measures(silver: DataFrame) -> DataFrame:
    """AG7 + PR2 + PR6: wide measures per authority × quarter."""
    wide = oc.pivot_measures(silver, SILVER_KEYS, "StatisticCode", oc.VACANCY_STATS)
    return wide.withColumns({
        "VacantDwellings": F.col("VacantDwellings").cast("bigint"),
        "DwellingStock": F.col("DwellingStock").cast("bigint")})


def gold_vacancy(silver: DataFrame, mapping: DataFrame | None = None,
                 load_ts=None) -> DataFrame:
    """County × quarter vacancy with the rate recomputed after the sum."""
    la = local_authority_measures(silver)
    mapped = (fc.map_county_frame(la, "LocalAuthority", mapping) if mapping is not None
              else la.withColumn("County", fc.local_authority_to_county("LocalAuthority")))
    g = oc.county_rollup(mapped)
    ts = F.current_timestamp() if load_ts is None else F.lit(load_ts).cast("timestamp_ntz")
    return g.select(
        "QuarterCode", "Quarter",
        fd.quarter_start("Quarter").alias("QuarterStartDate"),
        fd.quarter_year("Quarter").alias("Year"),
        fd.quarter_number("Quarter").alias("QuarterNumber"),
        "County", "VacantDwellings", "DwellingStock",
        oc.vacancy_rate("VacantDwellings", "DwellingStock").alias("VacancyRate"),
        "SourceUpdatedTimestamp", "LoadDate", ts.alias("GoldLoadTimestamp"))


def fact_housing_vacancy(gold: DataFrame, counties: DataFrame) -> DataFrame:
    """DM10: key = QuarterKey * 100 + CountyKey; rate as decimal(5,1)."""
    c = counties.select(F.col("CountyKey"), F.col("CountyName").alias("_cn"))
    j = gold.join(c, gold["County"] == c["_cn"], "left")
    qk = F.col("QuarterCode").try_cast("int")
    return j.select(
        (qk.cast("bigint") * 100 + F.col("CountyKey")).alias("HousingVacancyKey"),
        qk.alias("QuarterKey"), "CountyKey", "VacantDwellings", "DwellingStock",
        F.col("VacancyRate").cast("decimal(5,1)").alias("VacancyRate"),
        "SourceUpdatedTimestamp", "LoadDate",
        F.col("GoldLoadTimestamp").alias("LoadTimestamp"))


def standin_county_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authority → county for the stand-in: nations grouped by region, the
    county named after the region's first nation (so it exists in the
    sales county dimension, like the real counties do)."""
    n = st.table(spark, sf_dir, "nation")
    first = n.groupBy("n_regionkey").agg(F.min_by("n_name", "n_nationkey").alias("County"))
    return (n.join(first, "n_regionkey", "left")
            .select(F.col("n_name").alias("LocalAuthority"), "County"))


class VacancyModel:
    def __init__(self, spark: SparkSession, sf_dir: str, load_date: str = st.RUN_DATE,
                 load_ts=st.RUN_TS):
        self.spark = spark
        self.texts = cube_documents(spark, sf_dir)
        self.silver = silver_vacancy(spark, self.texts, load_date, load_ts)
        self.mapping = standin_county_map(spark, sf_dir)
        self.gold = gold_vacancy(self.silver, self.mapping, load_ts)

    @cached_property
    def stored_gold(self) -> DataFrame:
        """The gold layer written once (Parquet under the shared folder):
        the star's fact and quarter dimension both read it, so the cube
        decode and the county rollup run once, not once per branch (the two
        branches differ — the quarter slicer is pushed into one — so the
        exchange would not be reused)."""
        from hearth.session import materialize
        return materialize(self.gold, "gold_vacancy")

    def dim_quarter(self) -> DataFrame:
        return dim_quarter(self.__dict__.get("stored_gold", self.gold))
