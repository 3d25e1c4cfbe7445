"""Domain-shaped frames derived from the driver's TPC-H-like tables.

The engine's operators work on property-sales extracts, a statistics cube,
planning extracts and a run log.  The test data are TPC-H-like tables, so
these builders derive frames of the same *shape* from them with plain
DataFrame joins and expressions — the work grows with the input tables.
``hearth.plans.oracle`` holds the equivalent SQL for the DuckDB oracle.

Join strategy: ``lineitem ⋈ orders`` and ``orders ⋈ customer`` are big-big
joins on their keys (sort-merge with AQE skew splitting); ``nation`` and
``region`` have a size fixed by the schema (25 and 5 rows), so they are
broadcast explicitly; ``part`` is left to AQE's size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.functions.cleaning import SECOND_HAND_LABEL
from hearth.operators.keys import window_keys
from hearth.session import materialize
from hearth.sources.readers import inline_rows

# Fixed values of the stand-in mapping (chosen for this fixture)
DATE_SHIFT_MONTHS = 180                     # 1995-2001 → 2010-2016
RUN_TS = "2024-06-30 00:00:00"               # the run's load timestamp
RUN_DATE = "2024-06-30"
SECOND_HAND_IRISH = "Teach/Árasán Cónaithe Atháimhe"
NEW_IRISH = "Teach/Árasán Cónaithe Nua"
SIZE_SMALL = "less than 38 sq metres"
SIZE_MEDIUM = "greater than or equal to 38 sq metres and less than 125 sq metres"
SIZE_LARGE = "greater than or equal to 125 sq metres"
NULL_LAND_USE_SEGMENT = "HOUSEHOLD"
REPEATED_EVERY, NO_DATE_EVERY, NO_PRICE_EVERY = 50, 83, 97   # by order key
TWO_LANGUAGES_EVERY = 100
UNLISTED_LAND_USE = "MACHINERY"        # applications name it, the lookup doesn't have it
# decision texts by DecisionTypeID (id = orderkey mod 12; 0 → no decision)
DECISION_TEXTS = (
    (1, "Grant Permission"),
    (2, "Refuse Permission"),
    (3, "Conditional"),
    (4, "Split Decision"),
    (5, "Invalid Application"),
    (6, "Application Withdrawn"),
    (7, "Exempt Development"),
    (8, "Request AI"),
    (9, "N/A"),
    (10, "Declared Void"),
    (11, "refused, conditional grant"),
)
SALES_CSV_COLUMNS = (
    "Date of Sale (dd/mm/yyyy)", "Address", "County", "Eircode", "Price (€)",
    "Not Full Market Price", "VAT Exclusive", "Description of Property",
    "Property Size Description",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze property-sales rows (all text, CSV header names)."""
    key = F.col("l_orderkey")
    # every REPEATED_EVERY-th order is in the extract twice; copied while the rows are narrow
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_extendedprice", "l_returnflag", "l_linestatus",
        F.explode(F.when(key % REPEATED_EVERY == 0, F.array(F.lit(1), F.lit(2)))
                  .otherwise(F.array(F.lit(1)))).alias("_copy"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    j = (li.join(o, li.l_orderkey == o.o_orderkey, "left")
         .join(c, F.col("o_custkey") == c.c_custkey, "left")
         .join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey, "left")
         .join(p, F.col("l_partkey") == p.p_partkey, "left"))
    sale_day = F.add_months(F.col("o_orderdate"), DATE_SHIFT_MONTHS)
    k = F.col("l_orderkey")
    # some dates and prices are missing
    english = (F.col("_copy") == 2) & (k % TWO_LANGUAGES_EVERY == 0)   # the repeat is translated
    return j.select(
        F.when(k % NO_DATE_EVERY != 0, F.date_format(sale_day, "dd/MM/yyyy"))
        .alias(SALES_CSV_COLUMNS[0]),
        F.col("c_name").alias("Address"),
        F.col("n_name").alias("County"),
        F.col("p_brand").alias("Eircode"),
        F.when(k % NO_PRICE_EVERY != 0, F.concat(F.lit("€"), F.format_number(
            F.col("l_extendedprice").cast("decimal(18,2)"), 2))).alias("Price (€)"),
        F.when(F.col("l_returnflag") == "R", "Yes").otherwise("No")
        .alias("Not Full Market Price"),
        F.when(F.col("l_linestatus") == "O", "Yes").otherwise("No").alias("VAT Exclusive"),
        F.when((F.col("p_type") == "PROMO") & english, SECOND_HAND_LABEL)
        .when(F.col("p_type") == "PROMO", SECOND_HAND_IRISH)
        .when(F.col("p_type") == "SMALL", NEW_IRISH)
        .otherwise(F.col("p_type")).alias("Description of Property"),
        F.when(F.col("p_size") < 10, SIZE_SMALL).when(F.col("p_size") < 30, SIZE_MEDIUM)
        .otherwise(SIZE_LARGE).alias("Property Size Description"))


# --- statistics cube -------------------------------------------------------------------
def cube_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local-authority × quarter statistics in long form (silver vacancy
    shape before typing): one row per (statistic, quarter, authority).

    Authority = nation, vacant = orders with status F, stock = all orders,
    reported rate = rounded percentage.  The aggregate runs with map-side
    combine, so its cost is one scan of ``orders`` plus a small shuffle.
    """
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    j = (o.join(c, o.o_custkey == c.c_custkey, "left")
         .join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey, "left"))
    g = j.groupBy(
        (F.year("o_orderdate") * 10 + F.quarter("o_orderdate")).cast("string").alias("QuarterCode"),
        F.concat(F.year("o_orderdate").cast("string"), F.lit("Q"),
                 F.quarter("o_orderdate").cast("string")).alias("Quarter"),
        F.col("n_nationkey").cast("string").alias("LocalAuthorityCode"),
        F.col("n_name").alias("LocalAuthority"),
        F.col("n_regionkey").alias("RegionKey"),
    ).agg(F.count_if(F.col("o_orderstatus") == "F").alias("vacant"),
          F.count(F.lit(1)).alias("stock"))
    rate = F.round(F.col("vacant") * F.lit(100.0) / F.col("stock"), 1)
    stats = F.array(
        F.struct(F.lit("VAC14C01").alias("StatisticCode"),
                 F.lit("Vacant dwellings").alias("Statistic"),
                 F.lit("Number").alias("Unit"),
                 F.col("vacant").cast("double").alias("Value")),
        F.struct(F.lit("VAC14C02").alias("StatisticCode"),
                 F.lit("Dwelling stock").alias("Statistic"),
                 F.lit("Number").alias("Unit"),
                 F.col("stock").cast("double").alias("Value")),
        F.struct(F.lit("VAC14C03").alias("StatisticCode"),
                 F.lit("Vacancy rate").alias("Statistic"),
                 F.lit("%").alias("Unit"),
                 rate.alias("Value")))
    return g.select("QuarterCode", "Quarter", "LocalAuthorityCode", "LocalAuthority",
                    "RegionKey", F.inline(stats))


# --- planning extracts ---------------------------------------------------------------------
def planning_extracts(spark: SparkSession, sf_dir: str, shift_months: int = 0
                      ) -> dict[str, DataFrame]:
    """The six planning tables (application fact + five lookups).

    The code values that lookups are made from are written once, as extracts would
    be, so the planner sees how small they are.  With sizes that show only while the
    query runs, it may have dealt all applications by a code of few values before.
    """
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey",
                                                "c_mktsegment")
    n = table(spark, sf_dir, "nation")
    segments = materialize(window_keys(
        c.select("c_mktsegment").filter(F.col("c_mktsegment").isNotNull()).distinct(),
        ["c_mktsegment"], "LandUseTypeID"), "segments")      # 5 segments
    codes = materialize(o.select("o_orderpriority", "o_orderstatus").distinct(), "order_codes")
    land_use = (segments.where(F.col("c_mktsegment") != UNLISTED_LAND_USE)
                .select("LandUseTypeID", F.col("c_mktsegment").alias("LandUseTypeName")))
    j = (o.join(c, o.o_custkey == c.c_custkey, "left")
         .join(segments, "c_mktsegment", "left"))
    received = (F.timestamp_add("MONTH", F.lit(shift_months), F.col("o_orderdate"))
                if shift_months else F.col("o_orderdate"))
    k = F.col("o_orderkey")
    app = j.select(
        k.alias("SourceObjectID"),
        F.concat(F.lit(" PL/"), k.cast("string"), F.lit(" ")).alias("ApplicationNumber"),
        F.col("c_nationkey").alias("PlanningAuthorityID"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("ApplicationTypeID"),
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2)
        .cast("int").alias("ApplicationStatusID"),
        F.when(k % 12 != 0, (k % 12).cast("int")).alias("DecisionTypeID"),
        F.when(F.col("c_mktsegment") != NULL_LAND_USE_SEGMENT, F.col("LandUseTypeID"))
        .cast("int").alias("LandUseTypeID"),
        F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" works for "),
                 F.col("c_name"), F.lit(" ")).alias("DevelopmentDescription"),
        F.col("c_name").alias("DevelopmentAddress"),
        F.col("c_mktsegment").alias("DevelopmentPostcode"),
        (F.col("o_custkey").cast("double") * 10.0).alias("ITMEasting"),
        k.cast("double").alias("ITMNorthing"),
        F.when(F.col("o_custkey") % 13 != 12,
               (F.lit(50.5) + (F.col("o_custkey") % 13).cast("double") * 0.5)
               .cast("decimal(9,6)")).alias("Latitude"),
        (F.lit(-11.5) + (k % 14).cast("double") * 0.5).cast("decimal(9,6)").alias("Longitude"),
        F.col("o_totalprice").cast("decimal(18,4)").alias("AreaOfSite"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("FloorArea"),
        (F.col("o_custkey") % 5).cast("int").alias("NumResidentialUnits"),
        F.when(k % 3 == 0, F.lit(True)).when(k % 3 == 1, F.lit(False)).alias("OneOffHouse"),
        received.alias("ReceivedDate"),
        (received + F.expr("INTERVAL 56 DAYS")).alias("DecisionDate"),
        F.when(F.col("o_orderstatus") == "F", received + F.expr("INTERVAL 84 DAYS"))
        .alias("GrantDate"),
        (received + F.expr("INTERVAL 5 YEARS")).alias("ExpiryDate"),
        F.concat(F.lit("app/"), k.cast("string")).alias("LinkAppDetails"),
        F.col("o_orderdate").alias("SourceETLDate"),
        F.col("o_orderdate").alias("InsertedAt"),
        F.col("o_orderdate").alias("RecordLastUpdatedAt"))
    authority = n.select(F.col("n_nationkey").alias("PlanningAuthorityID"),
                         F.col("n_name").alias("PlanningAuthorityName"))
    app_type = (codes.select(F.substring("o_orderpriority", 1, 1).cast("int").alias("ApplicationTypeID"),
                             F.expr("substring(o_orderpriority, 3)").alias("ApplicationTypeName"))
                .distinct())
    status = (codes.filter(F.col("o_orderstatus").isin("F", "O"))
              .select(F.when(F.col("o_orderstatus") == "F", 1).otherwise(2)
                      .cast("int").alias("ApplicationStatusID"),
                      F.concat(F.lit("Status "), F.col("o_orderstatus"))
                      .alias("ApplicationStatusName"))
              .distinct())
    decision = inline_rows(spark, DECISION_TEXTS, "DecisionTypeID INT, DecisionTypeName STRING")
    return {"PlanningApplication": app, "PlanningAuthority": authority,
            "ApplicationType": app_type, "ApplicationStatus": status,
            "DecisionType": decision, "LandUseType": land_use}


# --- run log -------------------------------------------------------------------------------
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PipelineRunLog rows from ``events``: parent run = user, one child
    execution per event; error → Failed, signup → Running, else Succeeded."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    status = (F.when(F.col("event_type") == "error", "Failed")
              .when(F.col("event_type") == "signup", "Running").otherwise("Succeeded"))
    end = F.when(F.col("event_type") != "signup",
                 F.timestamp_add("SECOND", F.col("value").cast("int"), F.col("ts")))
    return e.select(
        F.col("event_id").cast("string").alias("LogID"),
        F.col("user_id").cast("string").alias("ParentRunID"),
        F.col("event_id").cast("int").alias("PipelineConfigID"),
        F.col("event_type").alias("DatasetName"),
        F.concat(F.lit("pl_"), F.col("event_type")).alias("ChildPipelineName"),
        F.lit(1).alias("ExecutionOrder"),
        status.alias("RunStatus"),
        F.col("ts").alias("StartTime"),
        end.alias("EndTime"),
        F.when(F.col("event_type") != "signup", F.col("value").cast("int")).alias("DurationSeconds"),
        F.col("ts").cast("date").alias("LoadDate"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("error in run "),
                                                         F.col("event_id").cast("string")))
        .alias("ErrorMessage"))
