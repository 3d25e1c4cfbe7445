"""The query catalogue: name → ``(spark, sf_dir) -> DataFrame``.

Every query derives its input from the driver's tables (``standins``) and
runs the engine's operators over all of their rows.  ``hearth.plans.oracle``
holds an independent SQL formulation of each for the DuckDB check.
Column names are aliased to match the oracle exactly.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.operators import aggregates as ag
from hearth.operators import cube as oc
from hearth.operators import cube_variant as cv
from hearth.operators import measures as M
from hearth.operators import merge as mg
from hearth.operators import quality as dq
from hearth.operators.dims import dim_date
from hearth.operators.joins import missing_members, star_join
from hearth.operators.registry import DimensionRegistry
from hearth.plans import cubes as cb
from hearth.plans import planning as pl
from hearth.plans import reports as rq
from hearth.plans import sales as sl
from hearth.plans import vacancy as vc
from hearth.session import fresh_subdir
from hearth.sources import checked, footers, sinks
from hearth.sources import standins as st
from hearth.sources.readers import inline_rows, read_extract_window

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the report pages (saved slicer selections)
SELECTED_QUARTERS = ("1998Q4",)
YEAR_CHOICES = (2010, 2014)
# merge / watermark fixture parameters
MERGE_CUT = "1998-01-01 00:00:00"
WINDOW_LAST = "1997-01-01 00:00:00"
CHANGED_PRIORITY = "1-URGENT"
BUCKETS = 16
TWICE_EVERY, LONG_TEXT_EVERY = 40, 50       # by source id: rows that came twice, long descriptions
EXTRACT_WINDOWS = {"orders": ("1996-12-31", "1997-06-30"), "lineitem": ("1995-01-01", "2000-01-01")}
LEAST_PRICE, TOO_CHEAP = 2000, "SalePrice is too low"
CUSTOMER_CSV = ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
EARLIER_RUN_DATE = "2024-06-29"
SHORT_CALENDAR = "2012-01-01"
REMOVED_MEMBERS = {"dim_planning_authority": 3, "dim_decision_type": 0}


# --- model builders (lazy; each query builds only what it reads) ----------------------------
def _sales(spark, sf) -> sl.SalesModel:
    return sl.SalesModel(spark, st.sales_raw(spark, sf), load_ts=st.RUN_TS)


def _vacancy(spark, sf) -> vc.VacancyModel:
    return vc.VacancyModel(spark, sf)


def _planning(spark, sf, shift=0) -> pl.PlanningModel:
    return pl.PlanningModel(spark, sf, shift_months=shift)


FACT_SALES_COLS = ("PropertySaleOrdinal", "DateKey", "CountyKey", "PropertyTypeKey", "SaleTypeKey", "Address",
                   "Eircode", "SalePrice", "IsFullMarketPrice", "LoadTimestamp")


# --- sales ---------------------------------------------------------------------------------------
def q_silver_sales_clean(spark, sf):
    return _sales(spark, sf).silver


def q_gold_sales(spark, sf):
    return _sales(spark, sf).gold


def q_metrics_county(spark, sf):
    return _sales(spark, sf).metrics_county()


def q_metrics_year(spark, sf):
    return _sales(spark, sf).metrics_year()


def q_metrics_county_year(spark, sf):
    return _sales(spark, sf).metrics_county_year()


def q_metrics_type(spark, sf):
    return _sales(spark, sf).metrics_type()


def q_market_summary(spark, sf):
    return _sales(spark, sf).market_summary()


def q_count_by_flag(spark, sf):
    return (ag.count_by(_sales(spark, sf).silver, "IsFullMarketPrice", "RowCount")
            .orderBy(F.desc("RowCount")))


def q_distinct_values(spark, sf):
    g = _sales(spark, sf).gold
    return (ag.distinct_count(g, "County").withColumnRenamed("DistinctCount", "Counties")
            .unionByName(ag.distinct_count(g, "PropertyType")
                         .withColumnRenamed("DistinctCount", "PropertyTypes"),
                         allowMissingColumns=True)
            .agg(F.max("Counties").alias("Counties"),
                 F.max("PropertyTypes").alias("PropertyTypes")))


def q_table_totals(spark, sf):
    """The layers as a load stores them; their totals come from the files' footers."""
    base, m = fresh_subdir(spark, "layers"), _sales(spark, sf)
    layers = {}

    def store(name, df):
        layers[name] = f"{base}/{name}"
        footers.with_load_micros(df).write.parquet(layers[name])
        return spark.read.parquet(layers[name]).drop(footers.MICROS)

    m.stored_silver = store("silver_sales", m.silver)
    store("gold_sales", m.stored_gold)
    store("fact_property_sales", m.fact)
    return footers.footer_totals(spark, layers)


def q_dim_county(spark, sf):
    return _sales(spark, sf).dim_county


def q_dim_property_type(spark, sf):
    return _sales(spark, sf).dim_property_type


def q_dim_sale_type(spark, sf):
    return _sales(spark, sf).dim_sale_type


def q_dim_date(spark, sf):
    """DM4 / SC8: every calendar day with its attributes and the number of
    sales on that day (0 where none), so the generated dimension is checked
    together with the data that lands in it."""
    per_day = _sales(spark, sf).gold.groupBy("SaleDate").agg(
        F.count(F.lit(1)).alias("SalesCount"))
    d = dim_date(spark)
    return (d.join(per_day, d["FullDate"] == per_day["SaleDate"], "left")
            .select(*[d[c] for c in d.columns],
                    F.coalesce(F.col("SalesCount"), F.lit(0)).alias("SalesCount")))


def q_fact_sales(spark, sf):
    return _sales(spark, sf).fact.select(*FACT_SALES_COLS)


def q_fact_market_metrics(spark, sf):
    return _sales(spark, sf).fact_market_metrics().drop("MarketMetricKey")


def q_star_sales_by_county_year(spark, sf):
    fact, dims = _sales(spark, sf).star(["dim_county", "dim_date"])
    s = star_join(fact, [(dims["dim_county"], "CountyKey", "CountyKey"),
                         (dims["dim_date"], "DateKey", "DateKey")], bounded=[False, True])
    return s.groupBy("CountyName", "Year").agg(
        F.count(F.lit(1)).alias("SalesCount"), F.sum("SalePrice").alias("TotalSales"))


def q_kpi_sales(spark, sf):
    """The fact keeps every gold row, so the cards need no dimension."""
    return rq.kpi_sales(_sales(spark, sf).star([], ["SalePrice", "LoadTimestamp"])[0])


def q_price_by_county(spark, sf):
    fact, dims = _sales(spark, sf).star(["dim_county"])
    return rq.price_by_county(fact, dims["dim_county"])


def q_price_by_year(spark, sf):
    fact, dims = _sales(spark, sf).star(["dim_date"])
    return rq.price_by_year(fact, dims["dim_date"])


def q_slicer_values(spark, sf):
    return rq.slicer_choices(_sales(spark, sf).gold, ["County", "IsFullMarketPrice"])


def q_ordered_months(spark, sf):
    g = _sales(spark, sf).gold
    return g.groupBy(F.month("SaleDate").alias("Month"),
                     F.date_format("SaleDate", "MMMM").alias("MonthName")) \
        .agg(F.count(F.lit(1)).alias("SalesCount")).orderBy("Month")   # SO5: name by number


def q_business_rules(spark, sf):
    s = _sales(spark, sf).silver
    return dq.business_rules(s, {
        "MissingSaleDate": F.col("SaleDate").isNull(),
        "MissingSalePrice": F.col("SalePrice").isNull(),
        "NonPositivePrice": F.col("SalePrice") <= 0,
    })


def q_null_counts(spark, sf):
    return dq.null_counts(_sales(spark, sf).silver,
                          ["SaleDate", "SalePrice", "County", "Address", "Eircode"])


def q_duplicate_keys(spark, sf):
    return ag.duplicate_keys(_sales(spark, sf).gold, ["Address", "SaleDate"])


# --- vacancy --------------------------------------------------------------------------------------
def q_cube_flatten(spark, sf):
    return _vacancy(spark, sf).silver


def q_cube_validate(spark, sf):
    """The documents, and the first region's once more without its last value."""
    d = vc.parse_documents(vc.cube_documents(spark, sf), keep=["RegionKey"])
    short = F.expr("slice(doc.value, 1, size(doc.value) - 1)")
    cut = d.where("RegionKey = 0").select((F.col("RegionKey") + 100).alias("RegionKey"),
                                          F.col("doc").withField("value", short).alias("doc"))
    return oc.cube_validate(d.unionByName(cut)).select(
        "RegionKey", "ExpectedCells", "ValueCount", "IsValid")


def q_cube_any_dimensions(spark, sf):
    """JS1-JS3 by each document's own dimensions: 2, 3 and 4 of them."""
    cubes = cv.parse_cubes(cb.cube_texts(spark, sf), keep=["Document"])

    def told(column, sign):
        entries = F.transform(F.map_entries(column), lambda e: F.concat(e["key"], F.lit(sign), e["value"]))
        return F.array_join(entries, "|").alias(column)

    return cv.decode_cubes(cubes, keep=["Document"]).select(
        "Document", "Updated", "Position", told("Codes", "="), told("Labels", ": "), "Unit", "Value")


def q_cube_present_cells(spark, sf):
    """The cells that hold a value, as columns; dimensions that a document lacks are NULL."""
    cubes = cv.parse_cubes(cb.cube_texts(spark, sf), keep=["Document"])
    cells = cv.decode_cubes(cubes, keep=["Document"], present=True)
    return cv.cube_columns(cells, {dim: name for dim, (_, name) in cb.DIMS.items()}, ["Document"])


def q_cube_problems(spark, sf):
    """JS2: documents and damaged copies of them, with what doesn't fit."""
    texts = cb.cube_texts(spark, sf)
    cubes = cv.parse_cubes(texts.unionByName(cb.damaged_texts(texts)), keep=["Document"])
    return cv.check_cubes(cubes).select("Document", "ExpectedCells", "ValueCount", "Problem")


def q_cube_metadata(spark, sf):
    d = vc.parse_documents(vc.cube_documents(spark, sf), keep=["RegionKey"])
    return oc.cube_metadata(d, keep=["RegionKey"])


def q_cube_pivot(spark, sf):
    return vc.local_authority_measures(_vacancy(spark, sf).silver)


def q_county_rollup(spark, sf):
    return _vacancy(spark, sf).gold


def _vacancy_star(spark, sf):
    """Vacancy model, county members and fact.  The load registers its counties in
    the stored dimension; fact and reports read that, not the sales."""
    v = _vacancy(spark, sf)
    counties = DimensionRegistry(spark, fresh_subdir(spark, "registry"), "dim_county",
                                 "CountyKey", "CountyName")
    counties.register(v.stored_gold, "County")
    return v, counties.members(), vc.fact_housing_vacancy(v.stored_gold, counties.members())


def _fact_vacancy(spark, sf):
    """DM10 under the counties of the sales: their load registers its members, and
    the fact looks its counties up in the stored dimension.  A county without sales
    has no member, so its rows have no key."""
    counties = DimensionRegistry(spark, fresh_subdir(spark, "registry"), "dim_county",
                                 "CountyKey", "CountyName")
    counties.register(_sales(spark, sf).gold, "County")
    return vc.fact_housing_vacancy(_vacancy(spark, sf).stored_gold, counties.members())


def q_fact_vacancy(spark, sf):
    return _fact_vacancy(spark, sf)


def q_dim_quarter(spark, sf):
    return _vacancy(spark, sf).dim_quarter()


def _sales_stamp_source(spark, sf) -> DataFrame:
    """'Data Last Updated' cards read the sales load timestamp.  The fact
    keeps every gold row (left joins on unique dimension keys), so the
    maximum over gold is the same value without building the star."""
    return _sales(spark, sf).gold


def q_kpi_vacancy(spark, sf):
    v, _, fact = _vacancy_star(spark, sf)
    return rq.kpi_vacancy(fact, v.dim_quarter(), _sales_stamp_source(spark, sf), SELECTED_QUARTERS)


def q_vacant_by_county(spark, sf):
    v, counties, fact = _vacancy_star(spark, sf)
    return rq.vacant_by_county(fact, v.dim_quarter(), counties, SELECTED_QUARTERS)


def q_rate_by_county(spark, sf):
    v, counties, fact = _vacancy_star(spark, sf)
    return rq.rate_by_county(fact, v.dim_quarter(), counties, SELECTED_QUARTERS)


def q_rate_by_year(spark, sf):
    v, _, fact = _vacancy_star(spark, sf)
    return rq.rate_by_year(fact, v.dim_quarter())


def q_vacancy_map(spark, sf):
    v, counties, fact = _vacancy_star(spark, sf)
    return rq.vacancy_map(fact, v.dim_quarter(), counties)


def q_scaled_measure(spark, sf):
    v, counties, fact = _vacancy_star(spark, sf)
    g = rq.vacant_by_county(fact, v.dim_quarter(), counties, SELECTED_QUARTERS)
    return rq.scaled_measure(g, "TotalVacantDwellings", "ScaledVacant")


def q_fact_checks(spark, sf):
    """DQ10 over a fact loaded while the first county's member was missing, with the
    first quarters loaded twice."""
    v, counties, _ = _vacancy_star(spark, sf)
    fact = vc.fact_housing_vacancy(v.stored_gold, counties.where("CountyKey <> 1"))
    return dq.fact_checks(fact.unionByName(fact.where("QuarterKey % 10 = 1")), "HousingVacancyKey")


# --- planning -------------------------------------------------------------------------------------
def q_planning_denormalised(spark, sf):
    return _planning(spark, sf).joined


def q_planning_silver(spark, sf):
    return _planning(spark, sf).silver


def q_planning_gold(spark, sf):
    return _planning(spark, sf).gold


def q_fact_planning(spark, sf):
    return _planning(spark, sf).fact


def q_decision_outcomes(spark, sf):
    return (ag.count_by(_planning(spark, sf).gold, "DecisionOutcome", "ApplicationCount")
            .orderBy(F.desc("ApplicationCount"), "DecisionOutcome"))


def q_one_off_house(spark, sf):
    return (ag.count_by(_planning(spark, sf).gold, "OneOffHouseCategory", "ApplicationCount")
            .orderBy(F.desc("ApplicationCount"), "OneOffHouseCategory"))


def q_dim_decision_type(spark, sf):
    return pl.planning_dimension(_planning(spark, sf).gold, "dim_decision_type")


def q_dim_status(spark, sf):
    return pl.planning_dimension(_planning(spark, sf).gold, "dim_application_status")


def q_dim_authority(spark, sf):
    return pl.planning_dimension(_planning(spark, sf).gold, "dim_planning_authority")


def q_dim_app_type(spark, sf):
    return pl.planning_dimension(_planning(spark, sf).gold, "dim_application_type")


def q_dim_land_use(spark, sf):
    return pl.planning_dimension(_planning(spark, sf).gold, "dim_land_use_type")


def q_missing_keys(spark, sf):
    """Two members are taken out of their dimensions, and the calendar starts
    after the first applications, so that there are keys to miss."""
    keys = [key for _, key, _, _ in pl.DIMENSIONS.values()]
    fact, source = _planning(spark, sf, st.DATE_SHIFT_MONTHS).star([*keys, "DateKey"],
                                                                   list(pl.DIMENSIONS))
    dims = pl.planning_dimensions(source)                    # five dimensions, one pass
    for name, member in REMOVED_MEMBERS.items():
        dims[name] = dims[name].where(F.col(pl.DIMENSIONS[name][1]) != member)
    return dq.missing_dimension_keys(fact, [
        *[(name, dims[name], key, key) for name, (_, key, _, _) in pl.DIMENSIONS.items()],
        ("dim_date", dim_date(spark, start=SHORT_CALENDAR), "DateKey", "DateKey"),
    ])


def q_missing_dates(spark, sf):
    p = _planning(spark, sf, st.DATE_SHIFT_MONTHS)
    return missing_members(p.fact, dim_date(spark, start=SHORT_CALENDAR), "DateKey", "DateKey",
                           ["DateKey", "ReceivedDate"]).orderBy("DateKey")


def q_lookup_quality(spark, sf):
    return dq.lookup_quality(_planning(spark, sf).joined, [
        ("ApplicationStatus", "ApplicationStatusID", "ApplicationStatusName"),
        ("DecisionType", "DecisionTypeID", "DecisionTypeName"),
        ("LandUseType", "LandUseTypeID", "LandUseTypeName"),
        ("PlanningAuthority", "PlanningAuthorityID", "PlanningAuthorityName"),
    ])


def q_invalid_coordinates(spark, sf):
    return dq.invalid_coordinates(_planning(spark, sf).silver)


def q_rowcount_preserved(spark, sf):
    p = _planning(spark, sf)
    return dq.rowcount_preserved(p.extracts["PlanningApplication"], p.joined)


def q_profile(spark, sf):
    """DQ9 over silver rows of which some came twice."""
    silver = _planning(spark, sf).silver
    twice = silver.unionByName(silver.where(F.col("SourceObjectID") % TWICE_EVERY == 0))
    return dq.profile(twice, ["SourceObjectID"],
                      ["ApplicationNumber", "ReceivedDate", "PlanningAuthority",
                       "ApplicationStatusID", "DecisionTypeID"])


def _planning_star(spark, sf, columns, dims=("dim_decision_type",)):
    fact, source = _planning(spark, sf, shift=st.DATE_SHIFT_MONTHS).star(columns, dims)
    return fact, *[pl.planning_dimension(source, n) for n in dims]


def q_kpi_planning(spark, sf):
    fact, decisions = _planning_star(spark, sf, ["DecisionTypeKey", "ApplicationCount"])
    return rq.kpi_planning(fact, decisions, _sales_stamp_source(spark, sf))


def q_applications_by_year(spark, sf):
    return rq.applications_by_year(_planning(spark, sf, st.DATE_SHIFT_MONTHS).fact,
                                   dim_date(spark))


def q_application_points(spark, sf):
    fact, decisions, authorities = _planning_star(
        spark, sf, ["DecisionTypeKey", "PlanningAuthorityKey", "Longitude", "Latitude",
                    "ApplicationNumber", "ReceivedDate", "DevelopmentAddress", "ApplicationCount"],
        ("dim_decision_type", "dim_planning_authority"))
    return rq.application_points(fact, decisions, authorities)


def q_year_choices(spark, sf):
    s = star_join(_planning(spark, sf, st.DATE_SHIFT_MONTHS).fact,
                  [(dim_date(spark), "DateKey", "DateKey")], bounded=[True])
    return rq.year_choices(s, *YEAR_CHOICES)


def q_implicit_measures(spark, sf):
    return M.implicit_measures(_planning(spark, sf, st.DATE_SHIFT_MONTHS).fact, [
        "ApplicationCount", "NumResidentialUnits", "AreaOfSite", "FloorArea",
        "PlanningApplicationKey"])


def q_granted_by_outcome(spark, sf):
    """M12-M14 where the outcome is a group: their own outcome wins."""
    fact, decisions = _planning_star(spark, sf, ["DecisionTypeKey", "DateKey", "ApplicationCount"])
    s = star_join(fact, [(decisions, "DecisionTypeKey", "DecisionTypeKey"),
                         (dim_date(spark), "DateKey", "DateKey")], bounded=[False, True])
    return M.by_outcome(s, ["Year"])


def q_incremental_planning(spark, sf):
    """MG2-MG5 as one run.  The target holds the applications up to the last
    watermark, and an older version of every seventh newer one."""
    last = F.lit(WINDOW_LAST).cast("timestamp_ntz")
    x = st.planning_extracts(spark, sf)
    app = x["PlanningApplication"]
    old = app.where(F.col("RecordLastUpdatedAt") <= last).unionByName(
        app.where((F.col("RecordLastUpdatedAt") > last) & (F.col("SourceObjectID") % 7 == 0))
        .withColumns({"AreaOfSite": (F.col("AreaOfSite") + 1).cast("decimal(18,4)"),
                      "RecordLastUpdatedAt": last}))
    target = pl.silver_planning(pl.join_extracts({**x, "PlanningApplication": old}),
                                EARLIER_RUN_DATE, st.RUN_TS)
    merged, marks = pl.incremental_load(x, target, _watermark_table(spark), "orders",
                                        st.RUN_DATE, st.RUN_TS)
    mark = marks.where(F.col("DatasetName") == "orders").first()["LastWatermarkValue"]
    return merged.select("SourceObjectID", "AreaOfSite", "SQLRecordLastUpdatedAt", "LoadDate",
                         mg.wall_clock_literal(mark).alias("Watermark"))


# --- operations -----------------------------------------------------------------------------------
def q_run_summary(spark, sf):
    return ag.run_summary(st.run_log(spark, sf))


def q_run_log_transitions(spark, sf):
    full = st.run_log(spark, sf)
    started = mg.run_log_start(spark.createDataFrame([], full.schema), full.select(
        "LogID", "ParentRunID", "PipelineConfigID", "DatasetName", "ChildPipelineName",
        "ExecutionOrder", "StartTime", "LoadDate"))
    finished = full.filter(F.col("RunStatus") != "Running")
    return mg.run_log_finish(started, finished)


def _pipeline_config(spark, sf) -> DataFrame:
    e = st.table(spark, sf, "events")
    return (e.groupBy("event_type").agg(F.min("event_id").alias("first_event"))
            .select(F.col("first_event").cast("int").alias("PipelineConfigID"),
                    F.col("event_type").alias("DatasetName"),
                    F.concat(F.lit("pl_"), F.col("event_type")).alias("ChildPipelineName"),
                    F.col("first_event").cast("int").alias("ExecutionOrder"),
                    (F.col("event_type") != "error").alias("IsActive")))


def q_active_pipelines(spark, sf):
    return mg.active_pipelines(_pipeline_config(spark, sf))


def q_config_upsert(spark, sf):
    cfg = _pipeline_config(spark, sf)
    changes = (cfg.filter(F.col("DatasetName") == "error")
               .withColumn("IsActive", F.lit(True))
               .unionByName(cfg.filter(F.col("DatasetName") == "view")
                            .withColumn("PipelineConfigID", F.col("PipelineConfigID") + 100000)
                            .withColumn("DatasetName", F.lit("view_backfill"))))
    return mg.config_upsert(cfg, changes)


def q_kpi_operations(spark, sf):
    return rq.kpi_operations(st.run_log(spark, sf), _sales_stamp_source(spark, sf))


def q_run_log_detail(spark, sf):
    return rq.run_log_detail(st.run_log(spark, sf))


# --- merge / watermark ---------------------------------------------------------------------------
ORDER_COLS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
              "o_orderpriority")


def merge_inputs(spark, sf):
    o = st.table(spark, sf, "orders").select(*ORDER_COLS).withColumn("UpdatedAt", F.col("o_orderdate"))
    cut = F.lit(MERGE_CUT).cast("timestamp_ntz")
    target = o.filter(F.col("o_orderdate") < cut)
    fresh = o.filter(F.col("o_orderdate") >= cut)
    changed = target.filter(F.col("o_orderpriority") == CHANGED_PRIORITY)
    v1 = changed.withColumns({"o_totalprice": F.col("o_totalprice") + 1,
                              "UpdatedAt": F.col("UpdatedAt") + F.expr("INTERVAL 1 DAY")})
    v2 = changed.withColumns({"o_totalprice": F.col("o_totalprice") + 2,
                              "UpdatedAt": F.col("UpdatedAt") + F.expr("INTERVAL 2 DAYS")})
    return target, fresh.unionByName(v1).unionByName(v2)


def q_merge_upsert(spark, sf):
    target, source = merge_inputs(spark, sf)
    return mg.merge_upsert(target, source, "o_orderkey", ts="UpdatedAt")


def q_incremental_window(spark, sf):
    o = st.table(spark, sf, "orders").select(*ORDER_COLS)
    probe = mg.watermark_probe(o, "o_orderdate", F.lit(WINDOW_LAST).cast("timestamp_ntz"))
    current = probe.first()["CurrentWatermark"]  # one scalar
    return mg.incremental_window(o, "o_orderdate", F.lit(WINDOW_LAST).cast("timestamp_ntz"),
                                 current)


def q_bucketed_merge(spark, sf):
    """JN7 / MG1 into a bucketed table: two loads, the changed rows one after the other."""
    from hearth.sources.bucketed import BucketedTarget
    target, source = merge_inputs(spark, sf)
    where = fresh_subdir(spark, "bucketed")
    table = BucketedTarget(spark, "orders_" + where.rsplit("-", 1)[1], where, "o_orderkey", BUCKETS)
    table.create(target)
    late = F.col("UpdatedAt") > F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")
    table.merge(source.where(~late), ts="UpdatedAt")
    table.merge(source.where(late), ts="UpdatedAt", keep_newer_target=True)
    return table.read()


def q_extract_window(spark, sf):
    """SC3 + MG3: the dated folders that the control table's window names."""
    base = fresh_subdir(spark, "extracts")
    o = st.table(spark, sf, "orders").select(*ORDER_COLS)
    (o.withColumn("load_date", F.trunc("o_orderdate", "month")).repartition("load_date")
     .write.partitionBy("load_date").parquet(f"{base}/orders"))
    control = [(n, *w) for n, w in EXTRACT_WINDOWS.items()]
    (spark.createDataFrame(control, "DatasetName STRING, LastLoadDate STRING, CurrentLoadDate STRING")
     .select("DatasetName", F.to_date("LastLoadDate").alias("LastLoadDate"),
             F.to_date("CurrentLoadDate").alias("CurrentLoadDate")).write.parquet(f"{base}/control"))
    return read_extract_window(spark, base, "orders", spark.read.parquet(f"{base}/control"), "orders")


def _watermark_table(spark):
    rows = [(1, "orders", "orders", "o_orderdate", "1997-01-01 00:00:00", True),
            (2, "lineitem", "lineitem", "l_shipdate", "2100-01-01 00:00:00", True),
            (3, "events", "events", "ts", "2024-01-15 00:00:00", True)]
    return (spark.createDataFrame(rows, "WatermarkConfigID INT, DatasetName STRING, "
                                  "SourceTable STRING, WatermarkColumn STRING, "
                                  "LastWatermarkValue STRING, IsActive BOOLEAN")
            .withColumn("LastWatermarkValue", F.col("LastWatermarkValue").cast("timestamp_ntz"))
            .withColumn("UpdatedAt", F.lit(None).cast("timestamp_ntz")))


def q_advance_watermark(spark, sf):
    wm = _watermark_table(spark)
    probes = (st.table(spark, sf, "orders").agg(F.max("o_orderdate").alias("CurrentWatermark"))
              .select(F.lit("orders").alias("DatasetName"), "CurrentWatermark")
              .unionByName(st.table(spark, sf, "lineitem").agg(
                  F.max("l_shipdate").alias("CurrentWatermark"))
                  .select(F.lit("lineitem").alias("DatasetName"), "CurrentWatermark"))
              .unionByName(st.table(spark, sf, "events").agg(
                  F.max("ts").alias("CurrentWatermark"))
                  .select(F.lit("events").alias("DatasetName"), "CurrentWatermark")))
    return mg.advance_watermark(wm, probes, F.lit(st.RUN_TS).cast("timestamp_ntz"))


def q_stream_upsert(spark, sf):
    from hearth.streaming.upsert import run_stream_upsert_on_slices
    target, source = merge_inputs(spark, sf)
    return run_stream_upsert_on_slices(spark, target, source, "o_orderkey", "UpdatedAt")


# --- sources / sinks -----------------------------------------------------------------------------
def q_layer_roundtrip(spark, sf):
    from hearth.sources.sinks import roundtrip_layer
    return roundtrip_layer(spark, _sales(spark, sf).gold, "gold_property_sales")


def q_extract_roundtrip(spark, sf):
    from hearth.sources.sinks import roundtrip_csv
    return roundtrip_csv(spark, st.sales_raw(spark, sf))


def _sales_load(spark, sf) -> checked.CheckedLoad:
    """The fact loaded into its declared table, with a rule of the load's own."""
    return checked.load_checked(
        _sales(spark, sf).fact, sinks.FACT_PROPERTY_SALES, fresh_subdir(spark, "loads") + "/fact",
        **{TOO_CHEAP: F.col("SalePrice") < LEAST_PRICE})


def q_staging_load(spark, sf):
    """SK5: the rows that fit the declared table."""
    return _sales_load(spark, sf).loaded.drop("PropertySaleKey")


def q_rejected_rows(spark, sf):
    """SK5: the rows that don't, with the rules they break."""
    return _sales_load(spark, sf).rejected.select(
        *FACT_SALES_COLS, F.array_join(checked.REASONS, "; ").alias("Reasons"))


def q_load_counts(spark, sf):
    """SK6 / DQ5: what the writing job counted, beside what the two tables hold."""
    done = _sales_load(spark, sf)
    told = inline_rows(spark, sorted(done.counts.items()), "Name STRING, Counted BIGINT")
    rows = (done.loaded.agg(F.count(F.lit(1)).alias("n")).select(F.lit("rows").alias("Name"), "n")
            .unionByName(done.rejected.select(F.inline(F.array(
                *[F.struct(F.lit(n).alias("Name"), F.lit(1).cast("bigint").alias("n"))
                  for n in ("rows", "rejected")])))
                .unionByName(done.rejected.select(F.explode(checked.REASONS).alias("Name"),
                                                  F.lit(1).cast("bigint").alias("n")))))
    held = rows.groupBy("Name").agg(F.sum("n").alias("Stored"))
    return told.join(held, "Name", "left").select("Name", "Counted",
                                                  F.coalesce("Stored", F.lit(0)).alias("Stored"))


def _customer_lines(spark, sf):
    """Customers as CSV files with a header, some lines damaged by customer key."""
    c = st.table(spark, sf, "customer").select(*CUSTOMER_CSV)
    k = F.col("c_custkey")
    fields = [F.col(n).cast("string") for n in CUSTOMER_CSV]
    line = (F.when(k % 7 == 0, F.concat_ws(",", *fields[:-1]))                  # short
            .when(k % 11 == 0, F.concat_ws(",", *fields, F.lit("more")))        # long
            .when(k % 13 == 0, F.concat_ws(",", fields[0], F.concat(F.lit('"'), fields[1]), *fields[2:]))
            .when(k % 17 == 0, F.concat_ws(",", F.lit("none"), *fields[1:]))    # no number
            .otherwise(F.concat_ws(",", *fields)))
    path = fresh_subdir(spark, "customers") + "/csv"
    (c.select(line.alias(",".join(CUSTOMER_CSV))).write.option("header", True).option("sep", "\u0001")
     .option("quote", "\u0000").option("escapeQuotes", False).csv(path))
    return checked.read_csv_checked(
        spark, path, "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING",
        encoding="UTF-8")


def q_csv_good_rows(spark, sf):
    """SC1: the rows of a file with damaged lines."""
    return _customer_lines(spark, sf).loaded


def q_csv_damaged_lines(spark, sf):
    """SC1: the damaged lines of that file, as they stand in it."""
    return _customer_lines(spark, sf).rejected.select(
        "Line", F.col("File").endswith(".csv").alias("HasFile"),
        F.array_join(checked.REASONS, "; ").alias("Reasons"))


def q_cube_from_files(spark, sf):
    """SC2: cube documents land as files; each file is read whole as one
    text row on the executors and decoded (no driver ``first()``)."""
    from hearth.sources.readers import read_json_documents
    path = fresh_subdir(spark, "bronze-cube") + "/docs"
    vc.cube_documents(spark, sf).select("value").write.text(path)
    return vc.silver_vacancy(spark, read_json_documents(spark, path), st.RUN_DATE, st.RUN_TS)


def q_planning_from_extracts(spark, sf):
    """SC3 + SC6: the six extracts land under dated folders; the silver
    build reads one load date by partition filter on each table root."""
    from hearth.session import fresh_subdir
    from hearth.sources.readers import bronze_path, read_extracts
    base = fresh_subdir(spark, "bronze-planning")
    for name, df in st.planning_extracts(spark, sf).items():
        df.write.parquet(bronze_path(base, name, st.RUN_DATE))
        spark.createDataFrame([], df.schema).write.parquet(
            bronze_path(base, name, "2024-06-29"))          # an older, empty load day
    x = read_extracts(spark, base, st.RUN_DATE)
    return pl.silver_planning(pl.join_extracts(x), st.RUN_DATE, st.RUN_TS)


def q_staging_table_roundtrip(spark, sf):
    """SK3 + SC5: a dimension saved as a catalog table and read back."""
    from hearth.session import fresh_subdir
    from hearth.sources.readers import read_table
    from hearth.sources.sinks import save_staging
    save_staging(_sales(spark, sf).dim_county, "stg_dim_county_rt",
                 fresh_subdir(spark, "staging") + "/stg_dim_county_rt")
    return read_table(spark, "stg_dim_county_rt")


def q_staging_tables(spark, sf):
    """SK4 + DQ11: the planning dimensions, made in one pass, saved as staging tables
    in one call; the schema report and row count of each, read back by name."""
    where = fresh_subdir(spark, "staging")
    tag = where.rsplit("-", 1)[1]
    dims = pl.planning_dimensions(_planning(spark, sf).gold)
    sinks.save_all({f"stg_{n}_{tag}": df for n, df in dims.items()}, where)
    out = None
    for n in dims:
        saved = spark.table(f"stg_{n}_{tag}")
        report = dq.schema_report(saved).select(
            F.lit(f"stg_{n}").alias("TableName"), "Position", "ColumnName", "DataType",
            F.lit(saved.count()).alias("TableRows"))        # one number per table
        out = report if out is None else out.unionByName(report)
    return out


def q_latest_run(spark, sf):
    """WN3 / SO4: the run log row with the latest start (top-1 without a
    global sort: one ``max_by`` aggregate, ties broken by LogID)."""
    log = st.run_log(spark, sf)
    top = log.agg(F.max_by(F.struct(*log.columns),
                           F.struct("StartTime", "LogID")).alias("r"))
    return top.select("r.*")


def q_unmatched_reference(spark, sf):
    """DQ4: lookup names still NULL after the five joins."""
    return dq.unmatched_reference(_planning(spark, sf).joined,
                                  ["PlanningAuthorityName", "ApplicationTypeName",
                                   "ApplicationStatusName", "DecisionTypeName",
                                   "LandUseTypeName"])


def q_sales_measures(spark, sf):
    """M1-M6 under a county filter context."""
    fact, dims = _sales(spark, sf).star(["dim_county"])
    s = star_join(fact, [(dims["dim_county"], "CountyKey", "CountyKey")])
    return M.evaluate(s, ["Total Sales", "Sales Count", "Average Sale Price",
                          "Highest Sale Price", "Lowest Sale Price"], by=["CountyName"])


def q_median_by_county(spark, sf):
    """M4 under a county filter context: exact median per county, ranked in
    a distributed way (a county with a third of all sales still spreads)."""
    fact, dims = _sales(spark, sf).star(["dim_county"])
    s = star_join(fact, [(dims["dim_county"], "CountyKey", "CountyKey")])
    return M.exact_median(s, "SalePrice", "MedianSalePrice", by=["CountyName"])


def q_planning_measures(spark, sf):
    """M11-M17 by calendar year over the planning star."""
    fact, decisions = _planning_star(spark, sf, [
        "DecisionTypeKey", "DateKey", "ApplicationCount", "OneOffHouseFlag",
        "NumResidentialUnits", "LoadDate"])
    s = star_join(fact, [(decisions, "DecisionTypeKey", "DecisionTypeKey"),
                         (dim_date(spark), "DateKey", "DateKey")], bounded=[False, True])
    return M.evaluate(s, ["Total Planning Applications", "Granted Applications",
                          "Refused Applications", "Planning Grant Rate",
                          "One-Off House Applications", "Total Residential Units",
                          "Planning Data Last Updated"], by=["Year"])


def q_audit_columns(spark, sf):
    """PR17 / PR18 / PR19: run stamps, source label and load date on every
    application row, the constant application count and the 4000-character
    description cut of the warehouse column, which some texts reach."""
    from hearth.functions import cleaning as fc
    app = st.planning_extracts(spark, sf)["PlanningApplication"].withColumn(
        "DevelopmentDescription", F.when(
            F.col("SourceObjectID") % LONG_TEXT_EVERY == 0, F.repeat("DevelopmentDescription", F.lit(200)))
        .otherwise(F.col("DevelopmentDescription")))
    stamped = fc.add_audit_columns(app, pl.SOURCE_SYSTEM, st.RUN_TS, load_date=st.RUN_DATE,
                                   date_col="LoadDate")
    return stamped.select("SourceObjectID", "LoadTimestamp", "SourceSystem", "LoadDate",
                          fc.constant_count().alias("ApplicationCount"),
                          fc.truncate_text("DevelopmentDescription", 4000)
                          .alias("DevelopmentDescription"))


# --- row identity, stable keys, warehouse tables ----------------------------------------------------
def q_sale_row_key(spark, sf):
    """S7: (PropertySaleKey, PropertySaleOrdinal) names one row."""
    per = _sales(spark, sf).fact.groupBy("PropertySaleKey", "PropertySaleOrdinal").agg(
        F.count(F.lit(1)).alias("n"))
    return per.agg(F.sum("n").alias("RowCount"), F.count(F.lit(1)).alias("DistinctKeys"),
                   F.count_if(F.col("PropertySaleOrdinal") > 1).alias("RepeatedSales"))


def q_stable_county_keys(spark, sf):
    """S6: a first load that knew only some counties, then the whole data."""
    m = _sales(spark, sf)
    first = sl.dim_county(m.gold.where(F.length("County") % 2 == 0))
    return sl.dim_county(m.gold, existing=first)


def q_county_registry(spark, sf):
    """DM1, S6: the vacancy load registers its counties, the sales load new ones
    after them, a second sales load none; both facts carry the stored keys."""
    counties = DimensionRegistry(spark, fresh_subdir(spark, "registry"), "dim_county",
                                 "CountyKey", "CountyName")
    gold = _vacancy(spark, sf).stored_gold
    names = _sales(spark, sf).gold.select("County")
    counties.register(gold, "County")
    counties.register(names, "County")
    counties.register(names, "County")
    vacancy = vc.fact_housing_vacancy(gold, counties.members()).groupBy("CountyKey").agg(
        F.count(F.lit(1)).alias("VacancyRows"))
    sold = sl.keyed_sales(names, {"dim_county": counties.members()}, []).groupBy("CountyKey").agg(
        F.count(F.lit(1)).alias("SalesRows"))
    return (counties.stored().join(vacancy, "CountyKey", "left").join(sold, "CountyKey", "left")
            .select("CountyKey", "CountyName", "LoadNumber",
                    *[F.coalesce(c, F.lit(0)).alias(c) for c in ("VacancyRows", "SalesRows")]))


def q_largest_sales(spark, sf):
    """SO3: the twenty largest sales."""
    rest = ["Address", "SaleDate", "Eircode", "PropertyType", "PropertySizeCategory", "SaleType",
            "IsFullMarketPrice"]
    return (_sales(spark, sf).gold.select("SalePrice", *rest)
            .orderBy(F.desc_nulls_last("SalePrice"), *rest).limit(20))


def q_county_from_default_map(spark, sf):
    """PR16 with the default map: the first nations stand for the authorities
    that the map names, the others for ordinary county councils."""
    from hearth.functions import cleaning as fc
    named = inline_rows(spark, list(enumerate(fc.AUTHORITY_COUNTY)), "n_nationkey INT, name STRING")
    authority = st.table(spark, sf, "nation").join(named, "n_nationkey", "left").select(
        "n_nationkey", F.coalesce("name", F.concat("n_name", F.lit(" County Council")))
        .alias("LocalAuthority"))
    c = st.table(spark, sf, "customer").select("c_nationkey", "c_acctbal")
    return (c.join(authority, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .groupBy("LocalAuthority").agg(F.count(F.lit(1)).alias("Dwellings"))
            .withColumn("County", fc.local_authority_to_county("LocalAuthority")))


def q_snapshot_merge(spark, sf):
    """MG2 + SK2 + SK6: the first load creates the table, the second merges into
    it, a third replaces its rows under the same schema; each write counts its rows."""
    target, source = merge_inputs(spark, sf)
    store = mg.SnapshotStore(spark, fresh_subdir(spark, "snapshots"))
    store.create_or_merge(target, "orders", "o_orderkey")
    merged = mg.merge_upsert(store.read("orders"), source, "o_orderkey", ts="UpdatedAt")
    _, rows = store.overwrite_counted(merged, "orders")
    version, kept = store.overwrite_counted(store.read("orders"), "orders", keep_schema=True)
    if kept != rows:
        raise RuntimeError("the stored table lost rows")
    return store.read("orders").withColumns({"Version": F.lit(version), "RowsWritten": F.lit(rows)})


def _warehouse(spark, df, table, columns) -> DataFrame:
    from hearth.sources.sinks import replace_warehouse_table
    store = mg.SnapshotStore(spark, fresh_subdir(spark, "warehouse"))
    return replace_warehouse_table(store, df, table, columns)


def q_warehouse_dim_county(spark, sf):
    return _warehouse(spark, _sales(spark, sf).dim_county, "dim_county", sinks.DIM_COUNTY)


def q_warehouse_dim_property_type(spark, sf):
    return _warehouse(spark, _sales(spark, sf).dim_property_type, "dim_property_type",
                      sinks.DIM_PROPERTY_TYPE)


def q_warehouse_dim_sale_type(spark, sf):
    return _warehouse(spark, _sales(spark, sf).dim_sale_type, "dim_sale_type", sinks.DIM_SALE_TYPE)


def q_warehouse_dim_date(spark, sf):
    """The calendar days on which something was sold."""
    days = _sales(spark, sf).gold.select(F.col("SaleDate").alias("FullDate")).distinct()
    return _warehouse(spark, dim_date(spark).join(days, "FullDate", "left_semi"), "dim_date",
                      sinks.DIM_DATE)


def q_warehouse_dim_quarter(spark, sf):
    return _warehouse(spark, _vacancy(spark, sf).dim_quarter(), "dim_quarter", sinks.DIM_QUARTER)


def q_warehouse_fact_vacancy(spark, sf):
    return _warehouse(spark, _fact_vacancy(spark, sf), "fact_housing_vacancy",
                      sinks.FACT_HOUSING_VACANCY)


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
