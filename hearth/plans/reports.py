"""Report queries (RQ1-RQ15): each visual is one grouped query over the
star schema, and a row of KPI cards is a single aggregate.

Cross-table figures (a vacancy page card showing the *sales* load time)
combine one-row aggregates with a union + aggregate, not a cross join.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.operators import measures as M
from hearth.operators.joins import star_join


def _one_row_union(*frames: DataFrame) -> DataFrame:
    """Combine one-row aggregates with disjoint columns into one row."""
    cols = [c for f in frames for c in f.columns]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.agg(*[F.max(c).alias(c) for c in cols])


# --- sales page --------------------------------------------------------------------------------
def kpi_sales(fact: DataFrame) -> DataFrame:
    """RQ1: five cards, the exact median by selection; the two columns are stored once."""
    return M.evaluate(fact.select("SalePrice", "LoadTimestamp"), [
        "Total Sales", "Sales Count", "Average Sale Price", "Median Sale Price",
        "Data Last Updated"])


def price_by_county(fact: DataFrame, counties: DataFrame) -> DataFrame:
    """RQ2: average price by county (present descending)."""
    s = star_join(fact, [(counties, "CountyKey", "CountyKey")])
    return (s.groupBy("CountyName").agg(F.round(F.avg("SalePrice"), 2).alias("AverageSalePrice"))
            .orderBy(F.desc("AverageSalePrice"), "CountyName"))


def price_by_year(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """RQ3: average price by calendar year."""
    s = star_join(fact, [(dates, "DateKey", "DateKey")], bounded=[True])
    return (s.groupBy("Year").agg(F.round(F.avg("SalePrice"), 2).alias("AverageSalePrice"))
            .orderBy("Year"))


def slicer_choices(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """RQ4 / FL8 / FL9: the non-NULL distinct values each slicer offers, as
    (Slicer, Value) rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias("Slicer"), F.col(c).cast("string").alias("Value"))
                      for c in cols])
    return (df.select(F.inline(pairs)).filter(F.col("Value").isNotNull()).distinct()
            .orderBy("Slicer", "Value"))


# --- vacancy page ------------------------------------------------------------------------------
def _quarter_filter(fact: DataFrame, quarters: DataFrame, selected: Sequence[str] | None):
    s = star_join(fact, [(quarters, "QuarterKey", "QuarterKey")])
    return s.filter(F.col("Quarter").isin(list(selected))) if selected else s


def kpi_vacancy(fact: DataFrame, quarters: DataFrame, sales_fact: DataFrame,
                selected: Sequence[str] | None) -> DataFrame:
    """RQ5: vacant, stock, rate under the quarter slicer (FL7); the
    'last updated' card reads the sales load timestamp."""
    v = M.evaluate(_quarter_filter(fact, quarters, selected),
                   ["Total Vacant Dwellings", "Total Dwelling Stock", "Vacancy Rate"])
    s = M.evaluate(sales_fact, ["Data Last Updated"])
    return _one_row_union(v, s)


def vacant_by_county(fact, quarters, counties, selected) -> DataFrame:
    """RQ6."""
    s = star_join(_quarter_filter(fact, quarters, selected), [(counties, "CountyKey", "CountyKey")])
    return (M.evaluate(s, ["Total Vacant Dwellings"], by=["CountyName"])
            .orderBy(F.desc("TotalVacantDwellings"), "CountyName"))


def rate_by_county(fact, quarters, counties, selected) -> DataFrame:
    """RQ7."""
    s = star_join(_quarter_filter(fact, quarters, selected), [(counties, "CountyKey", "CountyKey")])
    return (M.evaluate(s, ["Vacancy Rate"], by=["CountyName"])
            .orderBy(F.desc("VacancyRate"), "CountyName"))


def rate_by_year(fact, quarters) -> DataFrame:
    """RQ8: not filtered by the quarter slicer."""
    s = star_join(fact, [(quarters, "QuarterKey", "QuarterKey")])
    return M.evaluate(s, ["Vacancy Rate"], by=["Year"]).orderBy("Year")


def vacancy_map(fact, quarters, counties) -> DataFrame:
    """RQ9: per county — vacant (bubble size), rate, stock, first quarter."""
    s = star_join(fact, [(quarters, "QuarterKey", "QuarterKey"),
                         (counties, "CountyKey", "CountyKey")])
    return s.groupBy("CountyName").agg(
        M.REGISTRY["Total Vacant Dwellings"]().alias("TotalVacantDwellings"),
        M.REGISTRY["Vacancy Rate"]().alias("VacancyRate"),
        M.REGISTRY["Total Dwelling Stock"]().alias("TotalDwellingStock"),
        F.min("Quarter").alias("FirstQuarter"))


def scaled_measure(grouped: DataFrame, measure: str, out: str = "Scaled") -> DataFrame:
    """RQ15: colour-scale input — (coalesce(m, 0) − min) / (max − min) over
    the rows of an already grouped visual (one row per category)."""
    w = Window.partitionBy()
    m = F.coalesce(F.col(measure).cast("double"), F.lit(0.0))
    return grouped.withColumn(out, F.try_divide(m - F.min(m).over(w),
                                                F.max(m).over(w) - F.min(m).over(w)))


# --- planning page -----------------------------------------------------------------------------
def kpi_planning(fact: DataFrame, decisions: DataFrame, sales_fact: DataFrame) -> DataFrame:
    """RQ10: total, granted, grant rate (+ sales 'last updated')."""
    s = star_join(fact, [(decisions, "DecisionTypeKey", "DecisionTypeKey")])
    p = M.evaluate(s, ["Total Planning Applications", "Granted Applications",
                       "Planning Grant Rate"])
    return _one_row_union(p, M.evaluate(sales_fact, ["Data Last Updated"]))


def applications_by_year(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """RQ11."""
    s = star_join(fact, [(dates, "DateKey", "DateKey")], bounded=[True])
    return M.evaluate(s, ["Total Planning Applications"], by=["Year"]).orderBy("Year")


def application_points(fact: DataFrame, decisions: DataFrame, authorities: DataFrame
                       ) -> DataFrame:
    """RQ12: map points grouped by (lon, lat, outcome) with the minimum of
    the tooltip fields."""
    s = star_join(fact, [(decisions, "DecisionTypeKey", "DecisionTypeKey"),
                         (authorities, "PlanningAuthorityKey", "PlanningAuthorityKey")])
    return s.groupBy("Longitude", "Latitude", "DecisionOutcome").agg(
        F.min("ApplicationNumber").alias("FirstApplicationNumber"),
        F.min("PlanningAuthorityName").alias("FirstPlanningAuthority"),
        F.min("ReceivedDate").alias("FirstReceivedDate"),
        F.min("DevelopmentAddress").alias("FirstDevelopmentAddress"),
        F.sum("ApplicationCount").alias("TotalPlanningApplications"))


def year_choices(dates_or_star: DataFrame, lo: int, hi: int, col: str = "Year") -> DataFrame:
    """FL6: the years a slicer offers, limited to [lo, hi]."""
    return (dates_or_star.select(col).filter(F.col(col).between(lo, hi)).distinct()
            .orderBy(col))


# --- operations page ---------------------------------------------------------------------------
def kpi_operations(run_log: DataFrame, sales_fact: DataFrame) -> DataFrame:
    """RQ13: runs, latest duration, succeeded, failed, last updated."""
    ops = M.evaluate(run_log, ["Total Pipeline Runs", "Successful Child Executions",
                               "Failed Child Executions"])
    latest = M.latest_run_duration(run_log).select("LatestRunDurationMinutes")
    return _one_row_union(ops, latest, M.evaluate(sales_fact, ["Data Last Updated"]))


RUN_LOG_DETAIL = ("ParentRunID", "DatasetName", "ChildPipelineName", "ExecutionOrder",
                  "RunStatus", "StartTime", "EndTime", "DurationSeconds", "LoadDate",
                  "ErrorMessage", "LogID")


def run_log_detail(run_log: DataFrame) -> DataFrame:
    """RQ14: the detail table, newest first (a distributed range sort)."""
    return run_log.select(*RUN_LOG_DETAIL).orderBy(F.desc_nulls_last("StartTime"), "LogID")
