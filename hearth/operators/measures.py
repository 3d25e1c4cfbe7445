"""Named measures (M1-M22): aggregate expressions evaluated under a filter
context, where the context is ``where`` + ``groupBy`` on the star.

``evaluate(df, names, by)`` evaluates many measures in one aggregate.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.operators.selection import exact_median
from hearth.session import materialize

Measure = Callable[[], Column]


def _sum_if(cond: Column, value: Column) -> Column:
    return F.sum(F.when(cond, value))


# M1-M7: property sales
SALES = {
    "Total Sales": lambda: F.sum("SalePrice"),
    "Sales Count": lambda: F.count(F.lit(1)),
    "Average Sale Price": lambda: F.avg("SalePrice"),
    "Highest Sale Price": lambda: F.max("SalePrice"),
    "Lowest Sale Price": lambda: F.min("SalePrice"),
    "Data Last Updated": lambda: F.max("LoadTimestamp"),
}

# M8-M10: vacancy (rate = fraction, ratio of sums — never an average of rates)
VACANCY = {
    "Total Vacant Dwellings": lambda: F.sum("VacantDwellings"),
    "Total Dwelling Stock": lambda: F.sum("DwellingStock"),
    "Vacancy Rate": lambda: F.try_divide(F.sum("VacantDwellings").cast("double"),
                                         F.sum("DwellingStock").cast("double")),
}

# M11-M17: planning.  Granted / Refused override an outcome filter (S10):
# ``by_outcome`` evaluates them where the outcome is one of the groups.
def _granted() -> Column:
    return F.col("DecisionOutcome") == "Granted"


def _refused() -> Column:
    return F.col("DecisionOutcome") == "Refused"


PLANNING = {
    "Total Planning Applications": lambda: F.sum("ApplicationCount"),
    "Granted Applications": lambda: _sum_if(_granted(), F.col("ApplicationCount")),
    "Refused Applications": lambda: _sum_if(_refused(), F.col("ApplicationCount")),
    "Planning Grant Rate": lambda: F.try_divide(
        _sum_if(_granted(), F.col("ApplicationCount")).cast("double"),
        (F.coalesce(_sum_if(_granted(), F.col("ApplicationCount")), F.lit(0))
         + F.coalesce(_sum_if(_refused(), F.col("ApplicationCount")), F.lit(0))).cast("double")),
    "One-Off House Applications": lambda: _sum_if(F.col("OneOffHouseFlag") == 1,
                                                  F.col("ApplicationCount")),
    "Total Residential Units": lambda: F.sum("NumResidentialUnits"),
    "Planning Data Last Updated": lambda: F.max("LoadDate"),
}

# M18-M20: operations (M21 needs a two-step plan: see ``latest_run_duration``)
OPERATIONS = {
    "Total Pipeline Runs": lambda: F.count_distinct("ParentRunID"),
    "Successful Child Executions": lambda: F.count_if(F.col("RunStatus") == "Succeeded"),
    "Failed Child Executions": lambda: F.coalesce(
        F.count_if(F.col("RunStatus") == "Failed"), F.lit(0)),
}

# M4: a median isn't one aggregate (``selection.exact_median``): measure → column
MEDIANS = {"Median Sale Price": "SalePrice"}

REGISTRY: dict[str, Measure] = {**SALES, **VACANCY, **PLANNING, **OPERATIONS}


def column_name(measure: str) -> str:
    return "".join(w[:1].upper() + w[1:] for w in measure.replace("-", " ").split())


def evaluate(df: DataFrame, names: Sequence[str], by: Sequence[str] = (),
             alias: Callable[[str], str] = column_name) -> DataFrame:
    """``by`` and the named measures.  All but medians are one aggregate; with a
    median among them the rows are stored once, and both read that."""
    medians = [n for n in names if n in MEDIANS]
    if medians:
        df = materialize(df, "measured")
    aggs = [REGISTRY[n]().alias(alias(n)) for n in names if n not in MEDIANS]
    out = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs or [F.count(F.lit(1)).alias("_rows")])
    for n in medians:
        found = exact_median(df, MEDIANS[n], "_median", by, stored=True)
        if by:
            found = found.select(*[F.col(b).alias(f"_by{k}") for k, b in enumerate(by)], "_median")
            on = [F.col(b).eqNullSafe(F.col(f"_by{k}")) for k, b in enumerate(by)]
            out = out.join(found, on, "left").drop(*[f"_by{k}" for k in range(len(by))])
        else:                       # one row each
            out = out.withColumn("_median", F.lit(found.first()[0]).cast("double"))
        out = out.withColumnRenamed("_median", alias(n))
    return out.select(*by, *[alias(n) for n in names])


def by_outcome(star: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """M11-M14 grouped by ``by`` and DecisionOutcome.  Granted, refused and the
    grant rate replace the outcome filter, so every outcome of a group shows
    the group's overall figures.  The window runs over the grouped rows, one
    per outcome."""
    per = star.groupBy(*by, "DecisionOutcome").agg(
        F.sum("ApplicationCount").alias("TotalPlanningApplications"))
    w = Window.partitionBy(*by)
    granted = F.sum(F.when(_granted(), F.col("TotalPlanningApplications"))).over(w)
    refused = F.sum(F.when(_refused(), F.col("TotalPlanningApplications"))).over(w)
    return per.select(*by, "DecisionOutcome", "TotalPlanningApplications",
                      granted.alias("GrantedApplications"), refused.alias("RefusedApplications"),
                      F.try_divide(granted.cast("double"),
                                   (F.coalesce(granted, F.lit(0)) + F.coalesce(refused, F.lit(0)))
                                   .cast("double")).alias("PlanningGrantRate"))


def latest_run_duration(run_log: DataFrame) -> DataFrame:
    """M21: minutes of the run with the latest start (of equal starts the
    largest run): (max end − min start) seconds / 60; NULL while no child of
    the run has an end.  Two small aggregates, no sort of the whole log."""
    latest = run_log.where(F.col("StartTime").isNotNull()).agg(
        F.max_by("ParentRunID", F.struct("StartTime", "ParentRunID")).alias("_rid"))
    rows = run_log.join(F.broadcast(latest), run_log["ParentRunID"] == latest["_rid"], "inner")
    from hearth.functions.dates import seconds_between
    secs = seconds_between(F.min("StartTime"), F.max("EndTime"))
    return rows.agg(F.first("_rid").alias("LatestParentRunID"),
                    (secs / F.lit(60.0)).alias("LatestRunDurationMinutes"))


# M22: implicit column aggregates (the default summarisation of a column)
IMPLICIT = {
    "ApplicationCount": "sum", "NumResidentialUnits": "sum", "AreaOfSite": "sum",
    "FloorArea": "sum", "VacantDwellings": "sum", "DwellingStock": "sum",
    "SalePrice": "sum", "PlanningApplicationKey": "count", "VacancyRate": "none",
}


def implicit_measures(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    aggs = []
    for c in cols:
        how = IMPLICIT.get(c, "none")
        if how == "sum":
            aggs.append(F.sum(c).alias(f"Sum{c}"))
        elif how == "count":
            aggs.append(F.count(c).alias(f"Count{c}"))
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
