"""Planning applications: six extracts → silver (JN1, DM14) → gold (DM13,
PR10, PR14, PR15) → dimensions (DM7, DM8) and fact (DM11)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.functions import cleaning as fc
from hearth.functions import dates as fd
from hearth.operators.dims import dim_from_source_ids
from hearth.operators import merge as mg
from hearth.operators.joins import denormalise
from hearth.operators.keys import with_unknown_member
from hearth.sources import standins as st

SOURCE_SYSTEM = "Irish Planning Applications"


def join_extracts(x: dict[str, DataFrame]) -> DataFrame:
    """JN1: application ⟕ five lookups, USING their ids."""
    return denormalise(x["PlanningApplication"], [
        (x["PlanningAuthority"], "PlanningAuthorityID"),
        (x["ApplicationType"], "ApplicationTypeID"),
        (x["ApplicationStatus"], "ApplicationStatusID"),
        (x["DecisionType"], "DecisionTypeID"),
        (x["LandUseType"], "LandUseTypeID"),
    ])


def silver_planning(joined: DataFrame, load_date: str, load_ts=None) -> DataFrame:
    """DM14: trimmed text, 'Not recorded' for missing lookups, dates."""
    ts = F.current_timestamp() if load_ts is None else F.lit(load_ts).cast("timestamp_ntz")
    t = F.trim
    return joined.select(
        "SourceObjectID", t("ApplicationNumber").alias("ApplicationNumber"),
        "PlanningAuthorityID", t("PlanningAuthorityName").alias("PlanningAuthority"),
        "ApplicationTypeID", t("ApplicationTypeName").alias("ApplicationType"),
        "ApplicationStatusID", fc.null_to_label("ApplicationStatusName").alias("ApplicationStatus"),
        "DecisionTypeID", fc.null_to_label("DecisionTypeName").alias("DecisionType"),
        "LandUseTypeID", fc.null_to_label("LandUseTypeName").alias("LandUseType"),
        t("DevelopmentDescription").alias("DevelopmentDescription"),
        t("DevelopmentAddress").alias("DevelopmentAddress"),
        t("DevelopmentPostcode").alias("DevelopmentPostcode"),
        "ITMEasting", "ITMNorthing", "Latitude", "Longitude", "AreaOfSite",
        "NumResidentialUnits", "OneOffHouse", "FloorArea",
        fc.cast_date("ReceivedDate").alias("ReceivedDate"),
        fc.cast_date("DecisionDate").alias("DecisionDate"),
        fc.cast_date("GrantDate").alias("GrantDate"),
        fc.cast_date("ExpiryDate").alias("ExpiryDate"),
        t("LinkAppDetails").alias("ApplicationDetailsURL"),
        "SourceETLDate",
        F.col("InsertedAt").alias("SQLInsertedAt"),
        F.col("RecordLastUpdatedAt").alias("SQLRecordLastUpdatedAt"),
        F.lit(load_date).cast("date").alias("LoadDate"),
        ts.alias("SilverLoadTimestamp"),
        F.lit(SOURCE_SYSTEM).alias("SourceSystem"))


def gold_planning(silver: DataFrame, load_ts=None) -> DataFrame:
    """DM13: calendar parts, labels, decision outcome and recorded flag."""
    ts = F.current_timestamp() if load_ts is None else F.lit(load_ts).cast("timestamp_ntz")
    outcome = fc.decision_outcome("DecisionType")
    return silver.withColumns({
        "ApplicationYear": F.year("ReceivedDate"),
        "ApplicationMonth": F.month("ReceivedDate"),
        "ApplicationYearMonth": fd.year_month("ReceivedDate"),
        "OneOffHouseCategory": fc.tri_state_label("OneOffHouse"),
        "DecisionOutcome": outcome,
    }).withColumns({
        "DecisionRecorded": fc.decision_recorded("DecisionOutcome"),
        "GoldLoadTimestamp": ts,
    })


# (source id, dimension key, [(source column, dimension column)], unknown member)
DIMENSIONS = {
    "dim_planning_authority": ("PlanningAuthorityID", "PlanningAuthorityKey",
                               [("PlanningAuthority", "PlanningAuthorityName")], None),
    "dim_application_type": ("ApplicationTypeID", "ApplicationTypeKey",
                             [("ApplicationType", "ApplicationTypeName")], None),
    "dim_application_status": ("ApplicationStatusID", "ApplicationStatusKey",
                               [("ApplicationStatus", "ApplicationStatusName")],
                               {"ApplicationStatusKey": 0,
                                "ApplicationStatusName": fc.NOT_RECORDED}),
    "dim_decision_type": ("DecisionTypeID", "DecisionTypeKey",
                          [("DecisionType", "DecisionTypeName"),
                           ("DecisionOutcome", "DecisionOutcome")],
                          {"DecisionTypeKey": 0, "DecisionTypeName": fc.NOT_RECORDED,
                           "DecisionOutcome": fc.NO_DECISION}),
    "dim_land_use_type": ("LandUseTypeID", "LandUseTypeKey",
                          [("LandUseType", "LandUseTypeName")],
                          {"LandUseTypeKey": 0, "LandUseTypeName": fc.NOT_RECORDED}),
}


def planning_dimension(gold: DataFrame, name: str) -> DataFrame:
    """DM7 / DM8: one dimension of ``DIMENSIONS``."""
    source_id, key, attrs, unknown = DIMENSIONS[name]
    return dim_from_source_ids(gold, source_id, key, attrs, unknown=unknown)


def planning_dimensions(gold: DataFrame) -> dict[str, DataFrame]:
    """All five DM7/DM8 dimensions from ONE aggregation pass: GROUPING SETS
    over the five source ids (one set per id), ``min(struct(attrs))`` per
    member as in ``first_per_key``, split by ``grouping_id()``.  Map-side
    partial aggregation collapses the expanded rows at once, so the shuffle
    carries one row per member per map task."""
    specs = list(DIMENSIONS.items())
    ids = [F.col(spec[0]) for _, spec in specs]
    n = len(ids)
    columns = {c for _, spec in specs for c in (spec[0], *[src for src, _ in spec[2]])}
    few = gold.select(*sorted(columns)).distinct()      # a hash aggregate; the minima sort
    g = few.groupingSets([[c] for c in ids], *ids).agg(
        F.grouping_id().alias("_gid"),
        *[F.min(F.struct(*[F.col(src).alias(dst) for src, dst in spec[2]])).alias(f"_m{i}")
          for i, (_, spec) in enumerate(specs)])
    out = {}
    for i, (name, (src_id, key, attrs, unknown)) in enumerate(specs):
        gid = (1 << n) - 1 - (1 << (n - 1 - i))       # only column i is grouped
        d = (g.filter((F.col("_gid") == gid) & F.col(src_id).isNotNull())
             .select(F.col(src_id).cast("int").alias(key),
                     *[F.col(f"_m{i}.{dst}").alias(dst) for _, dst in attrs]))
        out[name] = with_unknown_member(d, unknown) if unknown is not None else d
    return out


def fact_planning(gold: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """DM11: keys (unknown → 0), DateKey, flags, measures, truncated text; and
    the columns of gold named in ``also``."""
    return gold.select(
        F.col("SourceObjectID").cast("bigint").alias("PlanningApplicationKey"),
        "ApplicationNumber",
        F.col("PlanningAuthorityID").cast("int").alias("PlanningAuthorityKey"),
        F.col("ApplicationTypeID").cast("int").alias("ApplicationTypeKey"),
        fc.null_to_unknown_key("ApplicationStatusID").alias("ApplicationStatusKey"),
        fc.null_to_unknown_key("DecisionTypeID").alias("DecisionTypeKey"),
        fc.null_to_unknown_key("LandUseTypeID").alias("LandUseTypeKey"),
        fd.date_key("ReceivedDate").alias("DateKey"),
        "ReceivedDate", "DecisionDate", "GrantDate", "ExpiryDate",
        fc.constant_count().alias("ApplicationCount"),
        F.col("DecisionRecorded").cast("int").alias("DecisionRecorded"),
        fc.tri_state_flag("OneOffHouse").alias("OneOffHouseFlag"),
        "NumResidentialUnits", "AreaOfSite", "FloorArea", "Latitude", "Longitude",
        "ITMEasting", "ITMNorthing",
        fc.truncate_text("DevelopmentDescription", 4000).alias("DevelopmentDescription"),
        "DevelopmentAddress", "DevelopmentPostcode", "ApplicationDetailsURL",
        "SourceETLDate", "LoadDate", "GoldLoadTimestamp", *also)


class PlanningModel:
    def __init__(self, spark: SparkSession, sf_dir: str, shift_months: int = 0,
                 load_date: str = st.RUN_DATE, load_ts=st.RUN_TS):
        self.extracts = st.planning_extracts(spark, sf_dir, shift_months)
        self.joined = join_extracts(self.extracts)
        self.silver = silver_planning(self.joined, load_date, load_ts)
        self.gold = gold_planning(self.silver, load_ts)

    @property
    def fact(self) -> DataFrame:
        return fact_planning(self.gold)

    def star(self, columns: Sequence[str], dims: Sequence[str]) -> tuple[DataFrame, DataFrame]:
        """These columns of the fact, and the source columns of these dimensions
        (for ``planning_dimension``).  Both are one narrow table, written once:
        the extracts are joined once, and the planner sees the size of the rest."""
        from hearth.session import materialize
        sources = {c for n in dims for c in (DIMENSIONS[n][0], *[a for a, _ in DIMENSIONS[n][2]])}
        also = sorted(sources - set(columns))
        stored = materialize(fact_planning(self.gold, also).select(*columns, *also),
                             "star_planning")
        return stored.select(*columns), stored.select(*sorted(sources))


def incremental_load(extracts: dict[str, DataFrame], target: DataFrame, watermarks: DataFrame,
                     dataset: str, load_date: str, load_ts) -> tuple[DataFrame, DataFrame]:
    """MG2-MG5 as one flow: probe the source; with nothing newer than the
    dataset's watermark the target and the watermarks stay as they are; else
    the rows of the window become silver, are merged into ``target`` on the
    source id and stored, and the watermark moves last."""
    from hearth.session import materialize
    changed, app = "RecordLastUpdatedAt", extracts["PlanningApplication"]
    last = watermarks.where(F.col("DatasetName") == dataset).first()["LastWatermarkValue"]
    probe = mg.watermark_probe(app, changed, mg.wall_clock_literal(last))
    found = probe.first()
    if not found["HasNewData"]:
        return target, watermarks
    current = found["CurrentWatermark"]
    window = mg.incremental_window(app, changed, last, current)
    silver = silver_planning(join_extracts({**extracts, "PlanningApplication": window}),
                             load_date, load_ts)
    merged = materialize(mg.merge_upsert(target, silver, "SourceObjectID",
                                         ts="SQLRecordLastUpdatedAt"), "silver_planning")
    probes = merged.sparkSession.range(1).select(
        F.lit(dataset).alias("DatasetName"), mg.wall_clock_literal(current).alias("CurrentWatermark"))
    return merged, mg.advance_watermark(watermarks, probes, load_ts)
