import datetime as dt

import pytest
from pyspark.sql import functions as F

from hearth.operators import aggregates as ag
from hearth.operators import measures as M
from hearth.operators import merge as mg
from hearth.operators import quality as dq
from hearth.operators.joins import missing_keys, missing_members
from hearth.session import fresh_subdir
from tests.conftest import rows

SCHEMA = "k int, v string, ts int"


def test_merge_update_insert_null_keys(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (None, "tn", 1)], SCHEMA)
    s = spark.createDataFrame([(2, "B", 2), (3, "c", 2), (None, "sn", 2)], SCHEMA)
    out = rows(mg.merge_upsert(t, s, "k"))
    assert out == rows(spark.createDataFrame(
        [(1, "a", 1), (2, "B", 2), (3, "c", 2), (None, "tn", 1), (None, "sn", 2)], SCHEMA))


def test_merge_duplicate_source_keys(spark):
    t = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    s = spark.createDataFrame([(1, "x", 5), (1, "y", 9)], SCHEMA)
    assert rows(mg.merge_upsert(t, s, "k", ts="ts")) == [(1, "y", 9)]
    with pytest.raises(ValueError):
        mg.merge_upsert(t, s, "k", strict=True)


def test_merge_empty_source_and_properties(spark):
    t = spark.createDataFrame([(i, str(i), 1) for i in range(20)], SCHEMA)
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(mg.merge_upsert(t, empty, "k")) == rows(t)
    s = spark.createDataFrame([(i, "n", 2) for i in range(15, 30)], SCHEMA)
    once = mg.merge_upsert(t, s, "k")
    twice = mg.merge_upsert(once, s, "k")
    assert rows(once) == rows(twice)                              # idempotent
    anti = t.join(s, "k", "left_anti").count()
    assert once.count() == anti + s.count()                       # |t ▷ s| + |s|


def test_merge_keep_newer_target(spark):
    t = spark.createDataFrame([(1, "t", 5), (2, "t", 5)], SCHEMA)
    s = spark.createDataFrame([(1, "late", 4), (2, "new", 6)], SCHEMA)
    out = rows(mg.merge_upsert(t, s, "k", ts="ts", keep_newer_target=True))
    assert out == [(1, "t", 5), (2, "new", 6)]


def test_snapshot_store_create_or_merge(spark):
    store = mg.SnapshotStore(spark, fresh_subdir(spark, "store-test"))
    t = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    assert not store.exists("x")
    assert store.create_or_merge(t, "x", "k") == 1               # absent target → create
    s = spark.createDataFrame([(1, "b", 2), (2, "c", 2)], SCHEMA)
    assert store.create_or_merge(s, "x", "k", ts="ts") == 2
    assert rows(store.read("x")) == [(1, "b", 2), (2, "c", 2)]
    assert rows(store.read("x", 1)) == [(1, "a", 1)]             # old version intact
    assert store.readback_check("x", 2)
    with pytest.raises(ValueError):
        store.overwrite(spark.createDataFrame([(1,)], "z int"), "x", keep_schema=True)


def test_incremental_window_bounds(spark):
    df = spark.createDataFrame([(1,), (5,), (9,), (10,)], "ts int")
    assert rows(mg.incremental_window(df, "ts", 5, 9)) == [(9,)]   # (last, current]
    p = mg.watermark_probe(df, "ts", 10).first()
    assert (p.CurrentWatermark, p.HasNewData) == (10, False)


def test_advance_watermark_only_forward(spark):
    wm = spark.createDataFrame([("a", 5, None), ("b", 9, None)],
                               "DatasetName string, LastWatermarkValue int, UpdatedAt int")
    probes = spark.createDataFrame([("a", 7), ("b", 3)], "DatasetName string, CurrentWatermark int")
    assert rows(mg.advance_watermark(wm, probes, 42)) == [("a", 7, 42), ("b", 9, None)]


def test_run_summary_statuses(spark):
    t0 = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame([
        ("r1", "Failed", t0, t0 + dt.timedelta(seconds=90), dt.date(2024, 1, 1)),
        ("r1", "Running", t0, None, dt.date(2024, 1, 1)),
        ("r2", "Running", t0, None, dt.date(2024, 1, 2)),
        ("r3", "Succeeded", t0, t0 + dt.timedelta(seconds=30), dt.date(2024, 1, 3)),
        ("r3", "Succeeded", t0, t0 + dt.timedelta(seconds=60), dt.date(2024, 1, 3)),
    ], "ParentRunID string, RunStatus string, StartTime timestamp_ntz, EndTime timestamp_ntz, "
       "LoadDate date")
    s = {r.ParentRunID: r for r in ag.run_summary(log).collect()}
    assert s["r1"].OverallRunStatus == "Failed" and s["r1"].TotalDurationSeconds == 90
    assert s["r2"].OverallRunStatus == "Running" and s["r2"].RunEndTime is None
    assert s["r3"].OverallRunStatus == "Succeeded" and str(s["r3"].TotalDurationMinutes) == "1.00"


def test_latest_run_duration(spark):
    t0 = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame([
        ("old", t0, t0 + dt.timedelta(seconds=120)),
        ("new", t0 + dt.timedelta(hours=1), None),                 # latest, no end yet
        ("nul", None, None),
    ], "ParentRunID string, StartTime timestamp_ntz, EndTime timestamp_ntz")
    r = M.latest_run_duration(log).first()
    assert r.LatestParentRunID == "new" and r.LatestRunDurationMinutes is None
    log2 = log.filter(F.col("ParentRunID") != "new")
    assert M.latest_run_duration(log2).first().LatestRunDurationMinutes == 2.0


def test_exact_median_with_hot_value(spark):
    vals = [7.0] * 400 + [float(i) for i in range(601)]
    df = spark.createDataFrame([(v,) for v in vals], "p double").repartition(5)
    import statistics
    assert M.exact_median(df, "p", "m").first().m == statistics.median(vals)
    even = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,)], "p double")
    assert M.exact_median(even, "p", "m").first().m == 3.0


def test_exact_median_edge_sizes(spark):
    none = spark.createDataFrame([(None,), (None,)], "p double")
    assert M.exact_median(none, "p", "m").collect()[0].m is None
    one = spark.createDataFrame([(None,), (4.5,)], "p double")
    assert M.exact_median(one, "p", "m").collect()[0].m == 4.5


def test_rows_at_ranks_across_partitions(spark):
    from hearth.operators.keys import range_stamped, rows_at_ranks
    vals = [3] * 50 + list(range(100))
    df = spark.createDataFrame([(v,) for v in vals], "v int").repartition(6)
    ordered = range_stamped(df.withColumn("tb", F.monotonically_increasing_id()), ["v", "tb"])
    want = sorted(vals)
    got = [r.v for r in rows_at_ranks(ordered, [1, 51, 75, 150]).orderBy("_mid").collect()]
    assert got == [want[0], want[50], want[74], want[149]]
    assert rows_at_ranks(ordered, lambda n: [n + 1]).count() == 0


def test_exact_median_by_group_with_hot_group(spark):
    import statistics
    data = [("hot", float(v)) for v in [5.0] * 300 + list(range(301))] + \
           [("b", 1.0), ("b", 4.0), ("c", None), (None, 2.0), (None, 3.0), (None, 9.0)]
    df = spark.createDataFrame(data, "g string, p double").repartition(4)
    got = dict(rows(M.exact_median(df, "p", "m", by=["g"])))
    want = {"hot": statistics.median([5.0] * 300 + list(range(301))), "b": 2.5,
            "c": None, None: 3.0}
    assert got == want


def test_missing_keys_null_counts_as_missing(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,), (2,)], "k int")
    dim = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(missing_keys(fact, dim, "k")) == sorted([(2,), (None,)], key=str)
    mm = missing_members(spark.createDataFrame([(2, "x"), (1, "y")], "k int, n string"),
                         dim, "k", "k", ["k", "n"])
    assert rows(mm) == [(2, "x")]


def test_quality_reports_single_pass(spark):
    df = spark.createDataFrame([(1, None, 5.0), (1, "b", -1.0), (2, "c", None)],
                               "id int, name string, price double")
    assert rows(dq.null_counts(df, ["name", "price"])) == [("name", 1), ("price", 1)]
    br = dict(rows(dq.business_rules(df, {"NonPositive": F.col("price") <= 0})))
    assert br == {"RowCount": 3, "NonPositive": 1}
    prof = dict(rows(dq.profile(df, ["id"], ["name"])))
    assert prof == {"RowCount": 3, "Null name": 1, "DuplicateKeys": 1}
    lq = rows(dq.lookup_quality(df.withColumn("lk", F.when(F.col("id") == 1, "x")),
                                [("L", "name", "lk")]))
    assert lq == [("L", 1, 1)]
    assert tuple(dq.rowcount_preserved(df, df.union(df)).first()) == (3, 6, 3)
    assert dq.schema_report(df).count() == 3


def test_distinct_count_counts_null(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",)], "c string")
    assert ag.distinct_count(df, "c").first()[0] == 2
    assert ag.distinct_count(df, "c", count_null=False).first()[0] == 1


def test_merge_without_time_refuses_duplicate_source_keys(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    s = spark.createDataFrame([(1, "b"), (1, "c")], "k int, v string")
    with pytest.raises(ValueError):
        mg.merge_upsert(t, s, "k")


def test_finish_closes_the_run_and_config_once(spark):
    schema = ("LogID string, ParentRunID string, PipelineConfigID int, RunStatus string, "
              "StartTime timestamp_ntz, EndTime timestamp_ntz, DurationSeconds int, ErrorMessage string")
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 1)
    log = spark.createDataFrame([("l1", "r", 1, "Running", t0, None, None, None)], schema)
    done = spark.createDataFrame([("r", 1, "Succeeded", t1, None)],
                                 "ParentRunID string, PipelineConfigID int, RunStatus string, "
                                 "EndTime timestamp_ntz, ErrorMessage string")
    row = mg.run_log_finish(log, done).collect()
    assert [(r.RunStatus, r.DurationSeconds) for r in row] == [("Succeeded", 60)]
    with pytest.raises(ValueError):
        mg.run_log_finish(log, done.unionByName(done))


def test_repeated_probe_keeps_one_control_row(spark):
    wm = spark.createDataFrame([("d", 1, None)], "DatasetName string, LastWatermarkValue int, UpdatedAt int")
    probes = spark.createDataFrame([("d", 2), ("d", 5)], "DatasetName string, CurrentWatermark int")
    assert [tuple(r) for r in mg.advance_watermark(wm, probes, 9).collect()] == [("d", 5, 9)]


def test_latest_run_lasts_until_its_last_end(spark):
    from hearth.operators.measures import latest_run_duration
    h = lambda m: dt.datetime(2024, 1, 1, 10, m)
    schema = "ParentRunID string, StartTime timestamp_ntz, EndTime timestamp_ntz"
    rows = [("a", h(0), h(50)), ("b", h(5), h(20)), ("b", h(6), None), ("c", None, h(59))]
    one = latest_run_duration(spark.createDataFrame(rows, schema)).first()
    assert tuple(one) == ("b", 15.0)
    tie = latest_run_duration(spark.createDataFrame(
        [("a", h(0), h(9)), ("z", h(0), h(3))], schema)).first()
    assert tuple(tie) == ("z", 3.0)
    opened = latest_run_duration(spark.createDataFrame([("a", h(0), None)], schema)).first()
    assert opened.LatestRunDurationMinutes is None


def test_bucketed_table_keeps_its_bucket_count_and_refuses_null_keys(spark):
    path = fresh_subdir(spark, "buckets") + "/t"
    frame = spark.createDataFrame([(1, "a")], "k int, v string")
    mg.BucketedTable(spark, path, "k", 4).upsert(frame)
    with pytest.raises(ValueError):
        mg.BucketedTable(spark, path, "k", 8)
    with pytest.raises(ValueError):
        mg.BucketedTable(spark, path, "k", 4).upsert(spark.createDataFrame([(None, "b")], frame.schema))


def test_by_outcome_overrides_the_outcome_group(spark):
    from hearth.operators.measures import by_outcome
    star = spark.createDataFrame(
        [(1, "Granted", 3), (1, "Refused", 1), (1, "Other", 2), (2, "Other", 5)],
        "Year int, DecisionOutcome string, ApplicationCount int")
    assert rows(by_outcome(star, ["Year"])) == sorted([
        (1, "Granted", 3, 3, 1, 0.75), (1, "Refused", 1, 3, 1, 0.75), (1, "Other", 2, 3, 1, 0.75),
        (2, "Other", 5, None, None, None)], key=lambda t: tuple(str(x) for x in t))


def test_incremental_load_skips_without_newer_rows(spark):
    import datetime
    from hearth.plans import planning as pl
    day = datetime.datetime(2024, 1, 1)
    app = spark.createDataFrame([(day,)], "RecordLastUpdatedAt timestamp_ntz")
    marks = spark.createDataFrame([("orders", day)],
                                  "DatasetName string, LastWatermarkValue timestamp_ntz")
    target = spark.range(3)
    got, after = pl.incremental_load({"PlanningApplication": app}, target, marks, "orders",
                                     "2024-01-02", "2024-01-02 00:00:00")
    assert got is target and after is marks


def test_one_pass_checks_on_empty_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "k int, v string")
    assert rows(dq.profile(empty, ["k"], ["v"])) == [("DuplicateKeys", 0), ("Null v", 0),
                                                     ("RowCount", 0)]
    df = spark.createDataFrame([(1, None), (1, "a"), (None, "b"), (None, None)], "k int, v string")
    assert rows(dq.profile(df, ["k"], ["v"])) == [("DuplicateKeys", 2), ("Null v", 2),
                                                  ("RowCount", 4)]


def test_report_order(spark):
    """SO1, SO2, SO5, RQ14: the row order itself."""
    from hearth.plans import reports as rq
    fact = spark.createDataFrame([(1, 5.0), (2, 9.0), (0, 9.0)], "CountyKey int, SalePrice double")
    dim = spark.createDataFrame([(0, "B"), (1, "A"), (2, "C")], "CountyKey int, CountyName string")
    assert [r.CountyName for r in rq.price_by_county(fact, dim).collect()] == ["B", "C", "A"]
    years = spark.createDataFrame([(1, 2012), (2, 2010), (0, 2011)], "DateKey int, Year int")
    by_year = rq.price_by_year(fact.withColumnRenamed("CountyKey", "DateKey"), years)
    assert [r.Year for r in by_year.collect()] == [2010, 2011, 2012]
