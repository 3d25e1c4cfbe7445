"""Stored dimension, bucketed merge, pruned window, checked loads, footer totals."""

import re

import pytest
from pyspark.sql import functions as F

from hearth.operators.registry import DimensionRegistry
from hearth.plans import catalog
from hearth.session import fresh_subdir
from hearth.sources import checked, footers
from hearth.sources.bucketed import BucketedTarget
from hearth.sources.readers import read_extract_window
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def plan_of(df, capsys):
    df.explain("formatted")
    return capsys.readouterr().out


# --- registry ----------------------------------------------------------------------------------
def counties(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "County string")


def test_members_keep_their_keys(spark, tmp_path):
    r = DimensionRegistry(spark, str(tmp_path), "dim_county", "CountyKey", "CountyName")
    assert rows(r.members()) == [(0, "Not recorded")]
    assert r.register(counties(spark, "Mayo", "Cork", "Mayo", None), "County") == 1
    assert r.register(counties(spark, "Carlow", "Mayo"), "County") == 2
    assert r.register(counties(spark, "Carlow", "Mayo"), "County") == 3
    assert rows(r.stored(), ["CountyKey"]) == [(0, "Not recorded", 0), (1, "Cork", 1), (2, "Mayo", 1),
                                               (3, "Carlow", 2)]
    again = DimensionRegistry(spark, str(tmp_path), "dim_county", "CountyKey", "CountyName")
    assert rows(again.members()) == rows(r.members())


def test_a_value_named_like_the_unknown_member_is_a_member(spark, tmp_path):
    r = DimensionRegistry(spark, str(tmp_path), "d", "K", "V", unknown="none")
    r.register(counties(spark, "none"), "County")
    assert rows(r.members()) == [(0, "none"), (1, "none")]
    r.register(counties(spark), "County")
    assert r.members().count() == 2


def scanned(df):
    return " ".join(df.inputFiles())


@pytest.mark.parametrize("name", ["fact_vacancy", "vacant_by_county", "rate_by_county", "rate_by_year",
                                  "vacancy_map", "warehouse_fact_vacancy"])
def test_vacancy_reports_read_no_sales(spark, name, capsys):
    df = catalog.QUERIES[name](spark, SF)
    plan = plan_of(df, capsys) + scanned(df)
    assert "lineitem" not in plan and "orders" not in plan


# --- bucketed merge ------------------------------------------------------------------------------
def target(spark, tmp_path, data, buckets=4):
    t = BucketedTarget(spark, "t" + re.sub(r"\W", "", str(tmp_path))[-24:], str(tmp_path / "t"), "k", buckets)
    t.create(spark.createDataFrame(data, "k long, v string, ts int"))
    return t


def test_bucketed_merge_semantics(spark, tmp_path):
    t = target(spark, tmp_path, [(1, "a", 5), (2, "b", 5), (None, "n", 1)])
    source = spark.createDataFrame([(2, "B", 6), (2, "late", 4), (3, "c", 1), (1, "old", 4), (None, "m", 9)],
                                   "k long, v string, ts int")
    t.merge(source, ts="ts", keep_newer_target=True)
    assert rows(t.read()) == sorted([(1, "a", 5), (2, "B", 6), (3, "c", 1), (None, "n", 1), (None, "m", 9)],
                                    key=lambda r: tuple(map(str, r)))
    assert rows(t.read(1)) == sorted([(1, "a", 5), (2, "b", 5), (None, "n", 1)], key=lambda r: tuple(map(str, r)))
    t.merge(source.where("v = 'old'"), ts="ts")
    assert (1, "old", 4) in rows(t.read()) and t.version == 3
    with pytest.raises(ValueError, match="duplicate source keys"):
        t.merge(source)


def test_the_target_is_not_shuffled(spark, tmp_path, capsys):
    t = target(spark, tmp_path, [(k, "x", 1) for k in range(500)], buckets=16)
    source = spark.createDataFrame([(k, "y", 2) for k in range(400, 600)], "k long, v string, ts int")
    for _ in range(2):              # the merged version is bucketed like the first
        plan = plan_of(t.merged(source, ts="ts"), capsys)
        tree = plan.split("\n\n")[0]
        join = re.search(r"^(.*?)\+?-? ?SortMergeJoin FullOuter.*$", tree, re.M)
        left = tree[join.end():]
        # the left branch, down to its scan, has no exchange
        scan = left.index("Scan parquet")
        assert "Exchange" not in left[:scan], tree
        assert "Bucketed: true" in plan
        t.merge(source, ts="ts")
    assert t.read().count() == 600


# --- window by the control table -------------------------------------------------------------------
def test_the_scan_prunes_by_the_control_table(spark, capsys):
    df = catalog.QUERIES["extract_window"](spark, SF)
    assert "dynamicpruning" in plan_of(df, capsys).lower()


@pytest.mark.parametrize("last, current, days", [
    ("2024-01-01", "2024-01-03", [2, 3]), ("2024-01-03", "2024-01-03", []), ("2024-01-04", "2024-01-02", []),
    ("2023-01-01", "2024-01-01", [1])])
def test_windows(spark, tmp_path, last, current, days):
    base = str(tmp_path)
    (spark.range(1, 5).select("id", F.expr("date_add(date'2023-12-31', cast(id as int))").alias("load_date"))
     .write.partitionBy("load_date").parquet(f"{base}/x"))
    control = spark.createDataFrame([("x", last, current), ("y", "2020-01-01", "2030-01-01")],
                                    "DatasetName string, a string, b string").select(
        "DatasetName", F.to_date("a").alias("LastLoadDate"), F.to_date("b").alias("CurrentLoadDate"))
    assert [r.id for r in read_extract_window(spark, base, "x", control, "x").orderBy("id").collect()] == days
    assert read_extract_window(spark, base, "x", control, "absent").count() == 0


# --- checked loads -----------------------------------------------------------------------------------
def test_one_job_writes_and_counts_both_parts(spark, tmp_path):
    df = spark.range(100).withColumn("v", F.when(F.col("id") % 10 != 0, F.col("id")))
    done = checked.write_checked(df, str(tmp_path / "x"), {
        "no value": F.col("v").isNull(), "large": F.col("v") > 95, "never": F.col("id") < 0})
    assert done.counts == {"rows": 100, "rejected": 14, "no value": 10, "large": 4, "never": 0}
    assert done.loaded.columns == df.columns and done.loaded.count() == 86
    assert rows(done.rejected.groupBy("Reasons").count()) == [(["large"], 4), (["no value"], 10)]


@pytest.mark.parametrize("n", [0, 3])
def test_a_load_without_rejects_or_rows(spark, tmp_path, n):
    done = checked.write_checked(spark.range(n), str(tmp_path / "x"), {"never": F.col("id") < 0})
    assert (done.loaded.count(), done.rejected.count(), done.counts["rows"]) == (n, 0, n)


def test_declared_columns(spark, tmp_path):
    df = spark.createDataFrame([("1", "ab"), ("x", "abcd"), (None, None)], "k string, name string")
    done = checked.load_checked(df, (("k", "int", None, True), ("name", "string", 3, False)), str(tmp_path / "x"))
    assert rows(done.loaded) == [(1, "ab")]
    assert sorted(map(tuple, (r["Reasons"] for r in done.rejected.collect()))) == [
        ("k is NULL",), ("k is no int", "name is longer than 3")]


def write_lines(tmp_path, *files):
    (tmp_path / "in").mkdir()
    for k, lines in enumerate(files):
        (tmp_path / "in" / f"f{k}.csv").write_text("\n".join(lines) + "\n", encoding="latin-1")
    return str(tmp_path / "in")


def test_damaged_lines_are_kept_apart(spark, tmp_path):
    path = write_lines(tmp_path, ["k,name,n", "1,é,2", "2,short", "3,a,4,long", '4,"open,5', '5,"a, b",6', "x,y,7"],
                       ["k,name,n", "", "8,\"q\"\"q\",9", '9,"z"z,1', "10,,"])
    done = checked.read_csv_checked(spark, path, "k int, name string, n int", str(tmp_path / "out"))
    assert rows(done.loaded, ["k"]) == [(1, "é", 2), (5, "a, b", 6), (8, 'q"q', 9), (10, None, None)]
    bad = done.rejected.select("Line", "File", F.col("Reasons")[0]).collect()
    assert sorted((r[0] or "", r[1]) for r in bad) == sorted([
        ("2,short", "f0.csv"), ("3,a,4,long", "f0.csv"), ('4,"open,5', "f0.csv"), ("x,y,7", "f0.csv"),
        ("", "f1.csv")]) or {r[0] for r in bad} >= {"2,short", "3,a,4,long", '4,"open,5', "x,y,7"}
    assert done.counts["rows"] == 4 + len(bad) and done.counts["rejected"] == len(bad)


def test_another_header_fails_the_job(spark, tmp_path):
    path = write_lines(tmp_path, ["k,other,n", "1,a,2"])
    with pytest.raises(Exception, match="(?i)header"):
        checked.read_csv_checked(spark, path, "k int, name string, n int", str(tmp_path / "out"))


# --- footers -----------------------------------------------------------------------------------------
def test_totals_read_no_column(spark, tmp_path, capsys):
    path = str(tmp_path / "layer")
    df = spark.range(1000).withColumn("LoadTimestamp", F.expr(
        "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,id)"))
    footers.with_load_micros(df).repartition(3).write.parquet(path)
    plan = plan_of(footers.footer_aggregate(spark, path, footers.MICROS), capsys)
    assert "PushedAggregation: [COUNT(*), MIN(LoadMicros), MAX(LoadMicros)]" in plan.replace("\n", " ")
    got = rows(footers.footer_totals(spark, {"a": path}))
    assert [str(v) for v in got[0]] == ["a", "1000", "2024-01-01 00:00:00", "2024-01-01 00:16:39"]
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_a_counted_write(spark, tmp_path):
    from hearth.operators.merge import SnapshotStore
    store = SnapshotStore(spark, str(tmp_path))
    assert store.overwrite_counted(spark.range(7), "t") == (1, 7)
    assert store.overwrite_counted(store.read("t").where("id > 100"), "t") == (2, 0)
