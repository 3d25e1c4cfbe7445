import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from hearth.operators import dims as od
from hearth.operators.keys import (hash_key, latest_per_key, sequential_keys, stable_keys,
                                   with_unknown_member)
from hearth.plans import sales as sl
from tests.conftest import rows


def test_sequential_keys_dense_and_ordered(spark):
    df = spark.range(0, 5000, 1, 7).select(((F.col("id") * 7919) % 5000).cast("string")
                                           .alias("v"))
    k = sequential_keys(df, ["v"], key="k")
    got = [(r.v, r.k) for r in k.collect()]
    assert sorted(x[1] for x in got) == list(range(1, 5001))
    ref = df.withColumn("k", F.row_number().over(Window.orderBy("v")))
    assert sorted(got) == sorted((r.v, r.k) for r in ref.collect())


def test_stable_keys_keep_old_members(spark):
    existing = spark.createDataFrame([(1, "Cork"), (2, "Mayo")], "k int, name string")
    values = spark.createDataFrame([("Carlow",), ("Cork",), ("Wexford",)], "name string")
    out = rows(stable_keys(existing, values, "k", ["name"]), ["k"])
    # a new value sorting before old ones must not renumber them (S6)
    assert out == [(1, "Cork"), (2, "Mayo"), (3, "Carlow"), (4, "Wexford")]


def test_unknown_member_and_value_dim(spark):
    g = spark.createDataFrame([("b",), (None,), ("a",), ("b",)], "County string")
    d = od.dim_from_values(g, "County", "CountyKey", name="CountyName")
    assert rows(d, ["CountyKey"]) == [(0, "Not recorded"), (1, "a"), (2, "b")]
    u = with_unknown_member(spark.createDataFrame([(5, "x")], "k int, n string"), {"k": 0})
    assert rows(u, ["k"]) == [(0, None), (5, "x")]


def test_latest_per_key_keeps_null_keys_and_newest(spark):
    df = spark.createDataFrame(
        [(1, 10, "old"), (1, 20, "new"), (2, 5, "only"), (None, 1, "n1"), (None, 2, "n2")],
        "k int, ts int, v string")
    out = rows(latest_per_key(df, "k", "ts"))
    assert out == sorted([(1, 20, "new"), (2, 5, "only"), (None, 1, "n1"), (None, 2, "n2")],
                         key=lambda t: tuple(str(x) for x in t))


def test_hash_key_is_stable(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "x string, y int")
    h = [r[0] for r in df.select(hash_key("x", "y")).collect()]
    assert h[0] == h[1] != h[2]


def test_calendar_and_dim_date(spark):
    c = od.calendar(spark)
    assert c.count() == 7670
    d = od.dim_date(spark, "2024-02-28", "2024-03-01")
    assert rows(d, ["DateKey"]) == [
        (20240228, dt.date(2024, 2, 28), 2024, 1, 2, "February"),
        (20240229, dt.date(2024, 2, 29), 2024, 1, 2, "February"),
        (20240301, dt.date(2024, 3, 1), 2024, 1, 3, "March")]


def test_dim_from_source_ids_first_per_key(spark):
    g = spark.createDataFrame([(2, "zeta"), (2, "alpha"), (None, "x"), (1, "one")],
                              "id int, name string")
    d = od.dim_from_source_ids(g, "id", "Key", [("name", "Name")],
                               unknown={"Key": 0, "Name": "Not recorded"})
    assert rows(d, ["Key"]) == [(0, "Not recorded"), (1, "one"), (2, "alpha")]


def test_sequential_keys_grouped(spark):
    df = spark.range(0, 3000, 1, 5).select(
        (F.col("id") % 3).alias("g"), ((F.col("id") * 7919) % 3000).alias("v"))
    k = sequential_keys(df, ["v"], key="k", partition_by=["g"])
    ref = df.withColumn("k", F.row_number().over(Window.partitionBy("g").orderBy("v")))
    assert rows(k.select("g", "v", "k")) == rows(ref.select("g", "v", "k"))


def test_dims_from_values_one_pass(spark):
    g = spark.createDataFrame([("b", "x"), (None, "y"), ("a", "x")], "c string, t string")
    dc, dt_ = od.dims_from_values(g, [("c", "CKey", "CName"), ("t", "TKey", "TName")])
    assert rows(dc, ["CKey"]) == [(0, "Not recorded"), (1, "a"), (2, "b")]
    assert rows(dt_, ["TKey"]) == [(0, "Not recorded"), (1, "x"), (2, "y")]


def test_value_dim_keeps_stored_keys(spark):
    first = od.dim_from_values(spark.createDataFrame([("Cork",), ("Mayo",)], "c string"), "c", "k")
    g = spark.createDataFrame([("Carlow",), ("Mayo",), (None,), ("Cork",)], "c string")
    assert rows(od.dim_from_values(g, "c", "k", existing=first), ["k"]) == [
        (0, "Not recorded"), (1, "Cork"), (2, "Mayo"), (3, "Carlow")]


def test_row_key_names_one_row(spark):
    cols = sl.NATURAL_KEY
    same = tuple("x" for _ in cols)
    g = spark.createDataFrame([same, same, ("y",) + same[1:]], ", ".join(f"{c} string" for c in cols))
    got = sl.with_row_key(g).select("PropertySaleKey", "PropertySaleOrdinal").collect()
    assert len(set(got)) == 3 and sorted(r[1] for r in got) == [1, 1, 2]
