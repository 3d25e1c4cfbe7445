"""Facts over tables built here: counties come from the sales, lookups are small to
the planner."""

import re

import pytest

from hearth.plans import catalog
from hearth.sources import standins as st
from tests.conftest import rows

# regions 0 and 1: their counties are named after nations 3 and 5
NATIONS = [(3, "KENYA", 0), (4, "CHAD", 0), (5, "PERU", 1), (6, "BRAZIL", 1)]


def write(spark, base, **tables):
    for name, (data, schema) in tables.items():
        df = spark.createDataFrame(data, schema) if isinstance(data, list) else data
        df.coalesce(1).write.parquet(f"{base}/{name}.parquet")
    return str(base)


def sales(spark, tmp_path, *sold):
    """Orders 0 to 3, one in each nation, in two quarters; those in ``sold`` have a sale."""
    orders = [(k, k, "F" if k % 2 else "O", 100.0, f"1998-0{1 + k}-05 00:00:00", "1-URGENT") for k in range(4)]
    cast = spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, "
                                         "o_totalprice double, d string, o_orderpriority string")
    return write(
        spark, tmp_path,
        nation=(NATIONS, "n_nationkey int, n_name string, n_regionkey int"),
        customer=([(k, f"C{k}", 3 + k, 1.0, "FURNITURE") for k in range(4)],
                  "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        orders=(cast.selectExpr("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                "cast(d as timestamp_ntz) as o_orderdate", "o_orderpriority"), None),
        lineitem=([(k, 1, 1234.5, "N", "O") for k in sold],
                  "l_orderkey long, l_partkey long, l_extendedprice double, l_returnflag string, "
                  "l_linestatus string"),
        part=([(1, "B", "PROMO", 20)], "p_partkey long, p_brand string, p_type string, p_size int"))


def keys(spark, sf, name):
    got = catalog.QUERIES[name](spark, sf)
    return rows(got.select("QuarterKey", "CountyKey", "HousingVacancyKey", "DwellingStock"),
                ["QuarterKey", "CountyKey"])


@pytest.mark.parametrize("name", ["fact_vacancy", "warehouse_fact_vacancy"])
def test_the_fact_has_the_keys_of_the_sales_counties(spark, tmp_path, name):
    """BRAZIL, CHAD, KENYA and PERU are 1 to 4, though only two are counties of the fact."""
    assert keys(spark, sales(spark, tmp_path, 0, 1, 2, 3), name) == [
        (19981, 3, 1998103, 2), (19981, 4, 1998104, 1), (19982, 4, 1998204, 1)]


def test_a_county_without_sales_has_no_key(spark, tmp_path):
    """BRAZIL, CHAD and PERU are 1 to 3."""
    assert keys(spark, sales(spark, tmp_path, 1, 2, 3), "fact_vacancy") == [
        (19981, None, None, 2), (19981, 3, 1998103, 1), (19982, 3, 1998203, 1)]


JOINED = ["planning_denormalised", "planning_gold", "incremental_planning"]


@pytest.mark.parametrize("name", JOINED)
def test_applications_are_not_dealt_by_a_code(spark, tmp_path, capsys, name):
    """Lookups far under the broadcast threshold are never joined by a shuffle of the
    applications, however large ``orders`` and ``customer`` are."""
    n = 6000
    orders = spark.range(n).selectExpr(
        "id as o_orderkey", "id * 7919 % 3000 as o_custkey", "substring('FOP', cast(id % 3 as int) + 1, 1) "
        "as o_orderstatus", "id * 1.25d as o_totalprice",
        "timestamp_ntz'1996-01-01' + make_interval(0, 0, 0, cast(id % 900 as int)) as o_orderdate",
        "concat(id % 5 + 1, '-', sha2(string(id % 5), 256)) as o_orderpriority")
    customer = spark.range(3000).selectExpr(
        "id as c_custkey", "sha2(string(id), 256) as c_name", "cast(id % 4 + 3 as int) as c_nationkey",
        "1.0d as c_acctbal", "concat('S', id % 5) as c_mktsegment")
    base = write(spark, tmp_path, orders=(orders, None), customer=(customer, None),
                 nation=(NATIONS, "n_nationkey int, n_name string, n_regionkey int"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "6k")
    try:
        x = st.planning_extracts(spark, base)
        catalog.pl.join_extracts(x).explain("formatted")
        plan = capsys.readouterr().out
        got = catalog.QUERIES[name](spark, base)
        assert got.count() == n
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    joins = re.findall(r"SortMergeJoin LeftOuter.*?Left keys \[1\]: \[(\w+)#", plan, re.S)
    assert set(joins) == {"o_custkey"}
    assert plan.split("\n\n")[0].count("SortMergeJoin") == 1
