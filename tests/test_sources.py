"""Readers and the sales silver build on hand-made files (S2, S4)."""

import os
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException

from hearth.plans import sales as sl
from hearth.session import fresh_subdir, shared_dir
from hearth.sources import readers

HEADER = ("Date of Sale (dd/mm/yyyy),Address,County,Eircode,Price (€),"
          "Not Full Market Price,VAT Exclusive,Description of Property,"
          "Property Size Description\n")


def write_cp1252(path, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "ppr.csv"), "wb") as f:
        f.write((HEADER + "".join(lines)).encode("cp1252"))


def test_windows_1252_file_read_as_latin1(spark):
    path = fresh_subdir(spark, "csv-test")
    write_cp1252(path, ['05/01/2020,1 Sráid Mhór,Dún Laoghaire,A96,"€350,000.00",No,No,'
                        'Teach/Árasán Cónaithe Atháimhe,\n'])
    raw = readers.read_csv_snapshot(spark, path)
    r = raw.first()
    assert r["Address"] == "1 Sráid Mhór"                 # accents survive
    silver = sl.silver_sales(raw, "2024-06-30 00:00:00").first()
    assert silver.SalePrice == Decimal("350000.00")          # stray € byte stripped
    assert silver.PropertyType == "Second-Hand Dwelling house /Apartment"
    assert silver.IsFullMarketPrice == "Yes"


def test_same_sale_in_two_languages_dedup_order(spark):
    path = fresh_subdir(spark, "csv-test")
    row = '05/01/2020,1 Main St,Cork,T12,"€200,000.00",No,No,{},\n'
    write_cp1252(path, [row.format("Second-Hand Dwelling house /Apartment"),
                        row.format("Teach/Árasán Cónaithe Atháimhe")])
    raw = readers.read_csv_snapshot(spark, path)
    # default (source pipeline order): dedup first, so both rows survive
    assert sl.silver_sales(raw, "2024-06-30 00:00:00").count() == 2
    # normalise first: one sale described in two languages collapses
    assert sl.silver_sales(raw, "2024-06-30 00:00:00", normalise_first=True).count() == 1


def test_bronze_path_and_dated_extracts(spark):
    base = fresh_subdir(spark, "extract-test")
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    df.write.parquet(readers.bronze_path(base, "T", "2024-06-30"))
    spark.createDataFrame([(2, "b")], "id int, name string").write.parquet(
        readers.bronze_path(base, "T", "2024-06-29"))
    got = readers.read_parquet_extract(spark, base, "T", "2024-06-30").collect()
    assert [tuple(r) for r in got] == [(1, "a")]
    assert readers.bronze_path("/x", "s", "2024-01-02") == "/x/s/load_date=2024-01-02"


def test_an_asked_for_load_date_must_be_there(spark):
    base = fresh_subdir(spark, "extract-test")
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    df.write.parquet(readers.bronze_path(base, "dated", "2024-06-30"))
    df.write.parquet(f"{base}/plain")
    for name, day in (("dated", "2024-06-29"), ("plain", "2024-06-30")):
        with pytest.raises(AnalysisException):
            readers.read_parquet_extract(spark, base, name, day).count()


def test_stage_tables_need_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Cluster:
        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError):
        shared_dir(Cluster())
    assert shared_dir(spark)


def test_inline_rows(spark):
    from hearth.sources.readers import inline_rows
    assert [tuple(r) for r in inline_rows(spark, [(1, "a"), (None, None)], "k INT, v STRING")
            .collect()] == [(1, "a"), (None, None)]
    empty = inline_rows(spark, [], "k INT, v STRING")
    assert empty.columns == ["k", "v"] and empty.count() == 0
