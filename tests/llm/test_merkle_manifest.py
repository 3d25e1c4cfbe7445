"""The Merkle manifest against hashing by hand."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import __spark_entry__ as E
from hearth.llm.merkle_manifest import build_manifest, fold, leaf_paths, siblings
from tests.llm import brute

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def query(spark, tmp_path, rows, parts=3):
    path = str(tmp_path / "in")
    frame(spark, rows, parts).write.parquet(f"{path}/documents.parquet")
    got = E.queries()["op13_merkle_manifest"](spark, path).select(*COLUMNS).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute.manifest(rows)))
    return got


def test_query_over_uneven_groups(spark, tmp_path):
    sizes = {"en": 70, "de": 64, "fr": 65, "it": 1, None: 3, "": 2, "é": 130}
    rows = [(100 * k + i, f"s{i % 3}", lang, i, f"text {i}")
            for k, (lang, n) in enumerate(sizes.items()) for i in range(n)]
    got = query(spark, tmp_path, rows)
    assert any(not r["verified"] for r in got) and any(r["verified"] for r in got)


def test_query_over_defined_cases(spark, tmp_path):
    rows = [(None, None, None, None, None), (None, "", "en", 0, ""), (7, "a", "en", None, "x"),
            (7, "a", "en", 4, "x"), (7, "a", "en", 4, "x"), (7, "b", "en", 4, "é" * 9),
            (8, None, "en", 5, None), (-3, "-", "de", 1, "0:"), (9, "a", "de", 10**12, "long " * 90_000)]
    query(spark, tmp_path, rows)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_query_over_few_rows(spark, tmp_path, n):
    query(spark, tmp_path, [(k, "s", "en", k, "t") for k in range(n)])


def test_a_third_of_the_rows_alike(spark, tmp_path):
    rows = [(5, "s", "en", 1, "same")] * 700 + [(k, "s", "en", k, f"t{k}") for k in range(6, 1400)]
    query(spark, tmp_path, rows, parts=5)


def test_every_row_its_own_group(spark, tmp_path):
    query(spark, tmp_path, [(k, "s", f"lang {k:04}", k, "t") for k in range(300)])


def test_other_fans_and_asking_for_few(spark):
    rows = [(k, "s", "ab"[k % 10 == 0], k, f"t{k}") for k in range(200)]
    for fan, depth in ((3, 2), (16, 1), (2, 1)):
        m = build_manifest(frame(spark, rows), SCHEMA.replace(" long", "").replace(" string", "")
                           .split(", "), "lang", "doc_id", fan=fan, depth=depth,
                           doc_id=F.col("doc_id"))
        asked = leaf_paths(m, m.leaves.where("doc_id in (0, 17, 199)"))
        got = {r["doc_id"]: r for r in asked.withColumn("up", fold(F.col("leaf"), F.col("path")))
               .withColumn("proof", F.sha2(siblings(F.col("path")), 256)).collect()}
        assert set(got) == {0, 17, 199}
        for i, leaf, subroot, root, proof, *_ in brute.manifest(rows, fan):
            if i in got:
                r = got[i]
                assert (r["leaf"], r["found"], r["subroot"], r["root"], r["up"], r["proof"]) == (
                    leaf, leaf, subroot, root, root, proof)


def test_a_missing_page_is_an_error(spark):
    m = build_manifest(frame(spark, [(k, "s", "en", k, "t") for k in range(100)]), ["doc_id"],
                       "lang", "doc_id")
    steps = ([m.steps[0][0].where("rank <> 1"), *m.steps[0][1:]], m.steps[1])
    with pytest.raises(PySparkException, match="page of the manifest is missing"):
        leaf_paths(m._replace(steps=steps)).collect()


def test_empty_table_and_clashing_columns(spark, tmp_path):
    assert query(spark, tmp_path, []) == []
    df = frame(spark, [(1, "s", "en", 1, "t")]).withColumns(
        {"tree": F.lit(1), "rank": F.lit("x"), "LEAF": F.lit(2), "_at": F.lit(3)})
    m = build_manifest(df, ["doc_id", "lang"], "lang", "doc_id")
    assert [r["path"] for r in leaf_paths(m).collect()] == [[]]
