"""The registered queries over whole tables against brute force, a library, or
DuckDB; held-out accuracy for the classifier."""

import os

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from tests.llm import brute

SF = "/root/testdata/sf0.001"
WIDER = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
QUERIES, SQL = E.queries(), E.oracle_sql()


def connect(folder=SF):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def con():
    return connect()


@pytest.fixture(scope="module")
def docs(con):
    return con.execute("select doc_id, text from documents order by doc_id").fetchall()


def result(spark, name, *columns, folder=SF):
    return sorted(tuple(r) for r in QUERIES[name](spark, folder).select(*columns).collect())


def test_every_operator_has_one_query():
    named = [n for n in QUERIES if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in named) == list(range(1, 14))
    assert "pipeline" in QUERIES


@pytest.mark.parametrize("name", ["op1_license_scan", "op6_mixing", "op7_exact_dedup",
                                  "op11_periodic_runs", "op12_line_dedup", "op13_merkle_manifest"])
def test_sql(spark, con, name):
    cur = con.execute(SQL[name])
    columns = [d[0] for d in cur.description]
    expected = sorted(map(repr, cur.fetchall()))
    rows = QUERIES[name](spark, SF).select(*columns).collect()
    assert sorted(repr(tuple(r)) for r in rows) == expected


def test_licenses_are_found(spark, con):
    found = QUERIES["op1_license_scan"](spark, WIDER).where("licenses <> ''").count()
    n = connect(WIDER).execute("select count(*) from documents where text ilike '%licensed under%' "
                               "or text ilike '%released under the mit license%'").fetchall()[0][0]
    assert found == n > 0


def test_toxicity_on_held_out_rows(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op2_toxicity"](spark, WIDER).collect()}
    con = connect(WIDER)
    assert len(rows) == con.execute("select count(*) from documents").fetchall()[0][0]
    labels = dict(con.execute("select doc_id, toxic from labels").fetchall())
    held = [i for i in labels if i in rows and rows[i]["held_out"]]
    toxic = [rows[i]["score"] for i in held if labels[i]]
    clean = [rows[i]["score"] for i in held if not labels[i]]
    pairs = [(a > b) + (a == b) / 2 for a in toxic for b in clean]
    assert sum(pairs) / len(pairs) > 0.85        # 280 rows to learn from
    assert sum((rows[i]["predicted"] == 1) == bool(labels[i]) for i in held) / len(held) > 0.9
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows.values())


def test_simhash(spark, docs):
    assert result(spark, "op3_simhash", "doc_id", "fingerprint", "component_id") == sorted(
        brute.near_components(docs))


def test_token_files(spark, docs):
    assert result(spark, "op4_token_files", "doc_id", "start", "n_tokens", "ids_crc32") == sorted(
        brute.token_starts(docs))


def test_byte_bpe(spark, docs):
    expected = [(i, *x) for (i, _), x in zip(docs, brute.byte_bpe([t for _, t in docs]), strict=True)]
    assert result(spark, "op5_byte_bpe", "doc_id", "n_tokens", "ids_sha256",
                  "decoded_sha256") == sorted(expected)


def test_substring_dedup(spark, docs):
    assert result(spark, "op9_substring_dedup", "doc_id", "n_words", "n_removed",
                  "kept_sha256") == sorted(brute.repeats(docs))


def test_lattice_dedup(spark, con):
    rows = con.execute("select vec_id, embedding from embeddings order by vec_id").fetchall()
    assert result(spark, "op10_lattice_dedup", "vec_id", "n_links", "component_id") == sorted(
        brute.embedding_links(rows))


def test_pipeline_stage_by_stage(spark, con):
    """Each stage against brute force on what its predecessor kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scores = {r["doc_id"]: r["predicted"] for r in QUERIES["op2_toxicity"](spark, SF).collect()}
    stages = dict(corpus_pipeline.STAGES)
    kept = [tuple(r) for r in stages["toxicity"](spark, docs, SF).collect()]
    assert {r[0] for r in kept} == {i for i, p in scores.items() if not p}

    def frame(rows):
        return spark.createDataFrame(rows, docs.schema)

    one = [tuple(r) for r in stages["exact_dedup"](spark, frame(kept), SF).collect()]
    assert {r[0] for r in one} == {i for i, k, *_ in brute.exact([r[:2] for r in kept]) if i == k}
    near = [tuple(r) for r in stages["simhash_dedup"](spark, frame(one), SF).collect()]
    assert {r[0] for r in near} == {i for i, _, c in brute.near_components([r[:2] for r in one])
                                    if i == c}
    mixed = [tuple(r) for r in stages["mixing"](spark, frame(near), SF).collect()]
    sources = sorted({r[3] for r in near})
    sizes = [sum(len(brute.words(r[1])) for r in near if r[3] == s) for s in sources]
    for s, target in zip(sources, brute.water_levels(sizes), strict=True):
        assert abs(sum(len(brute.words(r[1])) for r in mixed if r[3] == s) - target) <= 1
    last = sorted(tuple(r) for r in stages["byte_bpe"](spark, frame(mixed), SF).collect())
    assert last == sorted((r[0], *x) for r, x in zip(
        mixed, brute.byte_bpe([r[1] for r in mixed]), strict=True))
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).collect()) == last
