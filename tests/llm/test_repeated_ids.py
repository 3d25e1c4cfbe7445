"""Many rows under one identifier."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearth.llm import substring_dedup as sub
from hearth.llm import toxicity
from tests.llm import brute
from tests.llm.test_edges import documents, expected, rows_of


def test_substring_of_many_rows_under_one_identifier(spark):
    # 1200 texts: 15 bits would take some of them for one
    texts = [(7, " ".join(f"u{k}x{j}" for j in range(k % 40)) + " a b c d e f g h i j k l m" * (k % 3))
             for k in range(1200)] + [(1, "a b c d e f g h i j k l m"), (8, "a b c d e f g h i j k l m n")]
    found = sub.substring_dedup(documents(spark, texts).repartition(5))
    found = found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("k"))
    assert rows_of(found, *found.columns) == expected(brute.repeats(texts))


def test_toxicity_learns_from_one_row_of_each_identifier(spark):
    base = [(k, ("you are a blorg " if k % 3 == 0 else "what a fine day ") + f"w{k}") for k in range(60)]
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(60)], "doc_id long, toxic int")
    hot = [(3, f"you are a blorg v{k % 40}") for k in range(400)]
    least = {r["text"] for r in documents(spark, hot + [base[3]]).orderBy(F.xxhash64(F.col("text").cast("binary")))
             .limit(1).collect()}
    one = [(i, t) for i, t in base if i != 3] + [(3, t) for t in least]

    def weights(texts):
        return rows_of(toxicity.train_toxicity(documents(spark, texts).repartition(6), labels, l1=0.1),
                       "index", "weight")

    assert weights(base + hot) == weights(one)


def test_a_worker_forgets_words_without_harm(monkeypatch):
    import pyarrow as pa
    import public_tokenizers

    from hearth.llm import token_files

    monkeypatch.setattr(token_files, "REMEMBERED", 40)
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        encoder = token_files.WordTokens(f.read())
    texts = [f"Word{k % 7} other, {k} THE the. x{k * k}! word{k % 7}" for k in range(60)]
    whole = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    for k in range(0, 60, 5):
        for got, e in zip(encoder.encode(pa.array(texts[k:k + 5])), whole[k:k + 5], strict=True):
            assert np.frombuffer(got, "<u4").tolist() == e.ids
    assert len(encoder.known) + len(encoder.older) < 120


@pytest.mark.parametrize("doc_id", [7, None])
def test_many_rows_under_one_identifier(spark, doc_id):
    """Rows of one identifier are dealt by text and place: ids unchanged, no part holds most of them."""
    from hearth.llm.token_files import read_token_files, write_token_files
    from hearth.llm.queries import END_ID, WORD_TOKENIZER
    from hearth.session import fresh_subdir
    rows = [(doc_id, f"text {k % 500}") for k in range(4000)] + [(k, f"own {k}") for k in range(100, 300)]
    path = fresh_subdir(spark, "tokens")
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")          # as with partitions of a size
    try:
        write_token_files(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), path,
                          WORD_TOKENIZER, END_ID)
    finally:
        spark.conf.set(merge, "true")
    got = [tuple(r) for r in read_token_files(spark, path).select("doc_id", "start", "n_tokens").collect()]
    assert len(got) == len(rows) and sorted(r[1] for r in got)[0] == 0
    at = sorted(got, key=lambda r: r[1])
    assert all(a[1] + a[2] == b[1] for a, b in zip(at, at[1:]))
    assert [r[0] for r in at if r[0] != doc_id] == list(range(100, 300))
    parts = [r["n"] for r in spark.read.parquet(f"{path}/blocks").selectExpr(
        "shard", "size(doc_ids) as k").groupBy("shard").sum("k").toDF("shard", "n").collect()]
    assert max(parts) < 0.4 * len(rows)


def test_equal_rows_ask_once(spark):
    """Copies of a row, and other texts under its identifier, against brute force."""
    from hearth.llm.substring_dedup import substring_dedup
    base = " ".join(f"w{k}" for k in range(60))
    rows = [(5, base)] * 800 + [(5, f"{base} tail {k}") for k in range(40)] + [(3, "x " + base), (9, base + " y")]
    rows += [(None, base)] * 3 + [(11, f"own {k}") for k in range(2)]
    last = 10**18
    expected = sorted(brute.repeats([(last if i is None else i, t) for i, t in rows]))
    got = sorted((last if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_removed"],
                  hashlib.sha256(r["kept"].encode()).hexdigest()) for r in substring_dedup(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect())
    assert got == expected
