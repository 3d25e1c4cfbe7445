"""The toxicity classifier against a plain FTRL-proximal, weight by weight and score by score."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from hearth.llm import toxicity
from hearth.llm.queries import held_out
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def plain(spark, docs, labels, bits, **options):
    """Weights over rows in the order that the sample has."""
    order = {r[0]: r[1] for r in spark.createDataFrame([(i,) for i, _ in docs], "i long").select(
        "i", F.xxhash64("i", F.lit(1))).collect()}
    rows = [(brute.toxic_features(t, bits), labels[i]) for i, t in sorted(docs, key=lambda d: order[d[0]])
            if i in labels]
    return brute.ftrl_weights(rows, **options)


def check(found, weights):
    assert {i for i, w in found.items() if abs(w) > 1e-9} == {i for i, w in weights.items() if abs(w) > 1e-9}
    assert all(math.isclose(found[i], weights[i], rel_tol=1e-6, abs_tol=1e-9) for i in weights if i in found)


@pytest.mark.parametrize("bits, options", [
    (20, {"epochs": 3, "alpha": 2.0, "beta": 1.0, "l1": 4.0, "l2": 0.1}),
    (8, {"epochs": 2, "alpha": 0.5, "beta": 0.3, "l1": 0.2, "l2": 1.0}),
    (12, {"epochs": 1, "alpha": 1.0, "beta": 1.0, "l1": 0.0, "l2": 0.0})])
def test_weights_and_scores(spark, bits, options):
    rng = random.Random(bits)
    docs = [(i, " ".join(rng.choice(["you", "idiot", "Nice", "day,", "été", "x", "fool!"][:7 if i % 2 else 5])
                         for _ in range(rng.randrange(25)))) for i in range(150)]
    labels = {i: i % 2 for i, _ in docs if i % 7}
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    known = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    trained = toxicity.train_toxicity(frame, known, bits=bits, **options)
    found = {r["index"]: r["weight"] for r in trained.collect()}
    weights = plain(spark, docs, labels, bits, **options)
    check(found, weights)
    scores = {r["doc_id"]: r["s"] for r in frame.select(
        "doc_id", toxicity.toxicity_score(trained, F.col("text"), bits).alias("s")).collect()}
    for i, t in docs:
        total = sum(weights.get(k, 0.0) for k in brute.toxic_features(t, bits))
        assert math.isclose(scores[i], 1 / (1 + math.exp(-total)), rel_tol=1e-6)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_query_scores(spark):
    """Every score of the registered query, held-out rows not learnt from."""
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    given = spark.read.parquet(f"{SF}/labels.parquet")
    labels = {r["doc_id"]: r["toxic"] for r in given.where(~held_out()).collect() if r["toxic"] is not None}
    weights = plain(spark, docs, labels, 20, epochs=3, alpha=2.0, beta=1.0, l1=4.0, l2=0.1)
    scores = {r["doc_id"]: r["score"] for r in E.queries()["op2_toxicity"](spark, SF).collect()}
    assert len(scores) == len(docs) and len(weights) > 1
    for i, t in docs:
        total = sum(weights.get(k, 0.0) for k in brute.toxic_features(t, 20))
        assert math.isclose(scores[i], 1 / (1 + math.exp(-total)), rel_tol=1e-6), i
