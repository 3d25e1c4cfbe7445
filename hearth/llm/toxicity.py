"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams.

Features are the distinct words, word pairs and skip-grams (a word and the one
after next) of a text, each hashed to one of ``2**bits`` indices, and a bias.
FTRL-proximal keeps two sums per index, gives each its own learning rate, and
its L1 term leaves only few weights that aren't zero: these are collected (at
most ``2**bits``, in practice hundreds) and broadcast to score all documents
without a shuffle.

The classifier is fitted on a bounded sample: ``sample_rows`` labelled rows (at
most twice as many) by a hash of their identifier; of rows that repeat an
identifier it holds one, the text of the smallest hash.  Only that sample's features meet in
one task, which makes ``epochs`` passes over them; scoring covers all rows.

Defined cases: a null text is empty and scores by the bias alone; null labels
and null identifiers aren't learnt from, repeated labels count as their
largest; without any label to learn from every score is 0; repeated rows score
alike; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.frames import apart, spread_sample

#: white space or ASCII punctuation separates words
SEPARATORS = bytes(32 if b < 128 and not chr(b).isalnum() else b for b in range(256))
SPREAD = np.uint64(0x9E3779B97F4A7C15)
BIAS = 0


def features(text: bytes, bits: int) -> np.ndarray:
    """Hashed words, pairs and skip-grams, not yet distinct."""
    words = text.lower().translate(SEPARATORS).split()
    h = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    pair = h[:-1] * np.uint64(0x100000001B3) + h[1:] + np.uint64(2)
    skip = h[:-2] * np.uint64(0x1000193A5) + h[2:] + np.uint64(3)
    both = np.concatenate([h + np.uint64(1), pair, skip])
    both ^= both >> np.uint64(31)
    return ((both * SPREAD) >> np.uint64(64 - bits)).astype(np.int32)


def _weights(z, n, alpha, beta, l1, l2):
    return np.where(np.abs(z) <= l1, 0.0,
                    -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))


def ftrl(rows: list[np.ndarray], labels: list[int], bits: int, epochs: int, alpha: float,
         beta: float, l1: float, l2: float) -> np.ndarray:
    """Weights after ``epochs`` passes over rows of distinct indices."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    for _ in range(epochs):
        for at, label in zip(rows, labels, strict=True):
            za, na = z[at], n[at]
            w = _weights(za, na, alpha, beta, l1, l2)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
            more = na + g * g
            z[at] = za + g - (np.sqrt(more) - np.sqrt(na)) / alpha * w
            n[at] = more
    return _weights(z, n, alpha, beta, l1, l2)


def train_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", label_col: str = "toxic", learn: Column | None = None,
                   sample_rows: int = 16384, bits: int = 20, epochs: int = 3, alpha: float = 2.0,
                   beta: float = 1.0, l1: float = 4.0, l2: float = 0.1) -> DataFrame:
    """(``index``, ``weight``) of the weights that aren't zero; the bias is always
    there if anything was learnt.  ``learn`` (over ``id_col``) picks label rows."""
    usable = F.col(id_col).isNotNull() & F.col(label_col).isNotNull()
    known = (labels.where(usable if learn is None else usable & learn)
             .groupBy(F.col(id_col).alias("_lid"))
             .agg(F.max(F.col(label_col).cast("int")).alias("_label")))
    picked = (spread_sample(known, "_lid", sample_rows)
              .withColumn("_order", F.xxhash64("_lid", F.lit(1))))
    texts = (apart(docs, id_col, text_col)[0]
             .select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))
             .join(F.broadcast(picked), F.col("_id") == F.col("_lid"))  # 2 * sample_rows ids
             .withColumn("_hash", F.xxhash64("_text")))
    # of rows that repeat an identifier the text of the smallest hash, from each task once
    least = texts.groupBy("_lid").agg(F.min("_hash").alias("_least")).withColumnRenamed("_lid", "_one")
    sample = (texts.join(F.broadcast(least), (F.col("_lid") == F.col("_one")) & (F.col("_hash") == F.col("_least")))
              .select("_order", "_label", "_text"))

    def extract(batches):
        seen = set()  # 2 * sample_rows at most
        for batch in batches:
            new = []
            for k, order in enumerate(batch.column(0).to_pylist()):
                if order not in seen:
                    seen.add(order)
                    new.append(k)
            batch = batch.take(pa.array(new, pa.int64()))
            rows = [np.unique(np.append(features(t.as_py(), bits), np.int32(BIAS)))
                    for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.int32()))],
                ["_order", "_label", "_features"])

    def fit(batches):
        rows, known = [], []
        for batch in batches:
            rows += [r.values.to_numpy() for r in batch.column(1)]
            known += batch.column(0).to_pylist()
        if rows:
            w = ftrl(rows, known, bits, epochs, alpha, beta, l1, l2)
            at = np.union1d(np.flatnonzero(w), [BIAS])
            yield pa.RecordBatch.from_arrays(
                [pa.array(at.astype(np.int32)), pa.array(w[at])], ["index", "weight"])

    return (sample.mapInArrow(extract, "_order bigint, _label int, _features array<int>")
            .dropDuplicates(["_order"]).repartition(1).sortWithinPartitions("_order", F.hash("_features"))
            .select("_label", "_features").mapInArrow(fit, "index int, weight double"))


def toxicity_score(weights: DataFrame, text: Column, bits: int = 20) -> Column:
    """Score of 0 to 1 for ``text`` by ``weights``, which are collected (one row per
    weight that isn't zero, at most ``2**bits``) and broadcast."""
    held = weights.collect()
    index = np.array([r["index"] for r in held], np.int32)
    shared = weights.sparkSession.sparkContext.broadcast(
        (index, np.array([r["weight"] for r in held], np.float64)))

    def score(batches):
        at, w = shared.value
        dense = np.zeros(1 << bits)
        dense[at] = w
        live = dense != 0
        for texts in batches:
            out = np.zeros(len(texts))
            for k, t in enumerate(texts if len(at) else ()):
                f = features(t, bits)
                f = np.unique(f[live[f]])
                out[k] = dense[f[f != BIAS]].sum() + dense[BIAS]
            yield pd.Series(1 / (1 + np.exp(-out)) if len(at) else out)

    # the hints tell Spark that this one reads an iterator of batches
    from collections.abc import Iterator

    score.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(score, "double")(F.coalesce(text, F.lit("")).cast("binary"))
