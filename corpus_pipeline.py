"""Training corpus from ``documents``: toxic documents go, then exact and near
copies, then the sources are mixed to target weights and encoded.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one
before it kept; ``run`` writes each stage's rows to the shared folder and reads
them again, so that a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hearth.llm import queries
from hearth.llm.exact_dedup import drop_exact_copies
from hearth.llm.mixing import mixed_documents
from hearth.llm.simhash import drop_near_copies
from hearth.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (score 0.5 or more) go."""
    return docs.where(queries.toxicity_of(spark, docs, sf_dir) < 0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest doc_id stays."""
    return drop_exact_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group (3-word shingles, 3 bits) the smallest doc_id stays."""
    return drop_near_copies(docs, shingle=3, radius=3)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    return mixed_documents(docs, length_col="n_chars")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every row, decoded again; digests of both."""
    return queries.bpe_digests(docs)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("simhash_dedup", drop_near),
          ("mixing", mix), ("byte_bpe", encode)]

#: a learnt classifier and SimHash aren't SQL: tested against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
