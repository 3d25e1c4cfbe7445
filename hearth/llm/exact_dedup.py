"""Exact duplicates by a tree-merge of sorted digest runs (built-in functions only).

Every input partition makes one sorted run of (digest, smallest row).  In
each round ``fan_in`` neighbouring runs are merged into one, keeping per
digest the smallest identifier and the count; the last round leaves one run,
dealt over the cluster by digest.  The winners then travel back down the
tree, one level at a time.  A run holds a digest once, so a text that a third
of all rows share is one row per run at the first exchange and at most
``fan_in`` rows in any later merge: no key is hot on the way up or down.

A digest is verified at every level by two independent facts carried with it
(a second hash and the byte length): rows merge only when all three agree.

Defined cases: a null text counts as empty, and all empty texts are one
group; null identifiers sort last; of repeated rows (same identifier, same
text) exactly one is kept; an empty table gives no rows; other columns are
never touched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.frames import apart
from hearth.session import materialize

SPACE_RUN = "[\\x20\\x09-\\x0D]+"
KEY = ["_digest", "_check", "_octets"]


def normalised(text: Column) -> Column:
    """The text with every run of ASCII white space as one space; null: empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def text_sha256(text: Column) -> Column:
    """Lower-case hex SHA-256 of the normalised text."""
    return F.sha2(normalised(text), 256)


def _runs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document with its verified digest, its run (the partition
    that read it) and a row stamp; stored, so that runs and stamps are fixed
    and a lost executor rereads files instead of texts."""
    norm = normalised(F.col(text_col))
    return materialize(
        docs.select(
            F.col(id_col).alias("_id"),
            F.unhex(F.sha2(norm, 256)).alias("_digest"),
            F.xxhash64(norm).alias("_check"),
            F.octet_length(norm).alias("_octets"),
            F.spark_partition_id().alias("_run"),
            F.monotonically_increasing_id().alias("_row"))
        .sortWithinPartitions("_digest", F.col("_id").asc_nulls_last()), "digest-runs")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 fan_in: int = 16) -> DataFrame:
    """One row per input row: identifier, ``keep_id``, ``group_size``, ``kept``
    and ``text_sha256`` of the normalised text."""
    rows = _runs(apart(docs, id_col, text_col)[0], id_col, text_col)
    first = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"),
                     F.col("_row").alias("row"))
    level = rows.groupBy("_run", *KEY).agg(F.min(first).alias("_first"),
                                           F.count(F.lit(1)).alias("_n"))
    levels = [materialize(level, "run-level")]
    top = levels[0].agg(F.max("_run")).first()[0]
    while top:  # binomial rounds: run r meets its neighbours in run r div fan_in
        merged = (levels[-1]
                  .groupBy(F.expr(f"_run div {fan_in}").cast("int").alias("_run"), *KEY)
                  .agg(F.min("_first").alias("_first"), F.sum("_n").alias("_n")))
        levels.append(materialize(merged, "run-level"))
        top //= fan_in

    won = levels.pop().select("_run", *KEY, "_first", "_n")
    while levels:
        below = levels.pop().select(F.col("_run").alias("_own"),
                                    F.expr(f"_run div {fan_in}").cast("int").alias("_run"), *KEY)
        won = below.join(won, ["_run", *KEY]).drop("_run").withColumnRenamed("_own", "_run")
    return rows.join(won, ["_run", *KEY]).select(
        F.col("_id").alias(id_col),
        F.col("_first.id").alias("keep_id"),
        F.col("_n").alias("group_size"),
        (F.col("_row") == F.col("_first.row")).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      fan_in: int = 16) -> DataFrame:
    """``docs`` (all its columns) without the rows whose text an earlier
    identifier holds; of rows that repeat identifier and text, one stays."""
    kept = (exact_groups(docs, id_col, text_col, fan_in).where("kept")
            .select(F.col(id_col).alias("_kid"), F.col("text_sha256").alias("_ksha")))
    inner, back = apart(docs, id_col, text_col)
    marked = inner.withColumn("_sha", text_sha256(F.col(text_col)))
    one = Window.partitionBy(id_col, "_sha").orderBy(F.lit(1))
    return back(marked.join(kept, F.col(id_col).eqNullSafe(F.col("_kid"))
                            & (F.col("_sha") == F.col("_ksha")), "left_semi")
                .withColumn("_nth", F.row_number().over(one)).where("_nth = 1"))
