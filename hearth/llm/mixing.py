"""Mixing sources to target weights: capped water-filling, then seeded whole
and fractional repetitions.

Every source's share of all words follows its weight, but no source is read
more than ``max_epochs`` times: a source above that is clamped there and what
it can't take is dealt to the others by weight, until none is above.  The
rounds look at one row per source, never at documents.

A target of 2.4 times the source's words takes every document twice, whole,
and then 0.4 of the source once more: documents in the order of a seeded
digest of their identifier, the one that crosses the quota in part.  The
crossing place is found from the word sums of ``16**CELL_DIGITS`` digest cells
per source and the documents of one cell, so a source with a third of all
rows is never sorted in one task.  What a document gives is then a comparison
with its source's crossing place.

Defined cases: a null text has no words; documents without words give none; a
null source is a source of its own, last in order; null identifiers share one
place; rows equal in identifier and size share the crossing part evenly; an
empty table gives no rows; equal input gives equal output on every run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.frames import apart
from hearth.operators.keys import sequential_keys
from hearth.session import materialize

WORD = "[^\\x20\\x09-\\x0D]+"
CELL_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _ticket(doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def _place(doc_id: Column, size: Column, seed: int) -> Column:
    """A document's place in its source's seeded order."""
    return F.struct(_ticket(doc_id, seed).alias("ticket"),
                    F.coalesce(doc_id.cast("string"), F.lit("")).alias("id"),
                    size.alias("size"))


def fill_to_weights(sources: DataFrame, max_epochs: int) -> DataFrame:
    """``sources`` (one row each: ``_weight``, ``source_size``) with ``target``.

    Each round clamps every source whose share of what is left lies above its
    cap; the level only rises, so a clamped source stays clamped."""
    cap = F.col("source_size") * max_epochs
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    left, weight, clamped = total, None, -1
    above = F.lit(False)
    while True:
        n, caps, open_weight = sources.agg(
            F.coalesce(F.sum(above.cast("long")), F.lit(0)),
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("_weight"))), F.lit(0))).first()
        if n == clamped:
            break
        clamped, left, weight = n, total - caps, open_weight
        if not weight:
            break
        share = F.col("_weight") * F.lit(float(left)) / F.lit(float(weight))
        above = share > cap
    if not weight:
        return sources.withColumn("target", cap.cast("double"))
    return sources.withColumn("target", F.when(above, cap.cast("double")).otherwise(share))


def plan_mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
             text_col: str = "text", weights: Sequence[int] = (1, 2, 3),
             max_epochs: int = 3, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(sizes, plan): the documents' words (``_id``, ``_source``, ``_size``) and one
    row per source: ``source_size``, ``target``, ``whole`` repetitions and the
    crossing place ``_cut`` with the words ``_part`` that its document gives.
    Weights repeat over the sources in code-point order, null last."""
    sizes = materialize(apart(docs, id_col, source_col, text_col)[0].select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("_source"),
        word_count(F.col(text_col)).alias("_size")), "mix-sizes")
    by_source = sizes.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    ranked = sequential_keys(by_source, [F.col("_source").asc_nulls_last()], key="_rank")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                          ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    filled = fill_to_weights(
        materialize(ranked.withColumn("_weight", weight), "mix-sources"), max_epochs)
    words = F.round("target").cast("long")
    plan = filled.select(
        "_source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size"))
        .otherwise(0).alias("whole"),
        F.when(F.col("source_size") > 0, words % F.col("source_size"))
        .otherwise(0).alias("_quota"))
    plan = materialize(plan, "mix-quotas")

    place = _place(F.col("_id"), F.col("_size"), seed)
    cell = F.substring(_ticket(F.col("_id"), seed), 1, CELL_DIGITS)
    cells = sizes.groupBy("_source", cell.alias("_cell")).agg(F.sum("_size").alias("_words"))
    before = F.sum("_words").over(Window.partitionBy("_source").orderBy("_cell")) - F.col("_words")
    quota = plan.select(F.col("_source").alias("_s"), "_quota")
    crossed = (cells.withColumn("_before", before)
               .join(quota, F.col("_source").eqNullSafe(F.col("_s")))
               .where("_before < _quota and _quota <= _before + _words")
               .select("_s", "_cell", F.expr("_quota - _before").alias("_rest")))
    # documents of the crossed cell only: 1 in 16**CELL_DIGITS of a source
    near = (sizes.withColumn("_c", cell)
            .join(crossed, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_c") == F.col("_cell")))
            .groupBy("_s", "_rest", place.alias("_cut"))
            .agg(F.count(F.lit(1)).alias("_equal"), F.sum("_size").alias("_words")))
    until = F.sum("_words").over(Window.partitionBy("_s").orderBy("_cut"))
    cut = (near.withColumn("_until", until)
           .where("_until - _words < _rest and _rest <= _until")
           .select("_s", "_cut", F.expr("(_rest - (_until - _words)) div _equal").alias("_part")))
    return sizes, materialize(
        plan.join(cut, F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s"), "mix-plan")


def _given(place: Column, size: Column) -> Column:
    """Words that a document gives beyond its whole repetitions."""
    return (F.when(F.col("_cut").isNull() | (place > F.col("_cut")), F.lit(0))
            .when(place < F.col("_cut"), size).otherwise(F.col("_part")))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
                text_col: str = "text", weights: Sequence[int] = (1, 2, 3),
                max_epochs: int = 3, seed: int = 42) -> DataFrame:
    """One row per document: identifier, ``size``, ``source_size``, ``target``
    (its source's), ``taken`` words, and of these ``whole`` repetitions and the
    ``part`` words of a last one."""
    sizes, plan = plan_mix(docs, id_col, source_col, text_col, weights, max_epochs, seed)
    joined = sizes.join(plan.withColumnRenamed("_source", "_s"),
                        F.col("_source").eqNullSafe(F.col("_s")))
    part = _given(_place(F.col("_id"), F.col("_size"), seed), F.col("_size"))
    return (joined.withColumn("part", part)
            .select(F.col("_id").alias(id_col), F.col("_size").alias("size"), "source_size",
                    "target", F.expr("whole * _size + part").alias("taken"), "whole", "part"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
                    text_col: str = "text", length_col: str | None = None,
                    weights: Sequence[int] = (1, 2, 3), max_epochs: int = 3,
                    seed: int = 42) -> DataFrame:
    """The mix itself: every document as often as it is taken (all columns).  A
    last repetition in part holds the document's first ``part`` words, and
    ``length_col`` (if named) its characters.  Documents without words follow
    their source's whole repetitions."""
    _, plan = plan_mix(docs, id_col, source_col, text_col, weights, max_epochs, seed)
    plan = plan.select(F.col("_source").alias("_s"), "_cut", "_part",
                       F.when(F.col("source_size") > 0, F.col("whole")).otherwise(1).alias("_whole"))
    named = [c for c in (id_col, source_col, text_col, length_col) if c]
    inner, back = apart(docs, *named)
    sized = inner.withColumn("_size", word_count(F.col(text_col)))
    joined = sized.join(plan, F.col(source_col).eqNullSafe(F.col("_s")))
    part = _given(_place(F.col(id_col), F.col("_size"), seed), F.col("_size"))
    first = F.array_join(F.slice(F.regexp_extract_all(F.col(text_col), F.lit(WORD), F.lit(0)),
                                 F.lit(1), F.greatest(F.col("_take"), F.lit(0)).cast("int")), " ")
    times = F.concat(F.array_repeat(F.lit(-1).cast("long"), F.col("_whole").cast("int")),
                     F.when(F.col("_given") > 0, F.array(F.col("_given").cast("long")))
                     .otherwise(F.array().cast("array<bigint>")))
    out = (joined.withColumn("_given", part).withColumn("_times", times)
           .withColumn("_take", F.explode("_times")))
    in_part = (F.col("_take") >= 0) & (F.col("_take") < F.col("_size"))
    changed = {text_col: F.when(in_part, first).otherwise(F.col(text_col))}
    if length_col:
        changed[length_col] = F.when(in_part, F.length(first)).otherwise(F.col(length_col))
    return back(out.withColumns(
        {c: v.cast(docs.schema[c].dataType) for c, v in changed.items()}))
