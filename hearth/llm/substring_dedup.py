"""Substring duplicates: seeds on winnowed anchors, extended both ways.

A repeat is a run of at least ``window`` words that also starts in a document
with a smaller identifier.  The work has three steps, each one exchange:

1. Seed.  The anchor of a window is the least hash among its ``gram``-word
   sequences (winnowing), so equal windows have equal anchors.  Documents join
   on their anchors; an anchor of one document only can't be in a repeat.
2. Extend.  In each document, every window around a shared anchor (it reaches
   from the seed to both sides) is hashed, and the smallest document of each
   such window is found.  All other windows are never sent.
3. Merge.  Windows that start in a smaller document are merged into maximal
   repeats, and their words removed.

Before each exchange a batch of documents settles what it can by itself: an
anchor that two of its documents hold is known to be shared, and a window that
a smaller document of the batch holds is known to be a repeat.  What is sent
is one row per batch and value, so a passage that a third of all documents
hold is as many rows as there are batches.  Window hashes have 80 bits.

The texts cross the network once, by identifier; both later joins use that
same exchange.  Rows that share an identifier are told apart by a 64-bit hash of
their text; which identifiers do is counted first and sent to all tasks as at
most ``CELLS`` hash cells.  Rows that repeat identifier and text are made one
before the first step, and the result of that one is joined to all of them at the
end: however many there are, they ask once.

Defined cases: a null text has no words; fewer than ``window`` words hold no
repeat; a null identifier is larger than all others; rows that repeat an
identifier never count as each other's smaller document; an empty table gives
no rows; extra columns aren't read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.frames import apart
from hearth.session import materialize

LAST = 2**63 - 1
CELLS = 1 << 18
SPREAD = np.uint64(0x9E3779B97F4A7C15)
ROOTS = (np.uint64(0x100000001B3), np.uint64(0xD6E8FEB86659FD93))


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def run_hashes(h: np.ndarray, n: int, root: np.uint64) -> np.ndarray:
    """Hash of every run of ``n`` values."""
    size = max(0, len(h) - n + 1)
    out = np.zeros(size, np.uint64)
    for k in range(n):
        out = out * root + h[k:k + size]
    out = (out ^ (out >> np.uint64(29))) * SPREAD
    return out ^ (out >> np.uint64(32))


def anchors(h: np.ndarray, window: int, gram: int) -> np.ndarray:
    """Per window of words the least hash of its ``gram``-word sequences (48
    bits: anchors only choose what is compared, and shorter ones travel lighter)."""
    seeds = run_hashes(h, gram, ROOTS[0]) >> np.uint64(16)
    span = window - gram + 1
    size = max(0, len(seeds) - span + 1)
    if not size:
        return np.zeros(0, np.uint64)
    width, low = 1, seeds
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    return np.minimum(low[:size], low[span - width:span - width + size])


def runs(flags: np.ndarray) -> np.ndarray:
    """(first, past last) of each stretch of true flags."""
    edge = np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))
    return np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], axis=1)


def packed(starts: np.ndarray) -> bytes:
    """Ascending starts as (first, past last) pairs of their stretches."""
    cut = np.flatnonzero(np.diff(starts) > 1)
    return np.stack([starts[np.concatenate([[0], cut + 1])],
                     starts[np.concatenate([cut, [len(starts) - 1]])] + 1],
                    axis=1).astype(np.int32).tobytes()


def _rows(documents: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, bool]:
    """Rows with ``_doc`` and ``_th``, NULL where the identifier is the row's own; and
    whether any identifier may be shared."""
    rows = apart(documents, id_col, text_col)[0].select(
        F.col(id_col).alias("_doc"),
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST)).alias("_id"),
        F.col(text_col).alias("_given"))
    # hash cells of the identifiers that several rows have: CELLS rows at most
    cell = F.pmod(F.xxhash64("_id"), F.lit(CELLS))
    repeated = materialize(rows.groupBy("_id").count().where("count > 1")
                           .select(cell.alias("_cell")).distinct(), "shared-ids")
    told = rows.join(F.broadcast(repeated), cell == F.col("_cell"), "left").select(
        "_doc", "_id", F.when(F.col("_cell").isNotNull(), F.xxhash64("_given")).alias("_th"),
        F.coalesce("_given", F.lit("")).cast("binary").alias("_text"))
    return told, not repeated.isEmpty()


def _mixed(ids: np.ndarray, ths: np.ndarray) -> np.ndarray:
    """A key that spreads the rows of one identifier by their texts."""
    return (ids.view(np.uint64) ^ (ths.view(np.uint64) * SPREAD)).view(np.int64)


def _blobs(values: list[np.ndarray]) -> pa.Array:
    return pa.array([v.tobytes() for v in values], pa.binary())


def _seed(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """(``_id``, ``_th``, ``_anchors``, ``_known``): the anchors each document shares."""

    def run(batches):
        names = ["anchor", "_id", "_th", "shared", "known"]
        for batch in batches:
            ids, ths = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            per = [np.unique(anchors(word_hashes(t.as_py().split()), window, gram))
                   for t in batch.column(2)]
            of = np.repeat(np.arange(len(per)), [len(p) for p in per])
            if not len(of):
                continue
            flat = np.concatenate(per)
            values, at, inverse, held = np.unique(
                flat, return_index=True, return_inverse=True, return_counts=True)
            shared = held > 1  # by rows, as several may have one identifier
            one = np.argsort(at)  # in the documents' order: rows alike compress well
            yield pa.RecordBatch.from_arrays(
                [pa.array(values[one].view(np.int64)), pa.array(ids[of[at[one]]]),
                 pa.array(ths[of[at[one]]]), pa.array(shared[one]),
                 pa.nulls(len(one), pa.binary())], names)
            told = shared[inverse]
            docs, begin = np.unique(of[told], return_index=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_mixed(ids[docs], ths[docs])), pa.array(ids[docs]), pa.array(ths[docs]),
                 pa.array(np.ones(len(docs), bool)),
                 _blobs(np.split(flat[told], begin[1:]) if len(docs) else [])], names)

    sent = rows.select("_id", "_th", "_text").mapInArrow(
        run, "anchor bigint, _id bigint, _th bigint, shared boolean, known binary")
    # rows of one anchor: one per batch at most
    same = Window.partitionBy("anchor", "list")
    told = sent.withColumn("list", F.col("known").isNotNull()).select(
        "*", F.max("shared").over(same).alias("_any"), F.min("_id").over(same).alias("_least"),
        F.max("_id").over(same).alias("_most"))
    # a batch's shared anchor is in its ``known`` lists already
    news = ~F.col("shared") & (F.col("_any") | (F.col("_least") < F.col("_most")))
    return (told.where(F.col("list") | news)
            .select("_id", "_th", F.when(~F.col("list"), F.col("anchor")).alias("anchor"), "known")
            .groupBy("_id", "_th")
            .agg(F.collect_list("anchor").alias("_anchors"), F.collect_list("known").alias("_known")))


def _extend(seeded: DataFrame, window: int, gram: int) -> DataFrame:
    """(``_id``, ``_th``, ``_starts``, ``_spans``): windows that start in a smaller
    document, as single starts and as packed (first, past last) starts."""

    def run(batches):
        names = ["h1", "h2", "_id", "_th", "start", "spans"]
        for batch in batches:
            ids, ths = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            of, start, h1, h2 = [], [], [], []
            for k in range(batch.num_rows):
                h = word_hashes(batch.column(2)[k].as_py().split())
                wanted = np.concatenate([
                    batch.column(3)[k].values.to_numpy().view(np.uint64),
                    *[np.frombuffer(b, np.uint64) for b in batch.column(4)[k].as_py()]])
                at = np.flatnonzero(np.isin(anchors(h, window, gram), wanted))
                start.append(at)
                of.append(np.full(len(at), k))
                h1.append(run_hashes(h, window, ROOTS[0])[at])
                h2.append((run_hashes(h, window, ROOTS[1])[at] >> np.uint64(48)).astype(np.uint16))
            if not sum(map(len, of)):
                continue
            of, start, h1, h2 = map(np.concatenate, (of, start, h1, h2))
            order = np.lexsort((start, of, ids[of], h2, h1))
            of, start, h1, h2 = of[order], start[order], h1[order], h2[order]
            new = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
            kind = np.cumsum(new) - 1
            least = ids[of][np.flatnonzero(new)][kind]
            settled = ids[of] > least
            # only the smallest document of a window asks, once, whatever it repeats
            ask = np.flatnonzero(~settled)
            head = np.concatenate([[True], (kind[ask[1:]] != kind[ask[:-1]])
                                   | (of[ask[1:]] != of[ask[:-1]])])
            first = np.flatnonzero(head)
            again: list = [None] * len(first)
            for k, n in enumerate(np.diff(np.append(first, len(ask))).tolist()):
                if n > 1:
                    again[k] = packed(start[ask[first[k] + 1:first[k] + n]])
            ask = ask[first]
            # in the documents' order: rows alike compress well
            one = np.lexsort((start[ask], of[ask]))
            ask = ask[one]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h1[ask].view(np.int64)), pa.array(h2[ask].view(np.int16)),
                 pa.array(ids[of[ask]]), pa.array(ths[of[ask]]),
                 pa.array(start[ask].astype(np.int32)),
                 pa.array([again[k] for k in one.tolist()], pa.binary())], names)
            of, start = of[settled], start[settled]
            if len(of):
                order = np.lexsort((start, of))
                of, start = of[order], start[order]
                docs, begin = np.unique(of, return_index=True)
                spans = [packed(s) for s in np.split(start, begin[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_mixed(ids[docs], ths[docs])), pa.nulls(len(docs), pa.int16()),
                     pa.array(ids[docs]),
                     pa.array(ths[docs]), pa.nulls(len(docs), pa.int32()),
                     pa.array(spans, pa.binary())], names)

    asked = seeded.mapInArrow(
        run, "h1 bigint, h2 smallint, _id bigint, _th bigint, start int, spans binary")
    least = F.min("_id").over(Window.partitionBy("h1", "h2"))
    # rows without h2 were settled in their batch
    found = asked.withColumn("_least", least).where("h2 is null or _id > _least")
    return found.groupBy("_id", "_th").agg(F.collect_list("start").alias("_starts"),
                                           F.collect_list("spans").alias("_spans"))


def substring_dedup(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = 13, gram: int = 4) -> DataFrame:
    """Per row: identifier, ``n_words``, ``n_removed``, ``repeats`` (the maximal
    repeats as first and past-last word) and ``kept`` (the words that stay,
    joined by one space)."""
    if not 0 < gram <= window:
        raise ValueError("gram must be between 1 and window")
    rows, some_shared = _rows(documents, id_col, text_col)
    # not a literal: the optimizer would join on the identifier alone, and deal once more
    none = F.coalesce("_th", F.lit(0)).alias("_th")
    own = rows.where("_th is null").select("_doc", "_id", none, "_text")
    if not some_shared:
        return _dedup(own, window, gram).drop("_id", "_th").withColumnRenamed("_doc", id_col)
    shared = rows.where("_th is not null")
    key = ["_doc", "_id", "_th"]
    one = shared.groupBy(*key).agg(F.first("_text").alias("_text"))
    done = _dedup(own.unionByName(one), window, gram)
    # a row's own identifier has no partner here; many rows of one key are split by the join
    back = [F.col(c).eqNullSafe(F.col(f"_of{c}")) for c in key]
    copies = rows.select("_doc", "_id", none)
    return (copies.join(done.withColumnsRenamed({c: f"_of{c}" for c in key}), back)
            .select("_doc", "n_words", "n_removed", "repeats", "kept")
            .withColumnRenamed("_doc", id_col))


def _dedup(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """The result for rows that differ in (``_id``, ``_th``), with ``_doc`` and both."""
    shared = _seed(rows, window, gram)
    on = ["_id", "_th"]
    # the columns of both joins' left side are the same: one exchange of the texts
    seeded = (rows.join(shared, on)
              .select("_id", "_th", "_text", "_anchors", "_known", "_doc"))
    found = _extend(seeded, window, gram)
    marked = rows.join(found, on, "left").select("_doc", "_text", "_starts", "_spans", *on)
    names = ["_doc", "_id", "_th", "n_words", "n_removed", "repeats", "kept"]
    repeats = pa.list_(pa.struct([("first", pa.int32()), ("past", pa.int32())]))

    def run(batches):
        for batch in batches:
            counts, gone, spans, kept = [], [], [], []
            for text, starts, packed in zip(*batch.columns[1:4], strict=True):
                words = text.as_py().split()
                held = np.zeros(len(words) + 1, np.int64)
                single = np.array(starts.as_py() or [], np.int64)
                # starts beyond the text are of another row that its hash didn't tell apart
                single = single[single + window <= len(words)]
                np.add.at(held, single, 1)
                np.add.at(held, np.minimum(single + window, len(words)), -1)
                for b in packed.as_py() or []:
                    ends = np.frombuffer(b, np.int32).reshape(-1, 2)
                    ends = ends[ends[:, 1] - 1 + window <= len(words)]
                    np.add.at(held, ends[:, 0], 1)
                    np.add.at(held, np.minimum(ends[:, 1] - 1 + window, len(words)), -1)
                cover = np.cumsum(held)[:len(words)] > 0
                counts.append(len(words))
                gone.append(int(cover.sum()))
                spans.append([{"first": a, "past": b} for a, b in runs(cover).tolist()])
                kept.append(b" ".join([w for w, c in zip(words, cover.tolist(), strict=True) if not c]
                                      if gone[-1] else words).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(4), batch.column(5), pa.array(counts, pa.int64()),
                 pa.array(gone, pa.int64()), pa.array(spans, repeats), pa.array(kept, pa.string())],
                names)

    kind = rows.schema["_doc"].dataType.simpleString()
    return marked.mapInArrow(
        run, f"_doc {kind}, _id bigint, _th bigint, n_words bigint, n_removed bigint, "
             "repeats array<struct<first: int, past: int>>, kept string")
