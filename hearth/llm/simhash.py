"""SimHash near-duplicates: 64-bit fingerprints and an exact, tiled comparison.

Fingerprints: one pass over whole texts, nothing shuffled but one row per
document.  Comparison: over distinct fingerprints (copies collapse first).
``radius`` differing bits spoil at most ``radius`` of ``blocks`` bit blocks, so
two linked fingerprints agree on some set of ``blocks - radius`` blocks; every
such set is a table whose key is the agreeing bits.  Within a key, fingerprints
are compared in tiles by numpy exclusive-or and bit counts; tile pairs whose
population counts differ beyond the radius are skipped.  A key with more than
``tile`` fingerprints is dealt over tasks as tile pairs (bands of population
count, salted), so no key meets in one task.

A tile pair returns a spanning forest of its links, not the pairs; components
of all forests are the components of all links.

Defined cases: a text without words (null, empty) has fingerprint zero and is
linked like any other; null identifiers take part, and a component of only
such rows has a null ``component_id``; repeated rows share a fingerprint; an
empty table gives no rows; other columns are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.components import components
from hearth.llm.frames import apart
from hearth.session import materialize

BITS = 64
SUB_TILE = 512


def fingerprint(words: list[bytes], shingle: int, seed: int) -> int:
    """A bit is 1 if it is set in over half of the shingles' XXH64."""
    import xxhash

    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    n = len(words) - shingle + 1
    grams = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))
    h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(seed)), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for k in range(0, n, 8192):
        ones += np.unpackbits(h[k:k + 8192].view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3, seed: int = 42) -> DataFrame:
    """(``_id``, ``_text`` hash, ``fp`` bigint) of every whole text, A-Z lower-cased."""
    docs = apart(docs, id_col, text_col)[0]
    texts = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_text"),
                        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_bytes"))

    def run(batches):
        for batch in batches:
            # bytes.lower() is A-Z only, bytes.split() is \x20 and \x09-\x0D
            found = [fingerprint(t.as_py().lower().split(), shingle, seed) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(np.array(found, np.uint64).view(np.int64))],
                ["_id", "_text", "fp"])

    kind = texts.schema["_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"_id {kind}, _text bigint, fp bigint")


def union(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``parent`` (every entry a root) after joining ``a[i]`` with ``b[i]``."""
    while len(a):
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(parent, up := parent[parent]):
            parent = up
    return parent


def forest(fps: np.ndarray, side: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest over ``fps`` (uint64): within one tile, or
    between the tiles that ``side`` tells apart if it does."""
    weight = np.bitwise_count(fps).astype(np.int16)
    order = np.argsort(weight, kind="stable")
    fps, weight, side = fps[order], weight[order], side[order]
    left, right = (np.flatnonzero(side == s) for s in (0, 1))
    if not len(right):
        right = left
    parent = np.arange(len(fps))
    for i in range(0, len(left), SUB_TILE):
        a = left[i:i + SUB_TILE]
        for j in range(i if right is left else 0, len(right), SUB_TILE):
            b = right[j:j + SUB_TILE]
            if weight[b[0]] - weight[a[-1]] > radius:
                break
            if weight[a[0]] - weight[b[-1]] > radius:
                continue
            near = np.bitwise_count(fps[a][:, None] ^ fps[b][None, :]) <= radius
            x, y = np.nonzero(near)
            parent = union(parent, a[x], b[y])
    moved = np.flatnonzero(parent != np.arange(len(fps)))
    return fps[moved], fps[parent[moved]]


def grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[dict]:
    """Runs of equal values in the first ``keys`` (integer) columns of sorted
    batches, as numpy columns; a run may span batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        whole = pa.Table.from_batches(held).combine_chunks()
        key = np.stack([whole.column(k).to_numpy() for k in range(keys)])
        cut = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        if not len(cut):
            continue
        yield from _cut(whole, np.concatenate([[0], cut]))
        held = whole.slice(int(cut[-1])).to_batches()
    if held:
        whole = pa.Table.from_batches(held).combine_chunks()
        yield from _cut(whole, np.array([0, whole.num_rows]))


def _cut(table: pa.Table, ends: np.ndarray) -> Iterator[dict]:
    flat = {n: table.column(n).combine_chunks() for n in table.column_names}
    numbers = {n: c.to_numpy(zero_copy_only=False) for n, c in flat.items()
               if not pa.types.is_nested(c.type)}
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        yield {n: numbers[n][a:b] if n in numbers else flat[n].slice(a, b - a) for n in flat}


def _tables(blocks: int, radius: int) -> list[list[tuple[int, int]]]:
    """Per table the (shift, width) of its agreeing bit blocks."""
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    parts = [(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return [list(c) for c in combinations(parts, blocks - radius)]


def _key(fp: Column, parts: list[tuple[int, int]]) -> Column:
    key = F.lit(0).cast("bigint")
    for shift, width in parts:
        key = (F.shiftleft(key, width)
               .bitwiseOR(F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1))))
    return key


def near_links(distinct: DataFrame, radius: int, blocks: int, tile: int) -> DataFrame:
    """(``a``, ``b``) fingerprints: a spanning forest of each tile pair's links."""
    fp = F.col("fp")
    keyed = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).alias("table"), _key(fp, parts).alias("key"))
        for t, parts in enumerate(_tables(blocks, radius))])).alias("k")).select("k.*", "fp")
    keyed = materialize(keyed, "simhash-keys")
    sizes = (keyed.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
             .withColumnRenamed("table", "_t").withColumnRenamed("key", "_k"))
    # tiles of a large key: bands of population count, salted; rows meet their
    # own band and the next ones only
    salts = F.ceil(F.col("n") / tile).cast("bigint")
    band = F.floor(F.bit_count("fp") / (radius + 1)).cast("bigint")
    own = band * F.lit(1 << 32) + F.pmod(F.xxhash64("fp"), salts)
    others = F.flatten(F.transform(F.sequence(F.greatest(band - 1, F.lit(0)), band + 1),
                                   lambda x: F.transform(F.sequence(F.lit(0), salts - 1),
                                                         lambda s: x * F.lit(1 << 32) + s)))
    meets = F.when(salts == 1, F.array(F.lit(-1).cast("bigint"))).otherwise(others)
    dealt = (keyed.join(sizes, (F.col("table") == F.col("_t")) & (F.col("key") == F.col("_k")))
             .select("table", "key", "fp", F.when(salts == 1, -1).otherwise(own).alias("own"),
                     F.explode(meets).alias("other"))
             .select("table", "key", F.least("own", "other").alias("low"),
                     F.greatest("own", "other").alias("high"),
                     (F.col("own") > F.col("other")).cast("int").alias("side"), "fp"))
    group = ["table", "key", "low", "high"]

    def run(batches):
        for g in _filled(grouped(batches, len(group))):
            yield g

    def _filled(groups):
        a, b = [], []
        for g in groups:
            fps, side = g["fp"].view(np.uint64), g["side"]
            if len(fps) < 2 or g["low"][0] != g["high"][0] and side.min() == side.max():
                continue
            x, y = forest(fps, side, radius)
            a.append(x)
            b.append(y)
            if len(a) >= 4096:
                yield _edges(a, b)
                a, b = [], []
        if a:
            yield _edges(a, b)

    def _edges(a, b):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], ["a", "b"])

    return (dealt.repartition(*group).sortWithinPartitions(*group)
            .mapInArrow(run, "a bigint, b bigint"))


def _rows_in_components(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int,
                        seed: int, blocks: int, tile: int) -> DataFrame:
    if blocks <= radius:
        raise ValueError("blocks must exceed radius")
    prints = materialize(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    held = materialize(prints.groupBy("fp").agg(F.min("_id").alias("_least")), "distinct-prints")
    roots = components(near_links(held.select("fp"), radius, blocks, tile))
    tagged = (held.join(roots, F.col("fp") == F.col("node"), "left")
              .select("fp", "_least", F.coalesce("root", "fp").alias("_root")))
    least = tagged.groupBy("_root").agg(F.min("_least").alias("component_id"))
    found = tagged.join(least, "_root").select("fp", "_root", "component_id")
    return prints.join(found, "fp")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 3, radius: int = 3, seed: int = 42, blocks: int = 5,
                       tile: int = 4096) -> DataFrame:
    """Per row of ``docs``: identifier, ``fp`` and ``component_id``, the smallest
    identifier reachable over links of at most ``radius`` bits."""
    rows = _rows_in_components(docs, id_col, text_col, shingle, radius, seed, blocks, tile)
    return rows.select(F.col("_id").alias(id_col), "fp", "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     shingle: int = 3, radius: int = 3, seed: int = 42, blocks: int = 5,
                     tile: int = 4096) -> DataFrame:
    """``docs`` (all its columns) with one row of each component: its smallest
    identifier's (of several texts under that identifier the first by hash)."""
    rows = _rows_in_components(docs, id_col, text_col, shingle, radius, seed, blocks, tile)
    kept = (rows.where(F.col("_id").eqNullSafe(F.col("component_id")))
            .groupBy("_root", F.col("_id").alias("_kid")).agg(F.min("_text").alias("_ktext")))
    one = Window.partitionBy(id_col, "_th").orderBy(F.lit(1))
    inner, back = apart(docs, id_col, text_col)
    return back(inner.withColumn("_th", F.xxhash64(text_col))
                .join(kept, F.col(id_col).eqNullSafe(F.col("_kid"))
                      & (F.col("_th") == F.col("_ktext")), "left_semi")
                .withColumn("_nth", F.row_number().over(one)).where("_nth = 1"))
