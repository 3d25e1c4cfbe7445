"""Lines that many documents share are dropped everywhere.

A sharded minimal perfect hash over all distinct lines gives each line a slot
in compact arrays (fingerprint, count); documents probe these arrays, so no
line is ever joined with its documents:

1. Every distinct text gives one packed row of the 96-bit hashes of its line
   keys (8 + 4 bytes a line) and its number of copies in the batch.
2. Documents are counted per line hash (map-side sums first).
3. Line hashes are dealt to shards of about ``SHARD_KEYS``.  A shard is built in
   one task: levels of bit arrays, in which a key that is alone at its place
   keeps it and the others go to the next level; the rank of a key's bit is its
   slot.  Counts stop at the threshold, so that one byte mostly holds one.
4. Texts send, per batch and shard, one packed row of hashes to probe.  The
   shard's arrays come first in sort order and stay while the probes stream
   past; every probed line is in the index, and the fingerprint proves it.
   Only frequent lines travel back, as one packed row per text and shard.
5. Each text's answers meet its rows, and the lines go.

A line that a third of all documents hold is one entry per batch in steps 2
and 4, and a text that a third of all rows hold one row per batch: nothing
gathers a key's documents.  Memory of a task is one shard or one batch.

Defined cases: a null text is empty and has one empty line; a line's key is the
line without ASCII white space at both ends, A-Z lowered; keys of fewer than
``chars`` code points are never dropped (nor counted); a line that repeats in
one document counts once; repeated rows count as documents of their own; null
identifiers are returned; an empty table gives no rows; extra columns are not
read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.frames import apart, steps
from hearth.session import materialize

SHARD_KEYS = 1 << 15
SPACE = b" \t\n\x0b\x0c\r"
HASH = np.dtype([("lo", "<u8"), ("hi", "<u4")])
PROBE = np.dtype([("hash", HASH), ("k1", "<i8"), ("k2", "<i8")])
MIX = tuple(map(np.uint64, (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)))


def line_hash(line: bytes) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(line)[:HASH.itemsize]


def line_keys(text: bytes, chars: int) -> list[bytes]:
    """Hash of every line's key, ``b""`` for a key that is too short."""
    keys = [line.strip(SPACE) for line in text.lower().split(b"\n")]
    return [line_hash(k) if k and (chars < 2 or len(k.decode()) >= chars) else b"" for k in keys]


def place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    """The place of each key in a level of ``size`` places."""
    x = keys["lo"] + np.uint64(level * int(MIX[0]) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(31))) * MIX[1] + keys["hi"].astype(np.uint64) * MIX[0]
    x = (x ^ (x >> np.uint64(29))) * MIX[2]
    x = (x ^ (x >> np.uint64(32))) >> np.uint64(32)
    return ((x * np.uint64(size)) >> np.uint64(32)).astype(np.int64)


def build_levels(keys: np.ndarray) -> list[np.ndarray]:
    """Bit arrays of a minimal perfect hash: one true place per key in all."""
    levels: list[np.ndarray] = []
    while len(keys):
        if len(levels) > 200:
            raise ValueError("the keys of a shard are not distinct")
        size = 2 * len(keys) + 8
        at = place(keys, len(levels), size)
        levels.append(np.bincount(at, minlength=size) == 1)
        keys = keys[~levels[-1][at]]
    return levels


class Arrays:
    """A shard: slots by the rank of a key's bit, fingerprint and count per slot."""

    def __init__(self, levels: list[np.ndarray], prints: np.ndarray, counts: np.ndarray):
        self.levels, self.prints, self.counts = levels, prints, counts
        self.rank = np.cumsum(np.concatenate(levels)) - 1

    def slots(self, keys: np.ndarray) -> np.ndarray:
        out, left, begin = np.full(len(keys), -1), np.arange(len(keys)), 0
        for level, bits in enumerate(self.levels):
            at = place(keys[left], level, len(bits))
            hit = bits[at]
            out[left[hit]] = self.rank[begin + at[hit]]
            left, begin = left[~hit], begin + len(bits)
        return out

    def count(self, keys: np.ndarray) -> np.ndarray:
        at = self.slots(keys)
        if (at < 0).any() or (self.prints[at] != fingerprint(keys)).any():
            raise ValueError("a probed line is not in its shard")
        return self.counts[at]


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return keys["hi"].astype(np.uint16)


def pack(keys: np.ndarray, counts: np.ndarray, least: int) -> tuple[list[int], bytes, bytes, bytes]:
    """(level sizes, bits, fingerprints, counts) of a shard, counts up to ``least``."""
    levels = build_levels(keys)
    shard = Arrays(levels, np.zeros(len(keys), np.uint16),
                   np.zeros(len(keys), np.min_scalar_type(least)))
    at = shard.slots(keys)
    shard.prints[at] = fingerprint(keys)
    shard.counts[at] = np.minimum(counts, least)
    return ([len(b) for b in levels], np.packbits(np.concatenate(levels)).tobytes(),
            shard.prints.tobytes(), shard.counts.tobytes())


def unpack(sizes: list[int], bits: bytes, prints: bytes, counts: bytes, least: int) -> Arrays:
    whole = np.unpackbits(np.frombuffer(bits, np.uint8), count=sum(sizes)).astype(bool)
    return Arrays(np.split(whole, np.cumsum(sizes)[:-1]), np.frombuffer(prints, np.uint16),
                  np.frombuffer(counts, np.min_scalar_type(least)))


def _rows(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows with a 128-bit hash of their text: rows alike lose the same lines."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return apart(documents, id_col, text_col)[0].select(
        F.col(id_col).alias("_doc"), F.xxhash64(text).alias("_k1"),
        F.xxhash64(F.lit(1), text).alias("_k2"), text.cast("binary").alias("_text"))


def _text_lines(rows: DataFrame, chars: int) -> DataFrame:
    """(``_k1``, ``_k2``, ``copies``, ``hashes``) per distinct text of a batch."""

    def run(batches):
        for batch in batches:
            for step in steps(batch, 2):
                copies: dict[tuple, int] = {}
                texts = {}
                for *key, text in zip(*(c.to_pylist() for c in step.columns), strict=True):
                    key = tuple(key)
                    copies[key] = copies.get(key, 0) + 1
                    texts[key] = text
                packed = [b"".join(sorted({*line_keys(t, chars)} - {b""})) for t in texts.values()]
                k1, k2 = zip(*texts, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                     pa.array([copies[k] for k in texts], pa.int64()),
                     pa.array(packed, pa.binary())], ["_k1", "_k2", "copies", "hashes"])

    return rows.select("_k1", "_k2", "_text").mapInArrow(
        run, "_k1 bigint, _k2 bigint, copies bigint, hashes binary")


def _flat(batch: pa.RecordBatch, column: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, which row each is of) of a batch."""
    blobs = batch.column(column).to_pylist()
    of = np.repeat(np.arange(len(blobs)), [len(b) // HASH.itemsize for b in blobs])
    return np.frombuffer(b"".join(blobs), HASH), of


def line_counts(lines: DataFrame) -> DataFrame:
    """(``lo``, ``hi``, ``docs``): documents that hold each line."""

    def run(batches):
        for batch in batches:
            found, of = _flat(batch, 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found["lo"].view(np.int64)), pa.array(found["hi"].astype(np.int64)),
                 pa.array(batch.column(0).to_numpy()[of])], ["lo", "hi", "copies"])

    each = lines.select("copies", "hashes").mapInArrow(run, "lo bigint, hi bigint, copies bigint")
    return each.groupBy("lo", "hi").agg(F.sum("copies").alias("docs"))


def line_index(counts: DataFrame, shards: int, least: int) -> DataFrame:
    """One row per shard: its level sizes, bits, fingerprints and counts."""
    dealt = (counts.withColumn("shard", F.pmod("lo", F.lit(shards)))
             .repartition("shard").sortWithinPartitions("shard"))

    def run(batches):
        held, now = [], None

        def out():
            lo, hi, docs = map(np.concatenate, zip(*held, strict=True))
            keys = np.zeros(len(lo), HASH)
            keys["lo"], keys["hi"] = lo.view(np.uint64), hi
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(
                    (now, *pack(keys, docs, least)),
                    (pa.int64(), pa.list_(pa.int32()), *[pa.binary()] * 3), strict=True)],
                ["shard", "sizes", "bits", "prints", "counts"])

        for batch in batches:
            lo, hi, docs, shard = (c.to_numpy() for c in batch.columns)
            cut = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                if a < b:
                    if held and shard[a] != now:
                        yield out()
                        held = []
                    now = int(shard[a])
                    held.append((lo[a:b], hi[a:b], docs[a:b]))
        if held:
            yield out()

    return dealt.select("lo", "hi", "docs", "shard").mapInArrow(
        run, "shard bigint, sizes array<int>, bits binary, prints binary, counts binary")


def frequent_lines(lines: DataFrame, index: DataFrame, shards: int, least: int) -> DataFrame:
    """(``_k1``, ``_k2``, ``gone``): each text's frequent lines, as packed hashes."""

    def ask(batches):
        for batch in batches:
            found, of = _flat(batch, 2)
            probe = np.zeros(len(found), PROBE)
            probe["hash"] = found
            probe["k1"], probe["k2"] = (batch.column(k).to_numpy()[of] for k in (0, 1))
            shard = found["lo"].view(np.int64) % shards
            order = np.argsort(shard, kind="stable")
            shard, probe = shard[order], probe[order]
            cut = np.flatnonzero(np.diff(shard)) + 1
            if len(shard):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard[np.concatenate([[0], cut])]),
                     pa.array([p.tobytes() for p in np.split(probe, cut)], pa.binary())],
                    ["shard", "probes"])

    def answer(batches):
        arrays, now = None, None
        for batch in batches:
            for shard, probes, *packed in zip(*batch.columns, strict=True):
                if not probes.is_valid:
                    arrays, now = unpack(*(p.as_py() for p in packed), least), shard.as_py()
                    continue
                if shard.as_py() != now:
                    raise ValueError(f"no arrays for shard {shard}")
                asked = np.frombuffer(probes.as_py(), PROBE)
                asked = asked[arrays.count(asked["hash"]) >= least]
                new = np.flatnonzero((np.diff(asked["k1"]) != 0) | (np.diff(asked["k2"]) != 0)) + 1
                first = np.concatenate([[0], new]).astype(np.int64) if len(asked) else new
                yield pa.RecordBatch.from_arrays(
                    [pa.array(asked["k1"][first]), pa.array(asked["k2"][first]),
                     pa.array([p["hash"].tobytes() for p in np.split(asked, new)] if len(asked)
                              else [], pa.binary())], ["_k1", "_k2", "gone"])

    probes = lines.select("_k1", "_k2", "hashes").mapInArrow(ask, "shard bigint, probes binary")
    arrays = index.select("shard", F.lit(None).cast("binary").alias("probes"),
                          "sizes", "bits", "prints", "counts")
    met = (arrays.unionByName(probes, allowMissingColumns=True).repartition("shard")
           .sortWithinPartitions("shard", F.col("probes").isNotNull()))
    found = met.mapInArrow(answer, "_k1 bigint, _k2 bigint, gone binary")
    # copies of a text in other batches have the same answer from a shard: sets stay small
    return found.groupBy("_k1", "_k2").agg(F.collect_set("gone").alias("gone"))


def line_dedup(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               least: int = 10, chars: int = 1, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """Per row: identifier, ``n_lines``, ``n_dropped`` and ``kept``: the text without
    the lines whose key ``least`` or more documents hold."""
    rows = _rows(documents, id_col, text_col)
    lines = materialize(_text_lines(rows, chars), "line-hashes")
    counts = materialize(line_counts(lines), "line-counts")
    shards = max(1, math.ceil(counts.count() / shard_keys))
    index = materialize(line_index(counts, shards, least), "line-index")
    gone = frequent_lines(lines, index, shards, least)
    kind = rows.schema["_doc"].dataType.simpleString()
    names = ["_doc", "n_lines", "n_dropped", "kept"]

    def run(batches):
        for batch in batches:
            for step in steps(batch, 1):
                n, dropped, kept = [], [], []
                for text, packed in zip(step.column(1).to_pylist(), step.column(2).to_pylist(),
                                        strict=True):
                    n.append(text.count(b"\n") + 1)
                    if packed:
                        size = HASH.itemsize
                        out = {b[k:k + size] for b in packed for k in range(0, len(b), size)}
                        stay = [line for line, key in zip(text.split(b"\n"), line_keys(text, chars),
                                                          strict=True) if key not in out]
                        dropped.append(n[-1] - len(stay))
                        text = b"\n".join(stay)
                    else:
                        dropped.append(0)
                    kept.append(text.decode())
                yield pa.RecordBatch.from_arrays(
                    [step.column(0), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()),
                     pa.array(kept, pa.string())], names)

    told = rows.join(gone, ["_k1", "_k2"], "left").select("_doc", "_text", "gone")
    return told.mapInArrow(run, f"_doc {kind}, n_lines bigint, n_dropped bigint, kept string"
                           ).withColumnRenamed("_doc", id_col)
