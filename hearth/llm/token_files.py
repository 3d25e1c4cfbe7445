"""Token ids in binary files with a shared zstandard dictionary.

Files: ``<path>/dictionary`` holds the dictionary and its SHA-256;
``<path>/blocks`` holds blocks of about ``BLOCK_BYTES``, in ascending order of
document.  A block is: the hash of its dictionary, the documents' identifiers
and token counts, an offset index, and a blob of frames.  Every document's ids
(little-endian unsigned 32-bit) are one frame of their own, so one document is
read by its block's identifier range and two offsets, and the shared
dictionary keeps even short frames small.  Spark's Parquet writer stores the
blocks: any file system, committed by task, safe to rerun.

Texts go once over the network, to ranges of identifiers; ids are never
shuffled.  The starts of all documents need one total per written range.  Rows of
one identifier, or without one, are dealt further by a hash of their text and by
the place they came from, so that many of them are many ranges.

A Python worker keeps its tokenizer and the ids of up to ``REMEMBERED`` words from
task to task (in its copy of the broadcast), so a word is looked up in the
library about once per worker.  A worker that starts anew is only slower.

Defined cases: a null text is empty and has the end id only; null identifiers
come first; equal identifiers follow each other by a hash of their texts; an
empty table gives files without blocks, which read back as no rows; other
columns are not stored.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearth.llm.frames import apart, spread_sample, steps

BLOCK_BYTES, BLOCK_DOCS = 1 << 20, 4096
#: distinct words whose ids a worker remembers
REMEMBERED = 1_500_000
#: texts that are split and looked up at once
STEP_BYTES = 1 << 22
#: where special tokens begin, and (U+0300 to U+036F) combining marks
LEFT_ALONE = re.compile("<\\||[\u0300-\u036f]")
#: punctuation after a letter at the end of a line
ENDING = re.compile("([a-z])([.,!?;:]+)$", re.M)

BLOCKS = ("shard int, block int, first_id bigint, last_id bigint, dict_hash string, "
          "start_in_shard bigint, n_tokens bigint, doc_ids array<bigint>, counts array<bigint>, "
          "offsets array<bigint>, frames binary")


class WordTokens:
    """Ids of whole texts by a tokenizers file, each distinct word once.

    Files that lower their input, whose normalizer and splitter never look
    across white space nor keep letters and punctuation together (``by_word``),
    allow this: a text's ids are its words' ids in order, A-Z may be lowered
    before, and a word that ends in a letter and punctuation is these two.  Both
    leave fewer words to look up.  Words with a special token's opening or a
    combining mark (which may compose with a small letter only) are left as they
    are.  Texts are split and their distinct words found by Arrow; unseen words go
    to the library joined by spaces, and its offsets tell whose ids are whose.  Of
    the words seen, those used since the last half of ``REMEMBERED`` are kept.
    Other files encode text by text."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        made = json.loads(definition)
        normal = (made["normalizer"] or {}).get("normalizers", [])
        split = (made["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
        pattern = split.get("pattern", {}).get("Regex", "")
        self.by_word = (
            [n["type"] for n in normal] == ["NFC", "Replace", "Lowercase"]
            and normal[1]["pattern"] == {"Regex": "\\s+"} and normal[1]["content"] == " "
            and split.get("behavior") == "Removed" and split.get("invert")
            and pattern.endswith("|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+")
            and all(t["content"].startswith("<|") and not re.search("\\s", t["content"])
                    for t in made["added_tokens"]))

    def _learn(self, words: list[str]) -> None:
        for k in range(0, len(words), 256):
            part = words[k:k + 256]
            found = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            data = np.array(found.ids, "<u4").tobytes()
            at = np.fromiter((a for a, _ in found.offsets), np.int64, len(found.ids))
            begins = np.cumsum([0, *(len(w) + 1 for w in part)])
            cut = (4 * np.searchsorted(at, begins)).tolist()
            self.known.update((w, data[a:b]) for w, a, b in zip(
                part, cut[:-1], cut[1:], strict=True))

    def _of(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        if len(self.known) > REMEMBERED // 2:
            self.older, self.known = self.known, {"": b""}
        known, older = self.known, self.older
        new = [w for w in words if w not in known]
        if new:
            lines = "\n".join(new)
            alone = LEFT_ALONE.search(lines)
            # bytes are lowered from A to Z only
            lines = ENDING.sub(r"\1 \2", lines.encode().lower().decode()).split("\n")
            if alone:
                lines = [w if LEFT_ALONE.search(w) else x for w, x in zip(new, lines, strict=True)]
            parts = [p for p in dict.fromkeys([p for x in lines for p in x.split(" ")]) if p not in known]
            known.update((p, older[p]) for p in parts if p in older)
            self._learn([p for p in parts if p not in older])
            get = known.__getitem__
            known.update(zip(new, [b"".join(map(get, x.split(" "))) if " " in x else get(x)
                                   for x in lines], strict=True))
        return list(map(known.__getitem__, words))

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if not self.by_word:
            found = self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)
            return [np.array(e.ids, "<u4").tobytes() for e in found]
        split = pc.ascii_split_whitespace(texts)
        ends = (split.offsets.to_numpy() - split.offsets[0].as_py()).tolist()
        coded = split.flatten().dictionary_encode()
        ids = self._of(coded.dictionary.to_numpy(zero_copy_only=False).tolist()).__getitem__
        at = coded.indices.to_numpy().tolist()
        return [b"".join(map(ids, at[a:b])) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return apart(docs, id_col, text_col)[0].select(
        F.col(id_col).cast("bigint").alias("_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"))


def train_dictionary(docs: DataFrame, definition: str, end_id: int, text_col: str = "text",
                     id_col: str = "doc_id", sample_docs: int = 600, sample_chars: int = 8192,
                     dictionary_bytes: int = 65536) -> bytes:
    """A zstandard dictionary from serialized id arrays of a bounded sample: about
    ``sample_docs`` documents (at most twice as many) by a hash of their identifier,
    of each at most ``sample_chars`` from a hashed place on.  They are encoded in
    tasks; only their ids are collected.  Too little data for one gives ``b""``."""
    import zstandard

    texts = _texts(docs, id_col, text_col)
    begin = F.pmod(F.xxhash64("_text"), F.greatest(F.lit(1), F.length("_text") - sample_chars))
    slices = spread_sample(texts.select("_id", F.substring(
        "_text", (begin + 1).cast("int"), F.lit(sample_chars)).alias("_text")), "_id", sample_docs)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encoder = WordTokens(definition)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids + end for ids in encoder.encode(batch.column(0))], pa.binary())], ["ids"])

    samples = sorted(bytes(r["ids"]) for r in slices.select("_text").mapInArrow(run, "ids binary").collect())
    try:
        return zstandard.train_dictionary(dictionary_bytes, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_token_files(docs: DataFrame, path: str, tokenizer_json: str, end_id: int,
                      id_col: str = "doc_id", text_col: str = "text", level: int = 3,
                      **sample) -> None:
    """Encode every whole text and write its ids, with ``end_id``, under ``path``."""
    spark = docs.sparkSession
    with open(tokenizer_json, encoding="utf-8") as f:
        definition = f.read()
    trained = train_dictionary(docs, definition, end_id, text_col, id_col, **sample)
    digest = hashlib.sha256(trained).hexdigest()
    (spark.createDataFrame([(digest, bytearray(trained))], "dict_hash string, dictionary binary")
     .coalesce(1).write.parquet(f"{path}/dictionary"))
    shared = spark.sparkContext.broadcast({"definition": definition, "dictionary": trained})
    place = [F.col("_id").asc_nulls_first(), F.col("_hash"), F.col("_at")]
    ordered = (_texts(docs, id_col, text_col)
               .select("_id", "_text", F.xxhash64("_text").alias("_hash"),
                       F.monotonically_increasing_id().alias("_at"))
               .repartitionByRange(*place).sortWithinPartitions(*place).select("_id", "_text"))

    def run(batches):
        import zstandard

        held_by_worker = shared.value
        if "encoder" not in held_by_worker:
            held_by_worker["encoder"] = WordTokens(held_by_worker["definition"])
        encoder, dictionary = held_by_worker["encoder"], held_by_worker["dictionary"]
        end = np.array([end_id], "<u4").tobytes()
        packer = zstandard.ZstdCompressor(
            level=level, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None,
            write_content_size=True)
        shard, block, start = TaskContext.get().partitionId(), 0, 0
        ids, counts, frames, held = [], [], [], 0

        def out():
            total = sum(counts)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in frames])]).astype(np.int64)
            known = [i for i in ids if i is not None]
            row = [[shard], [block], [min(known, default=None)], [max(known, default=None)], [digest],
                   [start], [total], [ids], [counts], [offsets.tolist()], [b"".join(frames)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(),
                     pa.int64(), *[pa.list_(pa.int64())] * 3, pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(row, kinds, strict=True)],
                [c.split()[0] for c in BLOCKS.split(", ")]), total

        for batch in batches:
            for step in steps(batch, 1, STEP_BYTES):
                for i, data in zip(step.column(0).to_pylist(), encoder.encode(step.column(1)),
                                   strict=True):
                    data += end
                    ids.append(i)
                    counts.append(len(data) // 4)
                    frames.append(packer.compress(data))
                    held += len(frames[-1])
                    if held >= BLOCK_BYTES or len(ids) >= BLOCK_DOCS:
                        done, total = out()
                        yield done
                        block, start, held = block + 1, start + total, 0
                        ids, counts, frames = [], [], []
        if ids:
            yield out()[0]

    ordered.mapInArrow(run, BLOCKS).write.parquet(f"{path}/blocks")


def _frames(blocks: DataFrame, path: str, wanted: list | None = None) -> DataFrame:
    spark = blocks.sparkSession
    stored = spark.read.parquet(f"{path}/dictionary").first()
    shared = spark.sparkContext.broadcast((stored["dict_hash"], bytes(stored["dictionary"])))
    names = ["doc_id", "start", "n_tokens", "ids"]
    only = None if wanted is None else set(wanted)

    def run(batches):
        import zstandard

        digest, dictionary = shared.value
        if hashlib.sha256(dictionary).hexdigest() != digest:
            raise ValueError("the stored dictionary doesn't have its hash")
        opener = zstandard.ZstdDecompressor(
            dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        for batch in batches:
            for row in batch.to_pylist():
                if row["dict_hash"] != digest:
                    raise ValueError("a block was written with another dictionary")
                blob, ends, start = row["frames"], row["offsets"], row["start"]
                got = []
                for k, (i, n) in enumerate(zip(row["doc_ids"], row["counts"], strict=True)):
                    if only is None or i in only:
                        data = opener.decompress(blob[ends[k]:ends[k + 1]])
                        if len(data) != 4 * n:
                            raise ValueError(f"document {i}: {len(data)} bytes for {n} ids")
                        got.append((i, start, n, data))
                    start += n
                for k in range(0, len(got), 512):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(
                            zip(*got[k:k + 512], strict=True),
                            (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names)

    return (blocks.select("dict_hash", "start", "doc_ids", "counts", "offsets", "frames")
            .mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary"))


def read_token_files(spark: SparkSession, path: str, doc_ids: list | None = None) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before), ``n_tokens`` and ``ids``
    (little-endian unsigned 32-bit) of every document, or of ``doc_ids``: then
    only blocks whose range holds one are read, and of them only those frames."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    # one row per written range, bounded by the writing partitions
    totals = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("shard")) - F.col("_n")
    starts = totals.select("shard", before.alias("_before"))
    if doc_ids is not None:
        held = F.lit(False)
        for i in doc_ids:
            held = held | (F.lit(i) >= F.col("first_id")) & (F.lit(i) <= F.col("last_id"))
        blocks = blocks.where(held)
    placed = blocks.join(starts, "shard").withColumn(
        "start", F.col("_before") + F.col("start_in_shard"))
    return _frames(placed, path, doc_ids)
