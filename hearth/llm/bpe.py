"""Byte-level BPE encoding and decoding with a rank file's vocabulary.

Texts are split by the given pattern; each distinct piece of a batch is
encoded once.  Pieces are dealt by length into buckets of padded numpy
matrices.  In every round each row merges its leftmost pair of minimum rank
(``argmin`` finds the leftmost), the row is compacted by one place, and only
the two pairs beside the merge are looked up again, in an open-addressing hash
table over (left id, right id).  Rows with nothing to merge leave the matrix.
A piece of more than ``LONGEST_ROW`` bytes, for which a matrix row would cost
its square, is merged in the same order with a heap.

Work is one pass over the documents' own partitions without a shuffle; only
the vocabulary (its size fixed by the file) is broadcast.

Defined cases: a null or empty text gives no ids and decodes to nothing; other
columns pass through unchanged, nulls and repeated rows included.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm.frames import apart, steps

NONE = np.int32(2**31 - 1)
LONGEST_ROW = 512
#: cells of one padded matrix, distinct pieces remembered
MATRIX_CELLS = 1 << 18
REMEMBERED = 120_000


def read_ranks(path: str) -> list[bytes]:
    """The vocabulary by id, from lines of base64 token and rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    vocab = [b""] * (max(int(r) for _, r in pairs) + 1)
    for token, rank in pairs:
        vocab[int(rank)] = base64.b64decode(token)
    return vocab


class PairTable:
    """(left id, right id) → id of the merged token, vectorised linear probing."""

    def __init__(self, vocab: list[bytes]):
        ids = {t: i for i, t in enumerate(vocab) if t}
        keys, values = [], []
        for token, i in ids.items():
            for cut in range(1, len(token)):
                left, right = ids.get(token[:cut]), ids.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(i)
        self.bits = max(4, (2 * len(keys)).bit_length())
        size = 1 << self.bits
        self.keys, self.values = np.full(size, -1, np.int64), np.full(size, NONE, np.int32)
        keys, values = np.array(keys, np.int64), np.array(values, np.int32)
        at, open_ = self._slot(keys), np.arange(len(keys))
        while len(open_):  # each free slot takes one of the keys that want it
            free = self.keys[at[open_]] == -1
            self.keys[at[open_[free]]] = keys[open_[free]]
            self.values[at[open_[free]]] = values[open_[free]]
            open_ = open_[self.keys[at[open_]] != keys[open_]]
            at[open_] = (at[open_] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the merged pairs, ``NONE`` where a pair is no token or an end."""
        keys = left.astype(np.int64) << 32 | right
        keys[(left < 0) | (right < 0)] = -2
        at = self._slot(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.values[at], NONE)
        open_ = np.flatnonzero((held != keys) & (held != -1) & (keys != -2))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            held = self.keys[at[open_]]
            out[open_] = np.where(held == keys[open_], self.values[at[open_]], NONE)
            open_ = open_[(held != keys[open_]) & (held != -1)]
        return out


class Encoder:
    def __init__(self, vocab: list[bytes], pairs: PairTable):
        self.pairs = pairs
        self.whole = {t: i for i, t in enumerate(vocab) if t}
        self.byte_ids = np.array([self.whole[bytes([b])] for b in range(256)], np.int32)

    def encode(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece: of the whole piece if it is a token, else merged."""
        out: list = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if (known := self.whole.get(p)) is not None:
                out[i] = np.array([known], np.int32)
            elif len(p) > LONGEST_ROW:
                out[i] = self._long(p)
            else:
                buckets.setdefault(1 << (len(p) - 1).bit_length(), []).append(i)
        for width, rows in buckets.items():
            step = max(1, MATRIX_CELLS // width)
            for k in range(0, len(rows), step):
                part = rows[k:k + step]
                for i, ids in zip(part, self._merge([pieces[i] for i in part], width), strict=True):
                    out[i] = ids
        return out

    def _merge(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        lengths = np.array([len(p) for p in pieces])
        flat = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8)
        ids = np.where(np.arange(width) < lengths[:, None],
                       self.byte_ids[flat].reshape(-1, width), np.int32(-1))
        ranks = self.pairs.merged(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(-1, width - 1)
        done: list = [None] * len(pieces)
        row = np.arange(len(pieces))
        while True:
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(row)), at]
            for i in np.flatnonzero(best == NONE):
                done[row[i]] = ids[i, :lengths[i]].copy()
            live = np.flatnonzero(best != NONE)
            if not len(live):
                return done
            row, ids, ranks, lengths, at, best = (
                x[live] for x in (row, ids, ranks, lengths, at, best))
            n = np.arange(len(row))
            ids[n, at] = best
            # compaction: every place after the merge takes its right neighbour
            wide = ids.shape[1]
            keep = np.arange(wide - 1) + (np.arange(wide - 1) > at[:, None])
            ids = np.take_along_axis(ids, keep, axis=1)
            lengths = lengths - 1
            if wide == 2:
                ranks = np.full((len(row), 1), NONE, np.int32)
                ids = np.pad(ids, ((0, 0), (0, 1)), constant_values=-1)
                continue
            ranks = np.take_along_axis(
                ranks, np.arange(wide - 2) + (np.arange(wide - 2) > at[:, None]), axis=1)
            after = np.minimum(at, wide - 3)  # the pair that starts at the merge
            right = np.where(at < wide - 2, ids[n, np.minimum(at + 1, wide - 2)], -1)
            fresh = self.pairs.merged(best, right)
            ranks[n, after] = np.where(at == after, fresh, ranks[n, after])
            left = np.flatnonzero(at > 0)  # and the pair that ends at it
            ranks[left, at[left] - 1] = self.pairs.merged(ids[left, at[left] - 1], best[left])

    def _long(self, piece: bytes) -> np.ndarray:
        """The same merges in the same order for one long piece: a heap of
        (rank, place) over a linked list."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.pairs.merged(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32))
        heap = [(r, i) for i, r in enumerate(first.tolist()) if r != NONE]
        rank = first.tolist() + [int(NONE)]
        heapq.heapify(heap)

        def renew(i: int) -> None:
            rank[i] = int(NONE)
            if i >= 0 and after[i] < n:
                r = int(self.pairs.merged(np.array([ids[i]]), np.array([ids[after[i]]]))[0])
                rank[i] = r
                if r != NONE:
                    heapq.heappush(heap, (r, i))

        while heap:
            r, i = heapq.heappop(heap)
            if rank[i] != r:
                continue
            gone = after[i]
            ids[i], rank[gone], after[i] = r, -1, after[gone]
            if after[i] < n:
                before[after[i]] = i
            renew(i)
            if before[i] >= 0:
                renew(before[i])
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return np.array(out, np.int32)


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text",
                 ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids_col`` (array<int>) in place of ``text_col`` (and of any
    column of that name)."""
    spark = docs.sparkSession
    vocab = read_ranks(ranks_path)
    shared = spark.sparkContext.broadcast((vocab, PairTable(vocab)))
    kept = [f for f in docs.schema.fields if f.name not in (text_col, ids_col)]
    schema = T.StructType([*kept, T.StructField(ids_col, T.ArrayType(T.IntegerType(), False), False)])
    inner, _ = apart(docs, text_col)
    at = [c for c, f in zip(inner.columns, docs.schema.fields, strict=True) if f in kept]
    source = inner.select(*at, F.col(text_col).alias("_text"))

    def run(batches):
        import regex

        split, encoder = regex.compile(pattern).findall, Encoder(*shared.value)
        known: dict[str, bytes] = {}
        for batch in batches:
            for step in steps(batch, batch.num_columns - 1):
                pieces = [split(t.as_py() or "") for t in step.column(step.num_columns - 1)]
                seen = {p for ps in pieces for p in ps}
                new = list(seen.difference(known))
                if len(known) + len(new) > REMEMBERED:
                    known = {p: known[p] for p in seen.difference(new)}
                known.update(zip(new, (x.tobytes() for x in encoder.encode(
                    [p.encode() for p in new])), strict=True))
                data = [b"".join(map(known.__getitem__, ps)) for ps in pieces]
                sizes = [len(d) // 4 for d in data]
                ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                flat = pa.Array.from_buffers(
                    pa.int32(), sum(sizes), [None, pa.py_buffer(b"".join(data))])
                yield pa.RecordBatch.from_arrays(
                    [*step.columns[:-1], pa.ListArray.from_arrays(ends, flat)], schema.names)

    return source.mapInArrow(run, schema)


def decode_ids(encoded: DataFrame, ranks_path: str, ids_col: str = "ids",
               bytes_col: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes of ``ids_col`` added (in place of any column of
    that name).  A null array decodes to
    nothing; an id outside the vocabulary is an error."""
    spark = encoded.sparkSession
    shared = spark.sparkContext.broadcast(read_ranks(ranks_path))
    fields = [f for f in encoded.schema.fields if f.name != bytes_col]
    schema = T.StructType([*fields, T.StructField(bytes_col, T.BinaryType(), False)])
    inner, _ = apart(encoded, ids_col)
    kept = [c for c, f in zip(inner.columns, encoded.schema.fields, strict=True) if f in fields]
    at = kept.index(ids_col)

    def run(batches):
        token = shared.value.__getitem__
        for batch in batches:
            for step in steps(batch, at):
                ids = step.column(at)
                texts = [b"".join(map(token, x.values.to_numpy().tolist())) if x.is_valid else b""
                         for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [*step.columns, pa.array(texts, pa.binary())], schema.names)

    return inner.select(*kept).mapInArrow(run, schema)
