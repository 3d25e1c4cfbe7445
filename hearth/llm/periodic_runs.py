"""Periodic runs of words by an online sparse diagonal program.

A run is a stretch of consecutive words with smallest period q that no
neighbour extends, at least ``copies`` periods and ``least`` words long.  In
the plane of word position against lag it is one diagonal of matches: every
word but the first q equals the one q before.

Words are visited in order.  The earlier occurrence of a word continues the
active diagonal of its lag (its match length grows by one) or opens one; a
diagonal that the next word doesn't continue has ended and, if long enough, is
emitted at once.  Following all earlier occurrences of a frequent word would be
quadratic, so occurrences are made sparse, without losing a run, by scales
G = 1, 2, 4, ...:

* A scale looks for periods above G/2 up to G, and two places are occurrences of
  each other if the G words that begin there are equal.  Inside a run of such a
  period q the nearest earlier occurrence is exactly q back (a nearer one would
  give the run a smaller period), so each word has one lag to continue, and
  the diagonal of a multiple of the period is never opened.
* Such a run is at least ``2G + 4`` words long, and all its words recur.  Words
  outside a stretch of ``G + 5`` recurring ones are left out of this scale and
  all later ones.  In plain prose almost nothing is left after two scales.

Names of the G-word sequences of a scale are pairs of the names of the scale
before.  A document costs O(n log n) time and O(n) memory, whatever it repeats.
Everything happens in one row, so there is no exchange and nothing to recover
but a task.

Defined cases: a null or empty text has no words and no runs; rows are treated
one by one, so repeated rows and identifiers don't matter; null identifiers are
returned; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.frames import apart, steps

LEAST, COPIES = 6, 4
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def long_stretches(pos: np.ndarray, least: int) -> np.ndarray:
    """Which of the ascending ``pos`` lie in a stretch of ``least`` consecutive ones."""
    if not len(pos):
        return np.zeros(0, bool)
    new = np.flatnonzero(np.concatenate([[True], np.diff(pos) != 1]))
    size = np.diff(np.append(new, len(pos)))
    return np.repeat(size >= least, size)


def diagonals(pos: list[int], lags: list[int], gram: int, least: int, copies: int):
    """Runs (start, length, period) as their diagonals end; ``lags[k]`` is the lag
    that the word at ``pos[k]`` continues or opens."""
    before, active, length = -2, 0, 0
    for p, lag in zip([*pos, -2], [*lags, 0], strict=True):
        if lag == active and p == before + 1:
            length += 1
        else:
            # the sequences that begin at the last `length` words match `active` back
            whole = length + gram - 1 + active
            if length and whole >= max(least, copies * active):
                yield before - length + 1 - active, whole, active
            active, length = lag, 1
        before = p


def runs_of(names: np.ndarray, least: int = LEAST, copies: int = COPIES) -> list[tuple]:
    """Runs of a sequence of word names (small non-negative integers)."""
    pos, name, gram, found = np.arange(len(names)), names, 1, []
    while len(pos):
        recurs = np.bincount(name)[name] > 1
        pos, name = pos[recurs], name[recurs]
        inside = long_stretches(pos, max(least, copies * (gram // 2 + 1)) - gram + 1)
        pos, name = pos[inside], name[inside]
        if not len(pos):
            break
        order = np.argsort(name, kind="stable")
        lag = np.zeros(len(pos), np.int64)
        again = name[order[1:]] == name[order[:-1]]
        lag[order[1:]] = np.where(again, pos[order[1:]] - pos[order[:-1]], 0)
        near = (2 * lag > gram) & (lag <= gram)
        found += diagonals(pos[near].tolist(), lag[near].tolist(), gram, least, copies)
        # sequences twice as long: pairs of names
        at = np.searchsorted(pos, pos + gram)
        both = pos[np.minimum(at, len(pos) - 1)] == pos + gram
        pair = name[both] * (int(name.max()) + 1) + name[at[both]]
        pos, name = pos[both], np.unique(pair, return_inverse=True)[1]
        gram *= 2
    return sorted(found, key=lambda r: (r[0], r[2]))


def word_names(documents: list[list[bytes]]) -> np.ndarray:
    """Names of all words in order; words of different documents never share one."""
    parts, used = [], 0
    for words in documents:
        known = {w: k for k, w in enumerate(dict.fromkeys(words), used)}
        parts.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
        used += len(known)
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def periodic_runs(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  least: int = LEAST, copies: int = COPIES) -> DataFrame:
    """Per row: identifier, ``n_words``, ``runs`` (by start, then period) and
    ``collapsed``: the words, joined by one space, without those that any run
    holds after its first period."""
    if copies < 4 or least < 6:
        raise ValueError("scales are sparse without loss from 4 copies and 6 words on")
    rows = apart(documents, id_col, text_col)[0].select(
        F.col(id_col).alias("_doc"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))
    kind = rows.schema["_doc"].dataType.simpleString()
    names = ["_doc", "n_words", "runs", "collapsed"]
    listed = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches):
        for batch in batches:
            for step in steps(batch, 1):
                words = [t.as_py().split() for t in step.column(1)]
                begin = np.cumsum([0, *map(len, words)])
                per: list[list[tuple]] = [[] for _ in words]
                for start, length, period in runs_of(word_names(words), least, copies):
                    k = int(np.searchsorted(begin, start, side="right")) - 1
                    per[k].append((start - int(begin[k]), length, period))
                kept = []
                for ws, found in zip(words, per, strict=True):
                    if found:
                        gone = np.zeros(len(ws) + 1, np.int64)
                        for start, length, period in found:
                            gone[start + period] += 1
                            gone[start + length] -= 1
                        stays = np.cumsum(gone)[:-1] == 0
                        ws = [ws[k] for k in np.flatnonzero(stays).tolist()]
                    kept.append(b" ".join(ws).decode())
                yield pa.RecordBatch.from_arrays(
                    [step.column(0), pa.array(np.diff(begin), pa.int64()),
                     pa.array([[dict(zip(("start", "length", "period"), r, strict=True))
                                for r in found] for found in per], listed),
                     pa.array(kept, pa.string())], names)

    out = rows.mapInArrow(run, f"_doc {kind}, n_words bigint, runs {RUNS}, collapsed string")
    return out.withColumnRenamed("_doc", id_col)
