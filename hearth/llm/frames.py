"""Keeping a table's own columns out of an operator's way, and batches small."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STEP_BYTES = 1 << 19


def apart(df: DataFrame, *named: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with every column but ``named`` under a neutral name (whatever it is
    called, also a second spelling of a named one), and the function that gives
    a frame with these columns the original names and order again."""
    inner = [c if c in named else f"x{k}__" for k, c in enumerate(df.columns)]

    def back(out: DataFrame) -> DataFrame:
        return out.select(*[F.col(f"`{n}`") for n in inner]).toDF(*df.columns)

    return df.toDF(*inner), back


def spread_sample(df: DataFrame, column: str, rows: int) -> DataFrame:
    """Every n-th row by a hash of ``column``, so that about ``rows`` to twice as
    many remain; never more than that, should one value repeat very often.
    No partition sends more than its share."""
    every = max(1, df.count() // rows)
    return df.where(F.pmod(F.xxhash64(column), F.lit(every)) == 0).limit(2 * rows)


def steps(batch: pa.RecordBatch, column: int, size: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text, or values of a list,
    in ``column``: what a task holds beside its batch."""
    held = batch.column(column)
    sizes = (pc.list_value_length if pa.types.is_list(held.type) else pc.binary_length)(held)
    ends = np.concatenate([[0], np.cumsum(sizes.fill_null(0).to_numpy(zero_copy_only=False))])
    at = 0
    while at < batch.num_rows:
        upto = int(np.searchsorted(ends, ends[at] + size, side="right"))
        upto = min(max(upto - 1, at + 1), batch.num_rows)
        yield batch.slice(at, upto - at)
        at = upto
