"""Surrogate keys, unknown members and row identity (WN1, WN2, SE1, S6, S7).

``sequential_keys`` numbers rows 1..n in a global order *without* the
one-partition window that ``row_number().over(Window.orderBy(..))`` plans:
rows are range-partitioned and sorted, each partition counts its rows, the
(#partitions-sized) table of counts becomes running offsets, and every row
gets offset + its position inside the partition.  Only the offsets table is
broadcast; its size is bounded by the number of partitions.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LOCAL_BITS = 33                      # monotonically_increasing_id layout
_LOCAL_MASK = (1 << _LOCAL_BITS) - 1


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def range_stamped(df: DataFrame, order_by: Sequence,
                  partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` range-partitioned and sorted by (groups, ``order_by``, the
    remaining columns), each row stamped with ``_mid`` (partition index in
    the high bits, position in the partition in the low bits), written
    once to the shared folder and read back, so every later read sees the
    same partition boundaries."""
    from hearth.session import materialize

    groups = list(partition_by)
    order = _cols(order_by)
    named = set(groups) | {o for o in order_by if isinstance(o, str)}
    rest = [F.col(c) for c in df.columns if c not in named]
    gcols = [F.col(g) for g in groups]
    return materialize(df.repartitionByRange(*gcols, *order, *rest)
                       .sortWithinPartitions(*gcols, *order, *rest)
                       .withColumn("_mid", F.monotonically_increasing_id()), "keys")


def rows_at_ranks(ordered: DataFrame, ranks) -> DataFrame:
    """The rows of a ``range_stamped`` frame at global 1-based ``ranks`` (a
    list, or a function of the row count n giving the list).

    Only the per-partition counts (one row per partition, bounded by the
    partition count) come to the driver; the wanted ``_mid`` stamps are
    computed from them and read back with a filter on the stored column,
    which the Parquet reader can answer from row-group statistics."""
    pid = F.shiftright(F.col("_mid"), _LOCAL_BITS)
    local = F.col("_mid").bitwiseAND(F.lit(_LOCAL_MASK))
    counts = (ordered.groupBy(pid.alias("_pid"))
              .agg(F.count(F.lit(1)).alias("_n"), F.min(local).alias("_first"))
              .collect())
    if callable(ranks):
        ranks = ranks(sum(r["_n"] for r in counts))
    ids, off = [], 0
    for r in sorted(counts, key=lambda r: r["_pid"]):
        ids += [(r["_pid"] << _LOCAL_BITS) + r["_first"] + (k - off - 1)
                for k in ranks if off < k <= off + r["_n"]]
        off += r["_n"]
    return ordered.filter(F.col("_mid").isin(ids) if ids else F.lit(False))


def sequential_keys(df: DataFrame, order_by: Sequence, key: str = "Key",
                    start: int = 1, partition_by: Sequence[str] = ()) -> DataFrame:
    """Dense row numbers (bigint) from ``start`` in ``order_by`` order (ties broken by
    the remaining columns so that the numbering is deterministic); with
    ``partition_by`` the numbering restarts in every group.

    The range-partitioned, id-stamped frame is materialized (written once
    to the shared folder) before it is read twice — once to count rows per
    (partition, group), once to number them.  Without it each read would
    re-run the range exchange with its own sampled boundaries, and the
    counts could disagree with the partitions they describe.  Rows of one
    group are contiguous inside a partition (sorted by group first), so a
    row's number is its group's offset from earlier partitions plus its
    position after the group's first row in this partition.
    """
    groups = list(partition_by)
    gcols = [F.col(g) for g in groups]
    ordered = range_stamped(df, order_by, groups)
    pid = F.shiftright(F.col("_mid"), _LOCAL_BITS)
    local = F.col("_mid").bitwiseAND(F.lit(_LOCAL_MASK))
    counts = ordered.groupBy(pid.alias("_pid"), *gcols).agg(
        F.count(F.lit(1)).alias("_n"), F.min(local).alias("_first"))
    w = Window.partitionBy(*gcols).orderBy("_pid") if groups else Window.orderBy("_pid")
    offsets = counts.select(
        F.col("_pid"), *[F.col(g).alias(f"_g_{g}") for g in groups], "_first",
        (F.sum("_n").over(w) - F.col("_n")).alias("_off"))
    cond = pid == offsets["_pid"]
    for g in groups:
        cond = cond & ordered[g].eqNullSafe(offsets[f"_g_{g}"])
    # (#partitions × groups-per-partition) rows: broadcast only without groups,
    # where the size is bounded by the partition count; else AQE decides
    out = ordered.join(offsets if groups else F.broadcast(offsets), cond, "inner")
    number = F.col("_off") + local - F.col("_first") + F.lit(start)
    return out.select(*[ordered[c] for c in df.columns], number.cast("bigint").alias(key))


def window_keys(df: DataFrame, order_by: Sequence, key: str = "Key") -> DataFrame:
    """``row_number`` over an unpartitioned order — only for frames whose size
    is bounded by construction (a handful of code-table rows)."""
    return df.withColumn(key, F.row_number().over(Window.orderBy(*_cols(order_by))))


def stable_keys(existing: DataFrame, values: DataFrame, key: str,
                value_cols: Sequence[str]) -> DataFrame:
    """Keep already assigned keys; new members get max(key) + their rank (S6)."""
    value_cols = list(value_cols)
    new = values.select(*value_cols).distinct().join(
        existing.select(*value_cols), value_cols, "left_anti")
    # one scalar (the current top key) comes back to the driver
    top = existing.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
    fresh = sequential_keys(new, value_cols, key=key, start=int(top) + 1)
    kind = existing.schema[key].dataType
    return existing.select(key, *value_cols).unionByName(
        fresh.withColumn(key, F.col(key).cast(kind)))


def hash_key(*cols) -> Column:
    """Stable 64-bit key from natural columns (replaces run-dependent ids)."""
    return F.xxhash64(*_cols(cols))


def with_unknown_member(dim: DataFrame, member: dict) -> DataFrame:
    """Prepend a key-0 'unknown' row (SE1).  ``member`` maps column → value;
    columns not given are NULL."""
    spark = dim.sparkSession
    row = spark.range(1).select(*[
        (F.lit(member[f.name]) if f.name in member else F.lit(None))
        .cast(f.dataType).alias(f.name) for f in dim.schema.fields])
    return row.unionByName(dim)


def latest_per_key(df: DataFrame, key: Sequence[str] | str, ts: str,
                   tie_breakers: Sequence[str] = ()) -> DataFrame:
    """One row per key: the newest by ``ts`` (WN2).

    Implemented as an aggregate of ``max_by(struct(row), (ts, ties))`` so that
    the map side pre-aggregates: a key holding a third of all rows still
    ships one partial row per map task, not all its rows to one task.
    NULL keys are kept as they are (they can never match in a merge).
    """
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in df.columns if c not in keys]
    order = F.struct(F.col(ts), *[F.col(c) for c in tie_breakers],
                     *[F.col(c) for c in others if c != ts and c not in tie_breakers])
    nonnull = F.lit(True)
    for k in keys:
        nonnull = nonnull & F.col(k).isNotNull()
    keyed = df.filter(nonnull)
    picked = (keyed.groupBy(*keys)
              .agg(F.max_by(F.struct(*[F.col(c) for c in others]), order).alias("_row"))
              .select(*keys, "_row.*"))
    return picked.unionByName(df.filter(~nonnull)).select(*df.columns)
