"""Incremental loads: upsert merge, high-watermark windows, control tables
(MG1-MG8, WN2) and a versioned snapshot store (SK1, SK2, MG2).

Delta Lake is not assumed.  A merge produces a new DataFrame
(``target ▷ source ∪ source``); the snapshot store writes it as the next
version directory and never overwrites the version being read.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hearth.functions.dates import seconds_between
from hearth.operators.aggregates import duplicate_keys
from hearth.operators.keys import latest_per_key
from hearth.session import materialize


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _all_not_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def merge_upsert(target: DataFrame, source: DataFrame, key: Sequence[str] | str,
                 ts: str | None = None, strict: bool = False,
                 keep_newer_target: bool = False) -> DataFrame:
    """MG1: matched target rows are replaced by the source row, unmatched
    source rows are inserted.  Key equality never matches NULL, so NULL-key
    rows on both sides survive (as with SQL MERGE).

    * duplicate source keys (S9): the newest by ``ts`` wins (WN2); with
      ``strict``, or without a ``ts`` that could tell, they raise.
    * ``keep_newer_target``: a late source row (``source.ts <= target.ts``)
      does not replace the target row.

    Plan: the source's keys are anti-joined against the target — when the
    source is small, AQE broadcasts it and the target is scanned once
    without a shuffle.
    """
    keys = _keys(key)
    src = source
    if strict or ts is None:
        # one bounded action: is there any duplicated source key?
        if duplicate_keys(src.filter(_all_not_null(keys)), keys).limit(1).count():
            raise ValueError("duplicate source keys in merge source")
    elif ts is not None:
        # read twice below (keys and rows), so it is made once
        src = materialize(latest_per_key(src, keys, ts), "merge_source")
    if keep_newer_target:
        if ts is None:
            raise ValueError("keep_newer_target needs ts")
        t_ts = target.select(*keys, F.col(ts).alias("_tts"))
        src = (src.join(t_ts, keys, "left")
               .filter(F.col("_tts").isNull() | (F.col(ts) > F.col("_tts")))
               .drop("_tts"))
    src_keys = src.select(*keys).filter(_all_not_null(keys))
    kept = target.join(src_keys.distinct(), keys, "left_anti")
    return kept.unionByName(src.select(*target.columns))


# --- high watermark (MG3-MG5) -----------------------------------------------------------------
def wall_clock_literal(value) -> Column:
    """A watermark value as a zone-free timestamp literal.  A Python
    ``datetime`` goes through its ISO text, so it means the same wall clock
    whatever the session or process time zone; Columns pass through."""
    if isinstance(value, Column):
        return value
    if isinstance(value, (dt.datetime, dt.date)):
        return F.lit(value.isoformat(sep=" ") if isinstance(value, dt.datetime)
                     else value.isoformat()).cast("timestamp_ntz")
    return F.lit(value)


def incremental_window(df: DataFrame, ts: str, last, current) -> DataFrame:
    """MG3: rows newer than the last watermark up to the current one,
    ``(last, current]``.  Bare-column comparisons push down to the scan."""
    return df.filter((F.col(ts) > wall_clock_literal(last))
                     & (F.col(ts) <= wall_clock_literal(current)))


def watermark_probe(df: DataFrame, ts: str, last) -> DataFrame:
    """MG4: one row — the source's current maximum and whether it is newer."""
    return df.agg(F.max(ts).alias("CurrentWatermark")).withColumn(
        "HasNewData", F.coalesce(F.col("CurrentWatermark") > wall_clock_literal(last),
                                 F.lit(False)))


def advance_watermark(watermarks: DataFrame, probes: DataFrame,
                      updated_at, name_col: str = "DatasetName") -> DataFrame:
    """MG5: move ``LastWatermarkValue`` forward for datasets whose probe found
    newer data; other rows are unchanged.  Of several probes of one dataset
    the largest counts.  Call it last, after the branch succeeded."""
    p = probes.groupBy(F.col(name_col).alias("_n")).agg(F.max("CurrentWatermark").alias("_cw"))
    j = watermarks.join(p, watermarks[name_col] == p["_n"], "left")
    moved = F.col("_cw").isNotNull() & (F.col("_cw") > F.col("LastWatermarkValue"))
    return j.select(*[
        (F.when(moved, F.col("_cw")).otherwise(F.col(c)).alias(c) if c == "LastWatermarkValue"
         else F.when(moved, F.lit(updated_at).cast(watermarks.schema[c].dataType))
         .otherwise(F.col(c)).alias(c) if c == "UpdatedAt"
         else F.col(c)) for c in watermarks.columns])


# --- run log transitions (MG6) -------------------------------------------------------------------
def run_log_start(log: DataFrame, starts: DataFrame) -> DataFrame:
    """Insert 'Running' rows (no end) for new child executions."""
    rows = starts.withColumns({"RunStatus": F.lit("Running"),
                               "EndTime": F.lit(None).cast(log.schema["EndTime"].dataType),
                               "DurationSeconds": F.lit(None).cast("int"),
                               "ErrorMessage": F.lit(None).cast("string")})
    return log.unionByName(rows.select(*log.columns))


def run_log_finish(log: DataFrame, finishes: DataFrame,
                   keys: Sequence[str] = ("ParentRunID", "PipelineConfigID")) -> DataFrame:
    """Close rows of the given (run, config) that are still Running with the
    final status, end time, duration and error text (success or failure).
    Two finishes of one key are an error (one bounded action)."""
    keys = list(keys)
    if duplicate_keys(finishes, keys).limit(1).count():
        raise ValueError("more than one finish for a run and configuration")
    f = finishes.select(*keys, F.col("RunStatus").alias("_st"), F.col("EndTime").alias("_end"),
                        F.col("ErrorMessage").alias("_err"))
    j = log.join(f, keys, "left")
    upd = F.col("_st").isNotNull() & (F.col("RunStatus") == "Running")
    secs = seconds_between("StartTime", "_end").cast("int")
    repl = {"RunStatus": F.col("_st"), "EndTime": F.col("_end"),
            "DurationSeconds": secs, "ErrorMessage": F.col("_err")}
    return j.select(*[F.when(upd, repl[c]).otherwise(F.col(c)).alias(c) if c in repl
                      else F.col(c) for c in log.columns])


def active_pipelines(config: DataFrame) -> DataFrame:
    """MG7: active configuration rows (present with ``orderBy('ExecutionOrder')``)."""
    return config.filter(F.col("IsActive"))


def config_upsert(config: DataFrame, changes: DataFrame,
                  key: str = "PipelineConfigID") -> DataFrame:
    """MG8: update existing configuration rows, insert new ones."""
    return merge_upsert(config, changes, key)


# --- snapshot store (SK1, SK2, MG2) --------------------------------------------------------------
class SnapshotStore:
    """Versioned Parquet snapshots: ``<root>/<table>/version=<n>``.

    A write always goes to a new version directory; a version becomes
    visible only after Spark's job commit has moved its files in, so
    readers never see a half-written snapshot and a merge may read the
    current version while writing the next.  ``root`` must be on a shared
    file system on a cluster (e.g. under ``spark.checkpoint.dir``)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def versions(self, table: str) -> list[int]:
        fs, p = self._fs(f"{self.root}/{table}")
        if not fs.exists(p):
            return []
        out = []
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith("version="):
                ok = fs.exists(st.getPath().suffix("/_SUCCESS"))
                if ok:
                    out.append(int(name.split("=", 1)[1]))
        return sorted(out)

    def exists(self, table: str) -> bool:
        return bool(self.versions(table))

    def read(self, table: str, version: int | None = None) -> DataFrame:
        vs = self.versions(table)
        if not vs:
            raise FileNotFoundError(f"no snapshot of {table} under {self.root}")
        v = vs[-1] if version is None else version
        return self.spark.read.parquet(f"{self.root}/{table}/version={v}")

    def overwrite(self, df: DataFrame, table: str, keep_schema: bool = False) -> int:
        """SK1 (replace data and schema) / SK2 (``keep_schema``: the new data
        must have the current schema)."""
        vs = self.versions(table)
        if keep_schema and vs:
            cur = self.read(table).schema
            if [(f.name, f.dataType) for f in cur] != [(f.name, f.dataType) for f in df.schema]:
                raise ValueError(f"schema of {table} would change")
        v = (vs[-1] + 1) if vs else 1
        df.write.mode("errorifexists").parquet(f"{self.root}/{table}/version={v}")
        return v

    def overwrite_counted(self, df: DataFrame, table: str, keep_schema: bool = False
                          ) -> tuple[int, int]:
        """SK6 / DQ5 without a second look: the new version and its number of rows, as
        the writing job counted them."""
        seen = Observation()
        v = self.overwrite(df.observe(seen, F.count(F.lit(1)).alias("rows")), table, keep_schema)
        return v, seen.get["rows"]

    def create_or_merge(self, source: DataFrame, table: str, key, ts: str | None = None) -> int:
        """MG2: first load creates the table, later loads merge into it."""
        if not self.exists(table):
            return self.overwrite(source, table)
        return self.overwrite(merge_upsert(self.read(table), source, key, ts), table)

    def readback_check(self, table: str, expected: int) -> bool:
        """SK6: the written snapshot has the expected row count."""
        return self.read(table).count() == expected


class BucketedTable:
    """An upsert target hash-partitioned into ``buckets`` folders by key
    (``bucket = pmod(xxhash64(key), buckets)``).

    ``upsert`` rewrites only the buckets the source hits: they are read
    (partition pruning), merged, staged once, and replaced with *dynamic*
    partition overwrite.  A batch of scattered keys hits all buckets, so the
    count should follow the target's size.  It is kept with the table; opening
    it with another count is an error, as keys would move.  NULL keys, which no
    replay could match again, are an error too.  Merging is idempotent, so
    re-running a batch after a failure during the folder swap converges to the
    same table; readers during the swap may see buckets of both states.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        kept = self._kept_buckets()
        if kept is not None and kept != buckets:
            raise ValueError(f"{path} has {kept} buckets, not {buckets}")

    def _fs(self):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _kept_buckets(self) -> int | None:
        fs, p = self._fs()
        names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
        return next((int(n.split("=")[1]) for n in names if n.startswith("_buckets=")), None)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int")

    def exists(self) -> bool:
        fs, p = self._fs()
        return fs.exists(p.suffix("/_SUCCESS")) or (
            fs.exists(p) and any(st.getPath().getName().startswith("bucket=")
                                 for st in fs.listStatus(p)))

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).drop("bucket")

    def upsert(self, source: DataFrame, ts: str | None = None,
               keep_newer_target: bool = False) -> None:
        from hearth.session import materialize
        if source.filter(F.col(self.key).isNull()).limit(1).count():
            raise ValueError("NULL keys can't be merged")
        src = source.withColumn("bucket", self._bucket())
        # one task per bucket, so one file per bucket
        writer = lambda df: (df.repartition("bucket").write.mode("overwrite")
                             .option("partitionOverwriteMode", "dynamic")
                             .partitionBy("bucket").parquet(self.path))
        if not self.exists():
            first = latest_per_key(src, self.key, ts) if ts else src
            writer(first)
            fs, p = self._fs()
            fs.mkdirs(p.suffix(f"/_buckets={self.buckets}"))
            return
        touched = [r[0] for r in src.select("bucket").distinct().collect()]  # ≤ buckets ints
        current = self.spark.read.parquet(self.path).filter(F.col("bucket").isin(touched))
        merged = merge_upsert(current, src.select(*current.columns), self.key, ts=ts,
                              keep_newer_target=keep_newer_target)
        # stage first: the swap must not read the folders it replaces
        writer(materialize(merged, "bucket-stage"))
