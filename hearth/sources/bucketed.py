"""A merge target as a bucketed Spark table (JN7, MG1).

The target is written with Spark's own ``bucketBy().sortBy().saveAsTable``, so a
merge by key reads it as it is dealt: the source, which is small, is the only
side that is shuffled, to the target's buckets.  The full outer join keeps that
partitioning, so the next version is written bucket by bucket without another
exchange.  A version is a table of its own (``<name>_v<n>``) and never
overwritten; readers keep the one they have.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.operators.aggregates import duplicate_keys
from hearth.operators.keys import latest_per_key


class BucketedTarget:
    """Versions of a bucketed table under ``location`` (a shared folder)."""

    def __init__(self, spark: SparkSession, name: str, location: str, key: Sequence[str] | str,
                 buckets: int):
        self.spark, self.name, self.location = spark, name, location.rstrip("/")
        self.keys = [key] if isinstance(key, str) else list(key)
        self.buckets, self.version = buckets, 0

    def _save(self, df: DataFrame) -> int:
        n = self.version + 1
        (df.write.mode("errorifexists").option("path", f"{self.location}/v{n}")
         .bucketBy(self.buckets, *self.keys).sortBy(*self.keys).saveAsTable(f"{self.name}_v{n}"))
        self.version = n
        return n

    def create(self, rows: DataFrame) -> int:
        """The first version: the one time that all rows are dealt to buckets."""
        return self._save(rows.repartition(self.buckets, *self.keys))

    def read(self, version: int | None = None) -> DataFrame:
        return self.spark.table(f"{self.name}_v{version or self.version}")

    def merged(self, source: DataFrame, ts: str | None = None,
               keep_newer_target: bool = False) -> DataFrame:
        """Target rows with the source's in place of those of the same key, and the
        source's other rows (NULL keys match nothing and stay).  Of equal source
        keys the newest by ``ts`` counts, without ``ts`` they raise;
        ``keep_newer_target`` leaves rows that a late source row would replace."""
        if ts is None:
            whole = F.lit(True)
            for k in self.keys:
                whole = whole & F.col(k).isNotNull()
            if duplicate_keys(source.where(whole), self.keys).limit(1).count():
                raise ValueError("duplicate source keys in merge source")
        else:
            source = latest_per_key(source, self.keys, ts)
        target = self.read()
        columns = target.columns
        t = target.select(*self.keys, F.struct(*columns).alias("_old"))
        s = source.select(*self.keys, F.struct(*columns).alias("_new"))
        wins = F.col("_new").isNotNull()
        if keep_newer_target:
            wins = wins & (F.col("_old").isNull() | (F.col(f"_new.{ts}") > F.col(f"_old.{ts}")))
        row = F.when(F.coalesce(wins, F.lit(False)), F.col("_new")).otherwise(F.col("_old"))
        return t.join(s, self.keys, "full_outer").select(row.alias("_row")).select("_row.*")

    def merge(self, source: DataFrame, ts: str | None = None,
              keep_newer_target: bool = False) -> int:
        return self._save(self.merged(source, ts, keep_newer_target))
