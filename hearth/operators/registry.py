"""A stored dimension whose members keep their keys for good (DM1-DM3, S6).

Facts and reports read the stored members; only a load that may bring new
members looks at its own distinct values.  These are anti-joined with what is
stored, numbered after the highest key, and appended: files that exist are never
written again, and a load that is run twice adds nothing the second time.
One load at a time registers (as one load at a time writes the table).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.operators.dims import NOT_RECORDED
from hearth.operators.keys import sequential_keys


class DimensionRegistry:
    """``<root>/<name>``: ``key``, the member's ``value`` column and ``LoadNumber``
    (the load that brought it; the key-0 member, load 0, is there from the start)."""

    def __init__(self, spark: SparkSession, root: str, name: str, key: str, value: str,
                 unknown: str | None = NOT_RECORDED):
        self.spark, self.key, self.value = spark, key, value
        self.path = f"{root.rstrip('/')}/{name}"
        self.schema = f"{key} int, {value} string, LoadNumber int"
        first = [(0, unknown, 0)] if unknown is not None else []
        (spark.createDataFrame(first, self.schema).coalesce(1)
         .write.mode("ignore").parquet(self.path))

    def stored(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def members(self) -> DataFrame:
        """The dimension: key and value."""
        return self.stored().select(self.key, self.value)

    def register(self, rows: DataFrame, column: str) -> int:
        """Append the values of ``column`` that no member has; NULL is no member.
        Returns the load's number."""
        stored = self.stored()
        # two scalars
        top, load = stored.agg(F.coalesce(F.max(self.key), F.lit(0)),
                               F.coalesce(F.max("LoadNumber"), F.lit(0)) + 1).first()
        new = (rows.select(F.col(column).cast("string").alias(self.value))
               .where(F.col(self.value).isNotNull()).distinct()
               .join(stored.where(F.col(self.key) > 0).select(self.value), self.value, "left_anti"))
        (sequential_keys(new, [self.value], key=self.key, start=top + 1)
         .select(F.col(self.key).cast("int"), self.value, F.lit(load).alias("LoadNumber"))
         .write.mode("append").parquet(self.path))
        return load
