"""Exact middle values by selection: counts per value bucket, narrowed to the
bucket of the wanted rank and counted again, until a bucket holds one value.

Rows are never sorted nor shuffled.  A round is one scan of the stored column
with map-side counts; what travels is at most ``BUCKETS`` + 2 counts per
partition and interval (a group has one, or two where its middle ranks fall
apart).  Buckets keep their own least and greatest value, so the next interval
ends at values that occur; both ends have buckets of their own, so every round
leaves fewer values and the loop ends whatever the distribution.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.session import materialize

BUCKETS = 4096


def _bucket(v: Column, lo: Column, hi: Column) -> Column:
    """Place of ``v`` in [lo, hi], ascending with it; halves, as hi - lo may overflow."""
    part = F.try_divide(v / 2 - lo / 2, hi / 2 - lo / 2)
    inner = F.least(F.floor(F.nanvl(F.coalesce(part, F.lit(0.0)), F.lit(0.0)) * BUCKETS),
                    F.lit(BUCKETS - 1))
    return F.when(v == lo, 0).when(v == hi, BUCKETS + 1).otherwise(1 + inner)


def _middle(lo: Column, hi: Column) -> Column:
    return F.when(lo == hi, lo).otherwise(lo + (hi - lo) * 0.5)


def _same(a: float, b: float) -> bool:
    return a == b or (a != a and b != b)


def _ranks(n: Column) -> Column:
    """1-based middle ranks of n values: one, or two if n is even."""
    return F.array_distinct(F.array(F.call_function("div", n + 1, F.lit(2)),
                                    F.call_function("div", n + 2, F.lit(2))))


def _median_of_all(vals: DataFrame, out: str) -> DataFrame:
    spark = vals.sparkSession
    n, lo, hi = vals.agg(F.count("_v"), F.min("_v"), F.max("_v")).first()
    open_, found = ({(lo, hi): sorted({(n + 1) // 2, (n + 2) // 2})} if n else {}), []
    while open_:
        found += [span[0] for span in open_ if _same(*span)]
        spans = [(span, needs) for span, needs in open_.items() if not _same(*span)]
        if not spans:
            break
        v, which, bucket = F.col("_v"), F.lit(None), F.lit(None)
        for k, ((lo, hi), _) in enumerate(spans):
            inside = v.between(F.lit(lo), F.lit(hi))
            which = F.when(inside, k).otherwise(which)
            bucket = F.when(inside, _bucket(v, F.lit(lo), F.lit(hi))).otherwise(bucket)
        held = F.lit(False)
        for (lo, hi), _ in spans:
            held = held | v.between(F.lit(lo), F.lit(hi))
        # at most two intervals of BUCKETS + 2 counts
        counts = (vals.where(held).groupBy(which.alias("k"), bucket.alias("b"))
                  .agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
                  .collect())
        open_, before = {}, [0] * len(spans)
        for r in sorted(counts, key=lambda r: (r["k"], r["b"])):
            for need in spans[r["k"]][1]:
                if before[r["k"]] < need <= before[r["k"]] + r["n"]:
                    open_.setdefault((r["lo"], r["hi"]), []).append(need - before[r["k"]])
            before[r["k"]] += r["n"]
    found.sort(key=lambda v: (v != v, v))     # NaN is the greatest, as in Spark
    value = F.lit(None).cast("double") if not found else _middle(F.lit(found[0]), F.lit(found[-1]))
    return spark.range(1).select(value.alias(out))


def _median_by(vals: DataFrame, by: list[str], out: str) -> DataFrame:
    group = [f"_g{k}" for k in range(len(by))]
    vals = vals.select(*[F.col(b).alias(g) for b, g in zip(by, group, strict=True)], "_v")
    spans = vals.groupBy(*group).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"),
                                     _ranks(F.count("_v")).alias("_needs"))
    done = []
    while True:
        # one or two rows per group
        told = materialize(spans.select("*", F.explode("_needs").alias("_need")).drop("_needs"), "spans")
        done.append(told.where("_lo = _hi").select(*group, "_lo"))
        left = told.where("_lo < _hi")
        if left.isEmpty():
            break
        wanted = left.groupBy(*group, "_lo", "_hi").agg(F.collect_list("_need").alias("_needs"))
        wanted = wanted.withColumnsRenamed({g: f"_of{g}" for g in group})
        on = F.col("_v").between(F.col("_lo"), F.col("_hi"))
        for g in group:
            on = on & F.col(g).eqNullSafe(F.col(f"_of{g}"))
        interval = [*group, "_lo", "_hi", "_needs"]
        counts = (vals.join(wanted, on)
                  .groupBy(*interval, _bucket(F.col("_v"), F.col("_lo"), F.col("_hi")).alias("_b"))
                  .agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_least"),
                       F.max("_v").alias("_most")))
        upto = F.sum("_n").over(Window.partitionBy(*interval).orderBy("_b"))
        need = F.transform(F.filter("_needs", lambda x: (x > F.col("_before")) & (x <= F.col("_upto"))),
                           lambda x: x - F.col("_before"))
        spans = (counts.withColumn("_upto", upto).withColumn("_before", F.col("_upto") - F.col("_n"))
                 .select(*group, F.col("_least").alias("_lo"), F.col("_most").alias("_hi"),
                         need.alias("_needs")))
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return found.groupBy(*group).agg(_middle(F.min("_lo"), F.max("_lo")).alias(out))


def exact_median(df: DataFrame, col: str, out: str = "Median", by: Sequence[str] = (),
                 stored: bool = False) -> DataFrame:
    """Exact median of a column, per group of ``by`` (NULL groups too; a group without
    values has a NULL median): the mean of the middle two of an even number, as
    ``median``.  The column is written once and scanned in every round; ``stored``
    says that ``df`` is such a table already."""
    by = list(by)
    vals = df.select(*by, F.col(col).cast("double").alias("_v"))
    if not stored:
        vals = materialize(vals, "median-values")
    if not by:
        return _median_of_all(vals.where("_v is not null"), out)
    found = _median_by(vals.where("_v is not null"), by, out)
    groups = vals.select(*by).distinct()
    return groups.join(found, [F.col(b).eqNullSafe(F.col(f"_g{k}")) for k, b in enumerate(by)],
                       "left").select(*by, out)
