"""Stand-in cubes of several shapes: counts of orders by two, three and four
dimensions, one document per region and number of dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.operators import cube as oc
from hearth.operators import cube_variant as cv
from hearth.session import materialize
from hearth.sources import standins as st

# dimension id → (code column, label column), in document order
DIMS = {"STATUS": ("StatusCode", "Status"), "TLIST(A1)": ("YearCode", "Year"),
        "PRIORITY": ("PriorityCode", "Priority"), "SEGMENT": ("SegmentCode", "Segment")}
UPDATED = "2024-06-30T00:00:00.000Z"


def order_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per region, status, year, priority and segment."""
    o = st.table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderdate",
                                                 "o_orderpriority")
    c = st.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = st.table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    year = F.year("o_orderdate").cast("string")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey)
            .groupBy(F.col("n_regionkey").alias("RegionKey"),
                     F.col("o_orderstatus").alias("StatusCode"),
                     F.concat(F.lit("Status "), "o_orderstatus").alias("Status"),
                     year.alias("YearCode"), F.concat(F.lit("Year "), year).alias("Year"),
                     F.substring("o_orderpriority", 1, 1).alias("PriorityCode"),
                     F.col("o_orderpriority").alias("Priority"),
                     F.col("c_mktsegment").alias("SegmentCode"),
                     F.lower("c_mktsegment").alias("Segment"))
            .agg(F.count(F.lit(1)).alias("n")))


def cube_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``Document`` ('<dimensions>-<region>') and its JSON-stat ``value``: places as an
    object in odd regions, sparse values where region + dimensions is even, in an
    array in regions divisible by 3."""
    fine = materialize(order_counts(spark, sf_dir), "order-counts")
    parts = []
    for k in range(2, len(DIMS) + 1):
        dims = [(dim, *columns) for dim, columns in list(DIMS.items())[:k]]
        long = (fine.groupBy("RegionKey", *[c for d in dims for c in d[1:]])
                .agg(F.sum("n").cast("double").alias("Value")).withColumn("Unit", F.lit("Orders")))
        packed = oc.cube_pack(long, ["RegionKey"], dims, label=f"Orders by {k} dimensions",
                              updated=UPDATED)
        region = F.col("RegionKey")
        parts.append(packed.select(
            F.concat(F.lit(f"{k}-"), region.cast("string")).alias("Document"),
            cv.cube_text(F.col("doc"), places=region % 2 == 1, sparse=(region + k) % 2 == 0,
                         in_array=region % 3 == 0).alias("value")))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def damaged_texts(texts: DataFrame) -> DataFrame:
    """Each text once more, with one part that doesn't fit, by its number of dimensions
    (its first character)."""
    k = F.substring("Document", 1, 1)
    return texts.select(
        F.concat(F.lit("bad-"), "Document").alias("Document"),
        F.when(k == "2", F.regexp_replace("value", '"STATUS",', ""))          # a dimension less
        .when(k == "3", F.regexp_replace("value", '"size":\\[(\\d+)', '"size":[9$1'))
        .otherwise(F.regexp_replace("value", '\\},"value":', '},"values":')).alias("value"))
