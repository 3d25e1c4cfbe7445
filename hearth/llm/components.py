"""Connected components of an edge table by alternating large-star and
small-star rounds.

Each round is two grouped minima joined back to their edges; the edges are
stored after every round, so lineage stays short.  The number of rounds grows
with the logarithm of a component's longest path, and the edges never exceed
those given.  A hub with very many edges is pre-aggregated for the minimum;
the join back has one row per node on its other side, so Spark can split it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.session import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(``node``, ``root``) for every node that has an edge: ``root`` is the
    smallest node it can reach.  Self-edges and nulls are ignored; no edges
    give no rows."""
    links = materialize(
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        # large-star: bigger neighbours of u point at the smallest node around u
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        # small-star: u and its smaller neighbours point at the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u")
                 .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
                         .alias("e")).select("e.u", "e.v").where("u <> v").distinct())
        links = materialize(small, "stars")
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(now) == seen:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = tuple(now)
