import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from hearth.operators import measures as M
from hearth.operators.selection import exact_median
from tests.conftest import rows


def frame(spark, values, parts=4):
    return spark.createDataFrame(values, "g string, p double").repartition(parts)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 999, 1000])
def test_all_rows(spark, n):
    rng = random.Random(n)
    vals = [rng.choice([rng.randrange(10), rng.random() * 1e6, -rng.expovariate(1e-9)]) for _ in range(n)]
    df = frame(spark, [("a", float(v)) for v in vals])
    assert exact_median(df, "p", "m").first().m == statistics.median(map(float, vals))


def test_groups_of_every_size(spark):
    rng = random.Random(5)
    data = [(f"g{k}", float(rng.choice([rng.randrange(5), rng.gauss(0, 1e3)]))) for k in range(60)
            for _ in range(k)] + [(None, 1.0), (None, 4.0), ("none", None), ("hot", 7.0)] + [("hot", 7.0)] * 999
    got = dict(rows(exact_median(frame(spark, data), "p", "m", by=["g"])))
    want = {g: statistics.median([v for h, v in data if h == g and v is not None])
            for g in {g for g, v in data if v is not None}}
    assert got == want | {"none": None}


def test_values_far_apart_and_extremes(spark):
    wide = [10.0 ** k for k in range(-300, 308, 9)] + [5e-324, 0.0, -0.0, 1e308, -1e308, -1e-300]
    df = frame(spark, [("a", v) for v in wide])
    assert exact_median(df, "p", "m").first().m == statistics.median(wide)
    assert dict(rows(exact_median(df, "p", "m", by=["g"])))["a"] == statistics.median(wide)
    odd = [float("nan")] * 2 + [float("inf"), float("-inf"), 3.0]
    assert exact_median(frame(spark, [("a", v) for v in odd]), "p", "m").first().m == float("inf")
    assert math.isnan(exact_median(frame(spark, [("a", float("nan"))]), "p", "m").first().m)
    assert rows(exact_median(frame(spark, [("a", v) for v in odd]), "p", "m", by=["g"])) == [("a", float("inf"))]


def test_nothing(spark):
    assert exact_median(frame(spark, []), "p", "m").collect()[0].m is None
    assert exact_median(frame(spark, []), "p", "m", by=["g"]).collect() == []


def plan_of(df, capsys):
    df.explain("formatted")
    return capsys.readouterr().out


def test_no_row_is_sorted_or_shuffled(spark, capsys, tmp_path):
    """What the rounds exchange is counts: no range exchange, and in a round's plan the
    rows meet the intervals by a broadcast and are counted before the exchange."""
    from hearth.operators import selection
    plans, real = [], selection.materialize

    def seen(df, name="stage"):
        plans.append((name, plan_of(df, capsys)))
        return real(df, name)

    selection.materialize = seen
    try:
        df = spark.range(100_000).select((F.col("id") % 7).alias("g"), F.rand(3).alias("p"))
        exact_median(df, "p", "m", by=["g"]).collect()
    finally:
        selection.materialize = real
    rounds = [p for name, p in plans if name == "spans"]
    assert len(rounds) > 1
    for p in rounds:
        assert "rangepartitioning" not in p and "SortMergeJoin" not in p
    assert all("BroadcastHashJoin" in p for p in rounds[1:])


def test_measures_with_a_median_among_them(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), ("a", 9), (None, 2)], "County string, SalePrice int")
    names = ["Sales Count", "Median Sale Price", "Highest Sale Price"]
    assert M.evaluate(df, names).columns == ["SalesCount", "MedianSalePrice", "HighestSalePrice"]
    assert rows(M.evaluate(df, names)) == [(4, 3.5, 9)]
    assert rows(M.evaluate(df, names, by=["County"])) == [(None, 1, 2.0, 2), ("a", 3, 5.0, 9)]
    assert rows(M.evaluate(df, ["Median Sale Price"])) == [(3.5,)]
    assert "Median Sale Price" not in M.REGISTRY
