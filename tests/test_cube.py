import json

import pytest
from pyspark.sql import functions as F

from hearth.operators import cube as oc
from hearth.plans import vacancy as vc
from tests.conftest import rows


def doc_2x2x2(values, wrap=False, with_unit=True, size=None):
    d = {
        "label": "t", "source": "s", "updated": "2024-01-01T00:00:00.000Z",
        "id": ["S", "Q", "A"], "size": size or [2, 2, 2],
        "dimension": {
            "S": {"label": "S", "category": {
                "index": ["s1", "s2"], "label": {"s1": "Stat 1", "s2": "Stat 2"},
                **({"unit": {"s1": {"label": "Number"}, "s2": {"label": "%"}}} if with_unit else {})}},
            "Q": {"label": "Q", "category": {"index": ["q1", "q2"],
                                             "label": {"q1": "2024Q1", "q2": "2024Q2"}}},
            "A": {"label": "A", "category": {"index": ["a1", "a2"],
                                             "label": {"a1": "Alpha", "a2": "Beta"}}},
        },
        "value": values,
    }
    text = json.dumps(d)
    return f"[{text}]" if wrap else text


def parse(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    return vc.parse_documents(df)


def test_flatten_row_major_with_null(spark):
    vals = [1.0, 2.0, 3.0, None, 5.0, 6.0, 7.0, 8.0]
    for wrap in (False, True):                       # object or one-element array
        flat = oc.cube_flatten(parse(spark, [doc_2x2x2(vals, wrap)]), ["S", "Q", "A"])
        got = rows(flat.select("0_code", "1_code", "2_code", "2_label", "Unit", "Value"),
                   ["0_code", "1_code", "2_code"])
        assert got[0] == ("s1", "q1", "a1", "Alpha", "Number", 1.0)
        assert got[3] == ("s1", "q2", "a2", "Beta", "Number", None)   # NULL cell kept
        assert got[4] == ("s2", "q1", "a1", "Alpha", "%", 5.0)
        assert len(got) == 8


def test_missing_unit_is_null(spark):
    flat = oc.cube_flatten(parse(spark, [doc_2x2x2([1.0] * 8, with_unit=False)]),
                           ["S", "Q", "A"])
    assert {r.Unit for r in flat.collect()} == {None}


def test_validate_and_strict(spark):
    docs = parse(spark, [doc_2x2x2([1.0] * 7)])
    v = oc.cube_validate(docs).select("ExpectedCells", "ValueCount", "IsValid").first()
    assert tuple(v) == (8, 7, False)
    with pytest.raises(Exception):
        oc.require_valid(docs).collect()


def test_pack_then_flatten_round_trip(spark):
    long_rows = [("g", s, f"S{s}", q, f"Q{q}", a, f"A{a}", "u", float(i))
                 for i, (s, q, a) in enumerate((s, q, a) for s in "xy" for q in "12"
                                              for a in "mn") if i != 3]
    long_df = spark.createDataFrame(long_rows, "g string, s string, sl string, q string, "
                                               "ql string, a string, al string, u string, "
                                               "v double")
    packed = oc.cube_pack(long_df, ["g"], [("S", "s", "sl"), ("Q", "q", "ql"), ("A", "a", "al")],
                          value_col="v", unit_col="u")
    text = packed.select(F.to_json("doc").alias("value"))
    flat = oc.cube_flatten(vc.parse_documents(text), ["S", "Q", "A"])
    got = rows(flat.select("0_code", "1_code", "2_code", "Value"))
    want = sorted([(s, q, a, float(i) if i != 3 else None)
                   for i, (s, q, a) in enumerate((s, q, a) for s in "xy" for q in "12"
                                                for a in "mn")],
                  key=lambda t: tuple(str(x) for x in t))
    assert got == want                                  # absent cell decoded as NULL


def test_pivot_duplicate_and_missing(spark):
    df = spark.createDataFrame([("k", "A", 1.0), ("k", "A", 3.0), ("j", "B", 2.0)],
                               "key string, stat string, Value double")
    w = oc.pivot_measures(df, ["key"], "stat", {"A": "a", "B": "b", "C": "c"})
    assert rows(w, ["key"]) == [("j", None, 2.0, None), ("k", 3.0, None, None)]


def test_vacancy_rate_zero_and_null_stock(spark):
    df = spark.createDataFrame([(5, 0), (5, None), (1, 3)], "v long, s long")
    got = [r[0] for r in df.select(oc.vacancy_rate("v", "s")).collect()]
    assert got == [None, None, 33.3]


def test_flatten_explodes_cells_only(spark):
    """No row after the explode carries the document or its arrays."""
    text = spark.createDataFrame([("{}",)], "value string")
    flat = oc.cube_flatten(vc.parse_documents(text), ["S", "Q", "A"])
    plan = flat._jdf.queryExecution().optimizedPlan().toString()
    generate = next(line for line in plan.splitlines() if "Generate inline" in line)
    assert "doc#" not in generate.split("], false")[0].rsplit("[", 1)[-1]
    assert flat.collect() == []
