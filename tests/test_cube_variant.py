import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from hearth.operators import cube_variant as cv
from hearth.plans import cubes as cb
from tests.conftest import rows


def axis(codes, index="array", labels=True, unit=None):
    cat = {}
    if index == "array":
        cat["index"] = codes
    elif index == "object":     # keys in another order than their places
        cat["index"] = {c: k for k, c in reversed(list(enumerate(codes)))}
    if labels or index is None:
        cat["label"] = {c: c.upper() for c in codes}
    if unit:
        cat["unit"] = {c: {"label": u} for c, u in unit.items()}
    return {"label": "x", "category": cat}


def document(value, size, dims, wrap=False, **more):
    d = {"label": "t", "updated": "2024", "id": list(dims), "size": size, "dimension": dims,
         "value": value, **more}
    return json.dumps([d, {"id": []}] if wrap else d)


def decode(spark, *texts, **options):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "Document int, value string")
    cubes = cv.parse_cubes(df, keep=["Document"])
    return cv.decode_cubes(cubes, keep=["Document"], **options)


def cells(df):
    told = df.select("Document", "Position", F.array_join(F.map_values("Codes"), "").alias("c"),
                     F.array_join(F.map_values("Labels"), "").alias("l"), "Unit", "Value")
    return [tuple(r) for r in told.orderBy("Document", "Position").collect()]


def test_two_three_and_four_dimensions(spark):
    a, b, c, d = axis(["a", "b"]), axis(["c", "d"], "object"), axis(["e"]), axis(["f", "g", "h"])
    got = cells(decode(
        spark, document([1, 2, 3, 4], [2, 2], {"A": a, "B": b}),
        document([1, None, 3, 4], [2, 1, 2], {"A": a, "C": c, "B": b}, wrap=True),
        document({"0": 1, "11": 2.5, "4": None}, [2, 2, 1, 3], {"B": b, "A": a, "C": c, "D": d})))
    assert [x[1:3] + x[5:] for x in got if x[0] == 0] == [
        (0, "ac", 1.0), (1, "ad", 2.0), (2, "bc", 3.0), (3, "bd", 4.0)]
    assert [x[2] + str(x[5]) for x in got if x[0] == 1] == ["aec1.0", "aedNone", "bec3.0", "bed4.0"]
    third = [x for x in got if x[0] == 2]
    assert [x[1] for x in third] == list(range(12))
    assert [(x[2], x[5]) for x in third if x[5] is not None] == [("caef", 1.0), ("dbeh", 2.5)]
    assert third[4][3] == "CBEG"


def test_units_labels_and_absent_parts(spark):
    got = cells(decode(spark, document([1, 2], [1, 2], {
        "A": axis(["a"], None), "B": axis(["c", "d"], labels=False, unit={"c": "Number"})})))
    assert [x[2:5] for x in got] == [("ac", "Ac", "Number"), ("ad", "Ad", None)]


def test_present_cells_come_from_the_values(spark):
    huge = document({"999999999999": 7}, [10**6, 10**6], {
        "A": axis([str(k) for k in range(3)]), "B": axis(["c"])})
    fits = document({"3": 7, "1": None}, [2, 2], {"A": axis(["a", "b"]), "B": axis(["c", "d"])})
    dense = document([None, 5], [1, 2], {"A": axis(["a"]), "B": axis(["c", "d"])})
    got = cells(decode(spark, huge, fits, dense, present=True, strict=False))
    assert [(x[0], x[1], x[2], x[5]) for x in got] == [(1, 3, "bd", 7.0), (2, 1, "ad", 5.0)]


BROKEN = [
    ("not json", "no dimensions"), ("[]", "no dimensions"), ("{}", "no dimensions"),
    (document([1], [1], {}), "no dimensions"),
    (document([1], [1], {"A": {"label": "x"}}), "a dimension without categories"),
    (document([1, 2], [2], {"A": axis(["a"])}), "a dimension of another size"),
    (document([1, 2], [], {"A": axis(["a", "b"])}), "a dimension of another size"),
    (document("x", [1], {"A": axis(["a"])}), "no values"),
    (document([1, 2], [1], {"A": axis(["a"])}), "a number of values that is not the product of the sizes"),
    (document({"1": 2}, [1], {"A": axis(["a"])}), "a value outside the product of the sizes"),
    (document({"x": 2}, [1], {"A": axis(["a"])}), "a value outside the product of the sizes")]


def test_problems(spark):
    texts = [t for t, _ in BROKEN] + [document([1], [1], {"A": axis(["a"])}), None]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "Document int, value string")
    got = cv.check_cubes(cv.parse_cubes(df, keep=["Document"])).select("Document", "Problem")
    assert rows(got, ["Document"]) == [*enumerate(p for _, p in BROKEN), (len(BROKEN), None),
                                       (len(BROKEN) + 1, "no dimensions")]


@pytest.mark.parametrize("text, problem", BROKEN[5:9:3])
def test_strict_decoding_fails_the_job(spark, text, problem):
    with pytest.raises(PySparkException, match=problem):
        decode(spark, text).collect()


def test_columns_of_dimensions_that_a_document_lacks(spark):
    two = document([1], [1, 1], {"A": axis(["a"]), "B": axis(["b"])})
    one = document([2], [1], {"A": axis(["a"])})
    got = cv.cube_columns(decode(spark, two, one), {"A": "First", "B": "Second"}, ["Document"])
    assert got.columns == ["Document", "FirstCode", "First", "SecondCode", "Second", "Unit", "Value"]
    assert rows(got, ["Document"]) == [(0, "a", "A", "b", "B", None, 1.0), (1, "a", "A", None, None, None, 2.0)]


def test_written_shapes_read_back(spark):
    texts = cb.cube_texts(spark, "/root/testdata/sf0.001")
    firsts = {r["Document"]: r["value"] for r in texts.collect()}
    assert len(firsts) == 15 and {k[0] for k in firsts} == {"2", "3", "4"}
    assert any(t.startswith("[") for t in firsts.values()) and any(t.startswith("{") for t in firsts.values())
    documents = [json.loads(t) for t in firsts.values()]
    documents = [d[0] if isinstance(d, list) else d for d in documents]
    shapes = {(type(d["value"]), type(next(iter(d["dimension"].values()))["category"]["index"]))
              for d in documents}
    assert shapes == {(list, list), (list, dict), (dict, list), (dict, dict)}
