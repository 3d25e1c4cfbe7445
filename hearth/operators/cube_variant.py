"""Statistics cubes whose dimensions come from the document itself (JS1-JS3).

``cube.py`` decodes documents of one declared shape with three named dimensions.
Here nothing is declared: a document is parsed as a VARIANT, its dimensions are
those of its own ``id``, strides follow from its own ``size``, and every shape
that JSON-stat allows is read:

* a document as an object or as the first element of an array;
* ``category.index`` as an array of codes, as an object code -> place, or absent
  (then the labels' keys are the codes); ``category.label`` may be absent too;
* ``value`` as an array, or as a sparse object place -> value;
* units on whichever dimension carries them.

Parsing, checking and decoding are expressions inside a row; only cells leave it.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _get(v: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(v, path, kind)


# --- JS1 ---------------------------------------------------------------------------------------
def open_cube(text) -> Column:
    """The document as a VARIANT; NULL where the text isn't JSON."""
    v = F.try_parse_json(F.col(text) if isinstance(text, str) else text)
    return F.coalesce(_get(v, "$[0]", "variant"), v)


def cube_axes(doc: Column) -> Column:
    """``id``, ``size``, ``stride``, ``codes``, ``labels`` and ``units`` of each dimension,
    in the order of the document's ``id``."""
    sizes = _get(doc, "$.size", "array<bigint>")
    dims = _get(doc, "$.dimension", "map<string,variant>")

    def axis(dim: Column, i: Column) -> Column:
        cat = _get(F.try_element_at(dims, dim), "$.category", "variant")
        label = _get(cat, "$.label", "map<string,string>")
        unit = _get(cat, "$.unit", "map<string,variant>")
        places = F.map_entries(_get(cat, "$.index", "map<string,bigint>"))
        by_place = F.array_sort(F.transform(places, lambda e: F.struct(e["value"], e["key"])))
        codes = F.coalesce(_get(cat, "$.index", "array<string>"),
                           F.transform(by_place, lambda e: e["key"]), F.map_keys(label))
        after = F.slice(sizes, i + 2, F.greatest(F.lit(0), F.size(sizes)))
        return F.struct(
            dim.alias("id"), F.try_element_at(sizes, i + 1).alias("size"),
            F.aggregate(after, F.lit(1).cast("bigint"), lambda a, s: a * s).alias("stride"),
            codes.alias("codes"),
            F.transform(codes, lambda c: F.coalesce(F.try_element_at(label, c), c)).alias("labels"),
            F.transform(codes, lambda c: _get(F.try_element_at(unit, c), "$.label", "string"))
            .alias("units"))

    return F.transform(_get(doc, "$.id", "array<string>"), axis)


def parse_cubes(texts: DataFrame, text_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` plus the document's ``Label``, ``Updated``, ``Axes``, and its values as
    ``Dense`` (array) or ``Sparse`` (place -> value)."""
    doc = F.col("_doc")
    return texts.select(*keep, open_cube(text_col).alias("_doc")).select(
        *keep, _get(doc, "$.label", "string").alias("Label"),
        _get(doc, "$.updated", "string").alias("Updated"), cube_axes(doc).alias("Axes"),
        _get(doc, "$.value", "array<double>").alias("Dense"),
        _get(doc, "$.value", "map<string,double>").alias("Sparse"))


# --- JS2 ---------------------------------------------------------------------------------------
def check_cubes(cubes: DataFrame) -> DataFrame:
    """Adds ``ExpectedCells``, ``ValueCount`` and ``Problem`` (NULL: the document's parts
    fit) to the frame of ``parse_cubes``."""
    cells = F.aggregate("Axes", F.lit(1).cast("bigint"), lambda a, x: a * x["size"])
    place = F.map_keys("Sparse")
    problem = (
        F.when(F.coalesce(F.size("Axes"), F.lit(0)) <= 0, "no dimensions")
        .when(F.exists("Axes", lambda x: x["codes"].isNull()), "a dimension without categories")
        .when(F.exists("Axes", lambda x: ~x["size"].eqNullSafe(F.size(x["codes"]).cast("bigint"))),
              "a dimension of another size")
        .when(F.col("Dense").isNull() & F.col("Sparse").isNull(), "no values")
        .when(F.col("Dense").isNotNull() & (F.size("Dense") != F.col("ExpectedCells")),
              "a number of values that is not the product of the sizes")
        .when(F.exists(place, lambda k: ~F.coalesce(
            k.try_cast("bigint").between(0, F.col("ExpectedCells") - 1), F.lit(False))),
            "a value outside the product of the sizes"))
    count = F.when(F.col("Dense").isNotNull(), F.size("Dense")).when(
        F.col("Sparse").isNotNull(), F.size("Sparse")).cast("bigint")
    return cubes.withColumns({"ExpectedCells": cells, "ValueCount": count}).withColumn(
        "Problem", problem)


# --- JS3 ---------------------------------------------------------------------------------------
def decode_cubes(cubes: DataFrame, keep: Sequence[str] = (), present: bool = False,
                 strict: bool = True) -> DataFrame:
    """One row per cell: ``keep``, ``Updated``, ``Position`` (row-major), ``Codes`` and
    ``Labels`` (maps by dimension, in document order), ``Unit`` and ``Value``.

    Every cell is a row, those without a value too; with ``present`` only cells
    that have one, found from the values and not from the product of the sizes.
    A document whose parts don't fit fails the job, or is left out without ``strict``
    (``check_cubes`` lists it)."""
    checked = check_cubes(cubes)
    message = F.concat(F.lit("cube with "), F.col("Problem"))
    axes = F.when(F.col("Problem").isNull(), F.col("Axes"))
    if strict:
        axes = axes.otherwise(F.raise_error(message).cast(cubes.schema["Axes"].dataType))
    else:
        checked = checked.where("Problem is null")

    dense = F.transform(F.coalesce("Dense", F.array().cast("array<double>")),
                        lambda v, p: F.struct(p.cast("bigint").alias("p"), v.alias("v")))
    held = F.array_sort(F.transform(F.map_entries("Sparse"), lambda e: F.struct(
        e["key"].cast("bigint").alias("p"), e["value"].alias("v"))))
    every = F.transform(
        F.when(F.col("ExpectedCells") > 0, F.sequence(F.lit(0).cast("bigint"),
                                                      F.col("ExpectedCells") - 1))
        .otherwise(F.array().cast("array<bigint>")),
        lambda p: F.struct(p.alias("p"), F.try_element_at("Sparse", p.cast("string")).alias("v")))
    values = F.when(F.col("Sparse").isNull(), dense).otherwise(held if present else every)
    if present:
        values = F.filter(values, lambda x: x["v"].isNotNull())

    def cells(h: Column) -> Column:
        def cell(x: Column) -> Column:
            def at(kind: str) -> Column:
                return F.transform(h["axes"], lambda a: F.element_at(a[kind], (F.pmod(
                    F.call_function("div", x["p"], a["stride"]), a["size"]) + 1).cast("int")))

            ids = F.transform(h["axes"], lambda a: a["id"])
            return F.struct(
                x["p"].alias("Position"), F.map_from_arrays(ids, at("codes")).alias("Codes"),
                F.map_from_arrays(ids, at("labels")).alias("Labels"),
                F.try_element_at(F.filter(at("units"), lambda u: u.isNotNull()), F.lit(1)).alias("Unit"),
                x["v"].alias("Value"))

        return F.transform(h["values"], cell)

    # a one-element array binds the axes, so that they are made once per document
    grid = F.element_at(F.transform(F.array(F.struct(axes.alias("axes"), values.alias("values"))),
                                    cells), 1)
    return checked.select(*keep, "Updated", F.inline(grid))


def cube_columns(cells: DataFrame, dims: dict[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Decoded cells with the dimensions ``dims`` (id -> column) as code and label columns;
    a dimension that a document doesn't have is NULL."""
    return cells.select(*keep, *[c for dim, name in dims.items() for c in (
        F.try_element_at("Codes", F.lit(dim)).alias(f"{name}Code"),
        F.try_element_at("Labels", F.lit(dim)).alias(name))], "Unit", "Value")


# --- writing the shapes -------------------------------------------------------------------------
def cube_text(doc: Column, places: Column, sparse: Column, in_array: Column) -> Column:
    """JSON-stat text of a packed document (``cube.cube_pack``): ``category.index`` as
    an object where ``places``, values as a sparse object where ``sparse``, wrapped
    in an array where ``in_array``."""
    def bare(c: Column) -> Column:
        return F.regexp_replace(F.to_json(F.array(c)), "^\\[|\\]$", "")

    def dimension(e: Column) -> Column:
        cat = e["value"]["category"]
        place = F.map_from_arrays(cat["index"], F.transform(cat["index"], lambda c, i: i))
        index = F.when(places, F.to_json(place)).otherwise(F.to_json(cat["index"]))
        unit = F.when(cat["unit"].isNotNull(), F.concat(F.lit(',"unit":'), F.to_json(cat["unit"])))
        return F.concat(bare(e["key"]), F.lit(':{"category":{"index":'), index, F.lit(',"label":'),
                        F.to_json(cat["label"]), F.coalesce(unit, F.lit("")), F.lit("}}"))

    entries = F.transform(doc["value"], lambda v, p: F.struct(p.cast("string").alias("k"), v.alias("v")))
    held = F.map_from_entries(F.filter(entries, lambda x: x["v"].isNotNull()))
    text = F.concat(
        F.lit('{"label":'), bare(doc["label"]), F.lit(',"updated":'), bare(doc["updated"]),
        F.lit(',"id":'), F.to_json(doc["id"]), F.lit(',"size":'), F.to_json(doc["size"]),
        F.lit(',"dimension":{'), F.array_join(F.transform(F.map_entries(doc["dimension"]), dimension), ","),
        F.lit('},"value":'), F.when(sparse, F.to_json(held)).otherwise(F.to_json(doc["value"])), F.lit("}"))
    return F.when(in_array, F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
