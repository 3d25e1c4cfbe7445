"""JSON-stat statistics cubes (JS1-JS5) and the vacancy measures built on
them (AG7-AG9).

A cube document is one row holding ordered dimension codes and one flat,
row-major value array.  Decoding is a Spark job — ``from_json`` then
``posexplode`` of the value array — with every cell's dimension codes
computed by stride arithmetic, so nothing goes through the driver.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Dimension ids of the vacancy cube, in value order, and the
# statistic codes of the three published measures.
DIM_STATISTIC = "STATISTIC"
DIM_QUARTER = "TLIST(Q1)"
DIM_AUTHORITY = "C03789V04537"
VACANCY_DIMS = (DIM_STATISTIC, DIM_QUARTER, DIM_AUTHORITY)
STAT_VACANT = "VAC14C01"
STAT_STOCK = "VAC14C02"
STAT_RATE = "VAC14C03"
VACANCY_STATS = {STAT_VACANT: "VacantDwellings", STAT_STOCK: "DwellingStock",
                 STAT_RATE: "ReportedVacancyRate"}

UNIT = T.StructType([T.StructField("label", T.StringType())])
CATEGORY = T.StructType([
    T.StructField("index", T.ArrayType(T.StringType())),
    T.StructField("label", T.MapType(T.StringType(), T.StringType())),
    T.StructField("unit", T.MapType(T.StringType(), UNIT)),
])
DIMENSION = T.StructType([
    T.StructField("label", T.StringType()),
    T.StructField("category", CATEGORY),
])
DOCUMENT = T.StructType([
    T.StructField("label", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("updated", T.StringType()),
    T.StructField("id", T.ArrayType(T.StringType())),
    T.StructField("size", T.ArrayType(T.IntegerType())),
    T.StructField("dimension", T.MapType(T.StringType(), DIMENSION)),
    T.StructField("value", T.ArrayType(T.DoubleType())),
])


# --- JS1 ---------------------------------------------------------------------------------------
def cube_unwrap(json_col) -> Column:
    """Parse a document given either as an object or as a one-element array.

    ``from_json`` with an array schema wraps a lone object into a
    one-element array, so one expression accepts both shapes."""
    c = F.col(json_col) if isinstance(json_col, str) else json_col
    return F.element_at(F.from_json(c, T.ArrayType(DOCUMENT)), 1)


# --- JS2 ---------------------------------------------------------------------------------------
def cube_cells(doc: Column) -> Column:
    """Product of the dimension sizes."""
    return F.aggregate(doc["size"], F.lit(1).cast("bigint"),
                       lambda acc, s: acc * s.cast("bigint"))


def cube_validate(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """Adds ``ExpectedCells``, ``ValueCount`` and ``IsValid`` per document."""
    d = F.col(doc_col)
    return docs.withColumns({
        "ExpectedCells": cube_cells(d),
        "ValueCount": F.size(d["value"]).cast("bigint"),
    }).withColumn("IsValid", F.col("ExpectedCells") == F.col("ValueCount"))


def require_valid(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """Strict mode: fail the job when any document's sizes disagree.  The
    check is part of the document column itself, so it cannot be pruned
    away by the optimizer."""
    v = cube_validate(docs, doc_col)
    msg = F.concat(F.lit("cube size mismatch: expected "), F.col("ExpectedCells").cast("string"),
                   F.lit(" values, got "), F.col("ValueCount").cast("string"))
    checked = F.when(F.col("IsValid"), F.col(doc_col)).otherwise(
        F.raise_error(msg).cast(docs.schema[doc_col].dataType))
    return v.withColumn(doc_col, checked)


# --- JS3 ---------------------------------------------------------------------------------------
def cube_flatten(docs: DataFrame, dim_ids: Sequence[str] = VACANCY_DIMS,
                 doc_col: str = "doc", keep: Sequence[str] = ()) -> DataFrame:
    """One row per cell: for each dimension ``<i>_code`` / ``<i>_label``,
    plus the statistic unit, the value (NULL kept) and ``keep`` columns.

    Cell position p → index along dimension i = (p div stride_i) mod size_i,
    stride_i = product of the sizes after i (row-major order).

    The cells are built inside the document, from label arrays resolved once per
    document, and only they leave the explode: no row carries the document."""
    d = F.col(doc_col)
    n = len(dim_ids)
    cats = [F.element_at(d["dimension"], F.lit(dim))["category"] for dim in dim_ids]

    def labels(cat: Column) -> Column:
        return F.transform(cat["index"], lambda c: F.try_element_at(cat["label"], c))

    parts = [p for i, cat in enumerate(cats)
             for p in (cat["index"].alias(f"codes{i}"), labels(cat).alias(f"labels{i}"))]
    units = F.transform(cats[0]["index"],
                        lambda c: F.try_element_at(cats[0]["unit"], c)["label"])
    head = F.struct(*parts, units.alias("units"), d["size"].alias("sizes"),
                    d["value"].alias("values"))

    def cells(h: Column) -> Column:
        size = [F.element_at(h["sizes"], i + 1).cast("bigint") for i in range(n)]

        def cell(value: Column, pos: Column) -> Column:
            at = []
            for i in range(n):
                stride = reduce(lambda a, b: a * b, size[i + 1:], F.lit(1).cast("bigint"))
                at.append((F.pmod(F.call_function("div", pos, stride), size[i]) + 1).cast("int"))
            named = [F.element_at(h[f"{kind}s{i}"], at[i]).alias(f"{i}_{kind}")
                     for i in range(n) for kind in ("code", "label")]
            return F.struct(*named, F.element_at(h["units"], at[0]).alias("Unit"),
                            value.alias("Value"))

        return F.transform(h["values"], cell)

    # a one-element array binds ``head``, so that it is computed once per document
    grid = F.element_at(F.transform(F.array(head), cells), 1)
    return (docs.select(*keep, d["updated"].alias("_updated"), F.inline(grid))
            .withColumnRenamed("_updated", "updated"))


# --- JS5 ---------------------------------------------------------------------------------------
def cube_metadata(docs: DataFrame, doc_col: str = "doc", keep: Sequence[str] = ()) -> DataFrame:
    d = F.col(doc_col)
    return docs.select(*keep, d["label"].alias("Label"), d["source"].alias("Source"),
                       d["updated"].alias("Updated"),
                       F.array_join(d["size"].cast("array<string>"), "x").alias("Sizes"),
                       cube_cells(d).alias("Cells"))


# --- packing (inverse of JS3; builds documents from a long table) ---------------------------------
def cube_pack(long_df: DataFrame, group_cols: Sequence[str],
              dims: Sequence[tuple[str, str, str]], value_col: str = "Value",
              unit_col: str | None = "Unit", label: str = "", source: str = "",
              updated: str | None = None) -> DataFrame:
    """Long rows → one JSON-stat document (struct column ``doc``) per group.

    ``dims`` = ``[(dimension id, code column, label column), ...]`` in value
    order.  Codes are sorted per dimension; absent cells are NULL.  The
    per-group collection is bounded by the number of cube *cells* (distinct
    codes), not by the number of raw rows behind them.
    """
    key_parts = []
    aggs = []
    for i, (_, code, lab) in enumerate(dims):
        aggs.append(F.array_sort(F.collect_set(F.struct(F.col(code).alias("c"),
                                                        F.col(lab).alias("l"))))
                    .alias(f"_d{i}"))
        key_parts.append(F.col(code))
    aggs.append(F.map_from_entries(F.collect_list(F.struct(
        F.concat_ws("\u0001", *key_parts), F.col(value_col)))).alias("_vals"))
    if unit_col:
        aggs.append(F.map_from_entries(F.collect_set(F.struct(
            F.col(dims[0][1]), F.col(unit_col)))).alias("_units"))
    g = long_df.groupBy(*group_cols).agg(*aggs)

    sizes = [F.size(F.col(f"_d{i}")) for i in range(len(dims))]
    total = reduce(lambda a, b: a * b, sizes)

    def cell_key(p):
        parts = []
        for i in range(len(dims)):
            stride = reduce(lambda a, b: a * b, sizes[i + 1:], F.lit(1))
            idx = F.pmod(F.floor(p / stride), sizes[i]).cast("int")
            parts.append(F.element_at(F.col(f"_d{i}"), idx + 1)["c"])
        return F.concat_ws("\u0001", *parts)

    values = F.transform(F.sequence(F.lit(0), total - 1),
                         lambda p: F.try_element_at(F.col("_vals"), cell_key(p)))
    entries = []
    for i, (dim_id, _, _) in enumerate(dims):
        arr = F.col(f"_d{i}")
        unit_map = (F.transform_values(F.col("_units"), lambda k, v: F.struct(v.alias("label")))
                    if (i == 0 and unit_col) else F.lit(None).cast(T.MapType(T.StringType(), UNIT)))
        entries += [F.lit(dim_id), F.struct(
            F.lit(dim_id).alias("label"),
            F.struct(F.transform(arr, lambda x: x["c"]).alias("index"),
                     F.map_from_entries(F.transform(arr, lambda x: F.struct(x["c"], x["l"])))
                     .alias("label"),
                     unit_map.alias("unit")).alias("category"))]
    doc = F.struct(
        F.lit(label).alias("label"), F.lit(source).alias("source"),
        F.lit(updated).cast("string").alias("updated"),
        F.array(*[F.lit(d[0]) for d in dims]).alias("id"),
        F.array(*sizes).alias("size"),
        F.create_map(*entries).alias("dimension"),
        values.cast("array<double>").alias("value"))
    return g.select(*group_cols, doc.alias("doc"))


# --- AG7 / AG8 / AG9 ---------------------------------------------------------------------------
def pivot_measures(df: DataFrame, by: Sequence[str], pivot_col: str,
                   values: dict[str, str], value_col: str = "Value") -> DataFrame:
    """Long → wide on *listed* values (no extra distinct job); one value per
    cell is expected, ``max`` picks it deterministically."""
    wide = df.groupBy(*by).pivot(pivot_col, list(values)).agg(F.max(value_col))
    return wide.withColumnsRenamed(values)


def county_rollup(df: DataFrame, by: Sequence[str] = ("QuarterCode", "Quarter", "County")
                  ) -> DataFrame:
    """AG8: sums of vacant and stock, latest source and load stamps."""
    return df.groupBy(*by).agg(
        F.sum("VacantDwellings").alias("VacantDwellings"),
        F.sum("DwellingStock").alias("DwellingStock"),
        F.max("SourceUpdatedTimestamp").alias("SourceUpdatedTimestamp"),
        F.max("LoadDate").alias("LoadDate"))


def vacancy_rate(vacant, stock, scale: int = 1) -> Column:
    """AG9: percentage recomputed from the sums; NULL when stock is 0/NULL."""
    v = F.col(vacant) if isinstance(vacant, str) else vacant
    s = F.col(stock) if isinstance(stock, str) else stock
    return F.round(F.try_divide(v * F.lit(100.0), s), scale)
