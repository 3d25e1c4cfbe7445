"""A content-addressed manifest of a table: Merkle trees and proofs by descent.

Every row is a leaf (the SHA-256 of its fields); the leaves of a group, in the
order of an identifier, are the lowest level of a tree; every ``fan`` consecutive
nodes become one node (the SHA-256 of their digests as hex text) until one is
left.  The groups' roots, in the order of the groups, are hashed up likewise to
the root of the table.

Build.  Leaves are sorted once by (group, identifier) over ranges of the table,
which gives every leaf its tree and its rank: a range knows its own rows, and one
row per range tells what came before.  Trees are built in steps of ``depth``
levels.  A step hashes aligned runs of ``fan ** depth`` nodes, a page each, in one
task, and stores per page what is under its top: digest -> children records,
addressed by the top's digest, equal pages once.

Descent.  Requests for leaves are gathered by page, at every step upwards one row
per page with the digits of the wanted ranks, so a tree's top is asked once, not
once per leaf.  From the root downwards, each step finds a page by its digest and
follows the digits through its records: the chosen child goes on, the children
beside it are kept as the level's segment of the path.  At the leaf the
segments, collected from the root, are put in reverse.

No digest, page or path of all rows passes the driver or one task: a task holds
one page at a time, and a hot group is many pages.

Defined cases: null groups come first, then groups bytewise; null identifiers
come first; rows of one identifier follow each other by their leaf; identical
rows are leaves of their own, in any order (their digests are the same); an
empty table has no rows and no root; a null field is ``-`` and an empty one
``0:``; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import namedtuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, IntegerType, StructType

from hearth.llm.frames import apart
from hearth.session import materialize

FAN, DEPTH = 2, 6
LEVEL = "struct<before: string, after: string>"
Manifest = namedtuple("Manifest", "leaves groups steps fan depth")
# leaves: tree, rank, leaf, payload columns; groups: tree, root, of the top tree's leaves;
# steps: per step the stored pages


def digest(*fields: Column) -> Column:
    """Hex SHA-256 of the fields: ``-`` if null, else UTF-8 byte count, ``:``, value."""
    def one(c):
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[one(c) for c in fields]), 256)


def node(children: list[bytes]) -> bytes:
    """The digest of a node, from the digests of its children."""
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def _ranked(leaves: DataFrame, group: str, order: str) -> DataFrame:
    """``leaves`` with ``tree`` (ordinal of the group) and ``rank`` in it."""
    keys = [F.col(group).asc_nulls_first(), F.col(order).asc_nulls_first(),
            F.col("leaf"), F.col("_at")]
    kept = [c for c in leaves.columns if c != "_at"]
    kinds = {f.name: f.dataType.simpleString() for f in leaves.schema.fields}
    dealt = (leaves.repartitionByRange(*keys).sortWithinPartitions(*keys)
             .withColumn("part", F.spark_partition_id()).select("part", *kept))

    def number(batches):
        at, n, last, begun = 0, 0, None, False
        for batch in batches:
            trees, ranks = [], []
            for value in batch.column(group).to_pylist():
                if not begun or value != last:
                    at, n, last, begun = at + begun, 0, value, True
                trees.append(at)
                ranks.append(n)
                n += 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(trees, pa.int64()), pa.array(ranks, pa.int64())],
                [*batch.schema.names, "tree", "rank"])

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in kept)
    stored = materialize(dealt.mapInArrow(
        number, f"part int, {schema}, tree bigint, rank bigint"), "ranked-leaves")
    # one row per range: what its first and last groups are, and how much it holds of them
    place = F.struct("tree", "rank")
    ends = stored.groupBy("part").agg(
        F.min_by(group, place).alias("first"), F.max_by(group, place).alias("last"),
        F.max("tree").alias("trees"), F.max(place)["rank"].alias("tail")).collect()
    shift, begun, last, trees, carry = [], False, None, -1, 0
    for r in sorted(ends, key=lambda r: r["part"]):
        goes_on = begun and r["first"] == last
        carried = carry if goes_on else 0
        base = trees if goes_on else trees + 1
        shift.append((r["part"], base, carried))
        carry = r["tail"] + 1 + (carried if r["trees"] == 0 else 0)
        begun, last, trees = True, r["last"], base + r["trees"]
    offsets = F.broadcast(leaves.sparkSession.createDataFrame(
        shift, "part int, _base bigint, _carried bigint"))
    rank = F.col("rank") + F.when(F.col("tree") == 0, F.col("_carried")).otherwise(0)
    return stored.join(offsets, "part").select(
        *kept, (F.col("_base") + F.col("tree")).alias("_t"), rank.alias("_r")).withColumnsRenamed(
        {"_t": "tree", "_r": "rank"})


def _step(nodes: DataFrame, fan: int, depth: int) -> DataFrame:
    """Pages of one step over (``tree``, ``rank``, ``digest``): tree, rank and digest of
    the page's top, its height, its leaves and its digest -> children records."""
    size = fan**depth
    pages = (nodes.groupBy("tree", F.floor(F.col("rank") / size).cast("bigint").alias("page"))
             .agg(F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("nodes"))
             .select("tree", "page", F.col("nodes.digest").alias("nodes")))
    names = ["tree", "rank", "digest", "height", "keys", "children"]

    def build(batches):
        for batch in batches:
            out = []
            for tree, page, row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                records, height = {}, 0
                # the only page of a tree ends with one node, every other at the full depth
                while len(row) > 1 or page and height < depth:
                    runs = [row[k:k + fan] for k in range(0, len(row), fan)]
                    row, height = [node(r) for r in runs], height + 1
                    records |= zip(row, runs, strict=True)
                out.append((tree, page, row[0], height, list(records), list(records.values())))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (
                        pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.binary()),
                        pa.list_(pa.list_(pa.binary()))), strict=True)], names)

    return pages.mapInArrow(build, "tree bigint, rank bigint, digest binary, height int, "
                                   "keys array<binary>, children array<array<binary>>")


def _trees(nodes: DataFrame, fan: int, depth: int) -> tuple[list[DataFrame], DataFrame]:
    """The stored pages of every step, and (tree, digest, height) of every tree."""
    steps = []
    tops = nodes.select("tree", "rank", "digest", F.lit(0).alias("height"))
    while not steps or tops.agg(F.max("rank")).first()[0]:
        built = materialize(_step(tops, fan, depth), "pages")
        steps.append(built)
        tops = built.select("tree", "rank", "digest")
    heights = steps[0].groupBy("tree").agg(F.max("height").alias("height"))
    for pages in steps[1:]:
        more = pages.groupBy("tree").agg(F.max("height").alias("_more"))
        heights = heights.join(more, "tree").select("tree", (F.col("height") + F.col("_more"))
                                                    .alias("height"))
    return steps, tops.select("tree", "digest").join(heights, "tree")


def build_manifest(rows: DataFrame, fields: list[str], group: str, order: str,
                   fan: int = FAN, depth: int = DEPTH, **payload: Column) -> Manifest:
    """Trees over ``rows``: leaves hash ``fields``, a tree per ``group``, its leaves by
    ``order``; ``payload`` (columns made of these) stays with each leaf."""
    inner = apart(rows, group, order, *fields)[0]
    leaf = digest(*map(F.col, fields))
    # the table is read and hashed once; the sort samples and sorts narrow rows
    hashed = materialize(inner.select(
        F.col(group).alias("_group"), F.col(order).alias("_order"),
        F.unhex(leaf).alias("leaf"), *[c.alias(n) for n, c in payload.items()],
        F.monotonically_increasing_id().alias("_at")), "hashed-leaves")
    leaves = materialize(_ranked(hashed, "_group", "_order"), "leaves")
    steps, roots = _trees(leaves.select("tree", "rank", F.col("leaf").alias("digest")), fan, depth)
    roots = materialize(roots, "group-roots")
    # the table's own tree: one leaf per group, ranked by the group's order
    top_steps, top = _trees(roots.select(F.lit(0).cast("bigint").alias("tree"),
                                         F.col("tree").alias("rank"), "digest"), fan, depth)
    return Manifest(leaves, (roots, materialize(top, "root")), (steps, top_steps), fan, depth)


def _descend(asked: DataFrame, starts: DataFrame, steps: list[DataFrame], manifest: Manifest
             ) -> DataFrame:
    """Requests (``tree``, ``rank``, ``what``) from ``starts`` (``tree``, ``digest``,
    ``height``, ``path``) down to their leaves: (``tree``, ``rank``, ``what``, ``digest``,
    ``path``, ``top``), the path from the root down, ``top`` the digest of the start."""
    fan, depth = manifest.fan, manifest.depth
    size = fan**depth

    def by_page(requests: DataFrame) -> DataFrame:
        digit = F.struct(F.pmod("rank", F.lit(size)).alias("digit"), "what")
        return (requests.groupBy("tree", F.floor(F.col("rank") / size).cast("bigint").alias("page"))
                .agg(F.collect_list(digit).alias("wanted")))

    def follow(what: DataType) -> tuple:
        declared = StructType.fromDDL(
            f"tree bigint, rank bigint, what {what.simpleString()}, digest binary, height int, "
            f"top binary, path array<{LEVEL}>")
        schema = to_arrow_schema(declared)
        level_type = schema.field("path").type.value_type

        def run(batches):
            for batch in batches:
                out, before, after, ends = [], [], [], [0]
                for row in batch.to_pylist():
                    records = dict(zip(row["keys"], row["children"], strict=True))
                    so_far = [[e[k] for e in row["path"]] for k in ("before", "after")]
                    for wanted in row["wanted"]:
                        at, digit = row["digest"], wanted["digit"]
                        before += so_far[0]
                        after += so_far[1]
                        for level in range(row["page_height"] - 1, -1, -1):
                            children = records[at]
                            chosen = digit // fan**level % fan
                            at = children[chosen]
                            before.append("".join(c.hex() for c in children[:chosen]))
                            after.append("".join(c.hex() for c in children[chosen + 1:]))
                        ends.append(len(before))
                        out.append((row["tree"], row["page"] * size + digit, wanted["what"], at,
                                    row["height"] - row["page_height"], row["top"]))
                if out:
                    levels = pa.StructArray.from_arrays(
                        [pa.array(before, pa.string()), pa.array(after, pa.string())],
                        fields=list(level_type))
                    whole = pa.RecordBatch.from_arrays(
                        [*(pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema)),
                         pa.ListArray.from_arrays(pa.array(ends, pa.int32()), levels,
                                                  type=schema.field("path").type)], schema=schema)
                    yield whole

        return run, declared

    # upwards: a page is asked for once, whoever asks under it
    levels = [materialize(by_page(asked), "requests")]
    for _ in steps[1:]:
        levels.append(materialize(by_page(levels[-1].select(
            "tree", F.col("page").alias("rank"), F.lit(None).cast("int").alias("what"))), "requests"))
    now = starts.select("tree", F.lit(0).cast("bigint").alias("rank"), "digest", "height", "path",
                        F.col("digest").alias("top"))
    for k in range(len(steps) - 1, -1, -1):
        # a node that is alone at this step is its own top: no page, no level
        pages = steps[k].where("height > 0").select(
            "digest", F.col("height").alias("page_height"), "keys", "children"
        ).dropDuplicates(["digest", "page_height"])
        met = (now.withColumnRenamed("rank", "page").join(levels[k], ["tree", "page"])
               # lower steps are of full depth; what is above them is this page's
               .withColumn("page_height", F.greatest(F.lit(0), F.col("height") - F.lit(k * depth))))
        missing = F.raise_error(F.lit("a page of the manifest is missing")).cast("array<binary>")
        found = met.join(pages, ["digest", "page_height"], "left").withColumns({
            "keys": F.when((F.col("page_height") > 0) & F.col("keys").isNull(), missing)
            .otherwise(F.coalesce("keys", F.array().cast("array<binary>"))),
            "children": F.coalesce("children", F.array().cast("array<array<binary>>"))})
        run, declared = follow(asked.schema["what"].dataType if k == 0 else IntegerType())
        now = found.mapInArrow(run, declared)
        if k:
            now = materialize(now.drop("what"), "descent")
    return now


def leaf_paths(manifest: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """Per requested leaf (rows of ``manifest.leaves``; by default all): its payload,
    ``leaf``, ``found`` (its digest as the descent found it), ``subroot``, ``root`` and
    ``path``, one entry per level from the leaf up with the hex digests ``before`` and
    ``after`` it, joined."""
    wanted = manifest.leaves if wanted is None else wanted
    held = [c for c in wanted.columns if c not in ("tree", "rank", "_group", "_order")]
    roots, top = manifest.groups
    steps, top_steps = manifest.steps
    to_groups = wanted.select("tree").distinct().select(
        F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("rank"),
        F.col("tree").alias("what"))
    groups = _descend(to_groups, top.withColumn("path", F.array().cast(f"array<{LEVEL}>")),
                      top_steps, manifest)
    starts = materialize(groups.select(F.col("what").alias("tree"), "digest", "path")
                         .join(roots.select("tree", "height"), "tree"), "descent")
    payload = wanted.select("tree", "rank", F.struct(*held).alias("what"))
    found = _descend(payload, starts, steps, manifest)
    root = top.first()
    return found.select(
        *[F.col(f"what.{c}").alias(c) for c in held if c != "leaf"],
        F.lower(F.hex("what.leaf")).alias("leaf"), F.lower(F.hex("digest")).alias("found"),
        F.lower(F.hex("top")).alias("subroot"),
        F.lit(root and root["digest"].hex()).cast("string").alias("root"),
        F.reverse("path").alias("path"))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path give."""
    return F.aggregate(path, leaf, lambda at, level: F.sha2(
        F.concat(level["before"], at, level["after"]), 256))


def siblings(path: Column) -> Column:
    """All digests beside a leaf's way to the root, from the leaf up, left to right."""
    return F.array_join(F.transform(path, lambda level: F.concat(level["before"], level["after"])), "")
