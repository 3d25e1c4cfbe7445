"""Embedding near-duplicates by lattice hashing.

Vectors are scaled to length 1 and projected by seeded random matrices; every
8 coordinates are decoded to the nearest point of the E8 lattice, and
``blocks`` such points name a cell.  In each of ``tables`` tables a vector
lives in its home cell and also probes the ``probes`` nearest neighbouring
cells (one of its points moved to a neighbour).  Two vectors meet in a cell if
it is home to one of them; all that meet are compared by cosine in double
precision.  With the defaults two vectors at cosine 0.95 meet with a
probability above 0.99, closer ones more surely (see the tests).

Equal vectors collapse before, and a pair is counted in the first cell where
it meets, which both sides know from their cells: no pair is ever sent.  A
cell returns one row per vector (its link count and a spanning link), so a
large group costs a comparison per pair, but rows in proportion to its
members.  A cell with more than ``tile`` vectors is dealt over tasks as
pairs of salted tiles.

What travels is kept small: cells are first counted from (node, cell) rows alone.
Cells with the same members meet nobody new after the first of them, so the
others are dropped before any vector moves.  A vector moves as it was given (not
as the doubles it is compared in), with its cells up to the table at hand.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing (``n_links`` 0, their own component); vectors of
different lengths never link; equal vectors link with each other; repeated
rows count as vectors of their own; null identifiers take part, and a
component of only such has a null ``component_id``; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm.components import components
from hearth.llm.frames import apart
from hearth.llm.simhash import grouped, union
from hearth.session import materialize

SUB_TILE = 512
MIX = np.uint64(0x9E3779B97F4A7C15)


def e8_neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


def _nearest_d8(y: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum."""
    near = np.rint(y)
    off = y - near
    odd = np.flatnonzero(near.sum(axis=1) % 2 != 0)
    worst = np.abs(off[odd]).argmax(axis=1)
    near[odd, worst] += np.where(off[odd, worst] >= 0, 1, -1)
    return near


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """E8 is D8 and D8 shifted by a half: the nearer of both decodings."""
    a, b = _nearest_d8(y), _nearest_d8(y - 0.5) + 0.5
    nearer = ((y - a) ** 2).sum(axis=1) <= ((y - b) ** 2).sum(axis=1)
    return np.where(nearer[:, None], a, b)


def _cell_ids(points: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit name for each row of doubled (so integer) coordinates."""
    whole = np.rint(2 * points).astype(np.int64).view(np.uint64)
    h = np.full(len(points), salt, np.uint64) * MIX
    for k in range(whole.shape[1]):
        h = (h ^ whole[:, k]) * MIX
        h ^= h >> np.uint64(32)
    return h.view(np.int64)


class Cells:
    """Home and probed cells of unit vectors of one length."""

    def __init__(self, dim: int, tables: int, probes: int, blocks: int, width: float, seed: int):
        rng = np.random.default_rng([seed, dim])
        self.maps = rng.normal(size=(tables, dim, 8 * blocks)) / width
        self.shifts = rng.random((tables, 8 * blocks))
        self.probes, self.blocks, self.dim = probes, blocks, dim
        self.around = e8_neighbours()

    def of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(homes, probed): (n, tables) and (n, tables * probes)."""
        homes, probed = [], []
        for t, (m, s) in enumerate(zip(self.maps, self.shifts, strict=True)):
            y = x @ m + s
            parts = [slice(8 * b, 8 * b + 8) for b in range(self.blocks)]
            at = np.concatenate([nearest_e8(y[:, p]) for p in parts], axis=1)
            salt = t << 32 | self.dim
            homes.append(_cell_ids(at, salt))
            # the squared distance grows by 2 - 2 r.v when one point moves by v
            gain = np.concatenate([(y - at)[:, p] @ self.around.T for p in parts], axis=1)
            best = np.argsort(-gain, axis=1, kind="stable")[:, :self.probes]
            for k in range(self.probes):
                block, v = np.divmod(best[:, k], len(self.around))
                moved = at.copy()
                for b, p in enumerate(parts):
                    rows = np.flatnonzero(block == b)
                    moved[rows, p] += self.around[v[rows]]
                probed.append(_cell_ids(moved, salt))
        return np.stack(homes, axis=1), np.stack(probed, axis=1)


def _matrix(column: pa.Array) -> list[np.ndarray]:
    flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [flat[a:b].astype(np.float64) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow in the length
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _coded(distinct: DataFrame, tables: int, probes: int, blocks: int, width: float,
           seed: int) -> DataFrame:
    """The distinct vectors with their cells."""
    named = distinct.select("vector", *[c for c in distinct.columns if c != "vector"])

    def run(batches):
        known: dict[int, Cells] = {}
        for batch in batches:
            vectors = _matrix(batch.column(0))
            for dim in sorted({len(v) for v in vectors}):
                at = [k for k, v in enumerate(vectors) if len(v) == dim]
                x = unit(np.stack([vectors[k] for k in at]))
                if dim not in known:
                    known[dim] = Cells(dim, tables, probes, blocks, width, seed)
                part = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *(pa.FixedSizeListArray.from_arrays(pa.array(m.ravel()), m.shape[1])
                                      .cast(pa.list_(pa.int64())) for m in known[dim].of(x))],
                    [*batch.schema.names, "homes", "probed"])

    cells = T.ArrayType(T.LongType())
    return named.mapInArrow(run, T.StructType([*named.schema.fields, T.StructField("homes", cells),
                                               T.StructField("probed", cells)]))


def _wide(column: pa.Array) -> np.ndarray:
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, -1)


def links_in_cell(g: dict, least: float, probes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, root, links) of the vectors that link in one cell or tile pair,
    counting the pairs that meet nowhere before."""
    node, copies, side, table = g["node"], g["copies"], g["side"], int(g["table"][0])
    home = g["home"]
    x, homes = unit(_wide(g["vector"])), _wide(g["homes"])
    probed = _wide(g["probed"]).reshape(len(node), -1, probes)
    split = g["low"][0] != g["high"][0]
    counts, parent = np.zeros(len(node), np.int64), np.arange(len(node))
    left = np.flatnonzero(side == 0) if split else np.arange(len(node))
    right = np.flatnonzero(side == 1) if split else left

    def meet(i, j, t):
        """Whether i and j meet in table t, by either's home."""
        return ((homes[i, t] == homes[j, t]) | (probed[j, t] == homes[i, t, None]).any(axis=1)
                | (probed[i, t] == homes[j, t, None]).any(axis=1))

    for a in range(0, len(left), SUB_TILE):
        for b in range(0 if split else a, len(right), SUB_TILE):
            p, q = left[a:a + SUB_TILE], right[b:b + SUB_TILE]
            near = x[p] @ x[q].T >= least
            i, j = np.nonzero(near)
            i, j = p[i], q[j]
            ok = home[i] | home[j]
            if not split:
                ok &= i < j if a == b else True
            i, j = i[ok], j[ok]
            parent = union(parent, i, j)
            # in this table the pair may meet in both homes: the smaller node's counts
            other = ~(home[i] & home[j])
            host, guest = np.where(home[i], i, j), np.where(home[i], j, i)
            both = other & (probed[host, table] == homes[guest, table][:, None]).any(axis=1)
            ok = ~both | (node[host] < node[guest])
            i, j = i[ok], j[ok]
            for t in range(table):
                seen = meet(i, j, t)
                i, j = i[~seen], j[~seen]
            np.add.at(counts, i, copies[j])
            np.add.at(counts, j, copies[i])
    linked = np.flatnonzero((counts > 0) | (parent != np.arange(len(node))))
    return node[linked], node[parent[linked]], counts[linked]


def _linked(coded: DataFrame, least: float, probes: int, tile: int) -> DataFrame:
    """(``node``, ``root``, ``links``) of every cell."""
    entries = coded.select("node", F.posexplode(F.concat("homes", "probed")).alias("at", "cell"),
                           F.size("homes").alias("tables"))
    entries = entries.select(
        "node", "cell", (F.col("at") < F.col("tables")).alias("home"),
        F.when(F.col("at") < F.col("tables"), F.col("at"))
        .otherwise(F.floor((F.col("at") - F.col("tables")) / probes)).cast("int").alias("table"))
    # 128 bits name the members of a cell; where two meet it is no matter which one lives there
    def named(*salt):
        return F.bit_xor(F.xxhash64(*salt, "node")), F.bit_xor(F.xxhash64(*salt, "node", "home"))

    (one, one_home), (two, two_home) = named(), named(F.lit(1))
    pair = F.col("n") == 2
    met = (entries.groupBy("cell")
           .agg(F.count(F.lit(1)).alias("n"), F.max("home").alias("lived"), F.min("table").alias("table"),
                one.alias("one"), one_home.alias("one_home"), two.alias("two"),
                two_home.alias("two_home"), F.min_by("home", "node").alias("least_lives"))
           .where("n > 1 and lived")
           .groupBy("n", F.when(pair, F.col("one")).otherwise(F.col("one_home")).alias("m1"),
                    F.when(pair, F.col("two")).otherwise(F.col("two_home")).alias("m2"))
           # of a pair's cells in one table that of its smaller node counts it
           .agg(F.min(F.struct("table", ~F.col("least_lives"), "cell")).alias("first"))
           .select(F.col("first.cell").alias("_cell"), "n"))
    salts = F.ceil(F.col("n") / tile).cast("bigint")
    dealt = (entries.join(met, F.col("cell") == F.col("_cell"))
             .withColumn("own", F.pmod(F.xxhash64("node"), salts))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)))
             .select("cell", F.least("own", "other").alias("low"),
                     F.greatest("own", "other").alias("high"),
                     (F.col("own") > F.col("other")).cast("int").alias("side"), "table", "home",
                     F.col("node").alias("_node")))
    group = ["cell", "low", "high"]
    upto = F.col("table") + 1
    full = (dealt.join(coded, F.col("_node") == F.col("node"))
            .select(*group, "side", "table", "home", "node", "copies", "vector",
                    F.slice("homes", F.lit(1), upto).alias("homes"),
                    F.slice("probed", F.lit(1), upto * probes).alias("probed")))

    def run(batches):
        held, size = [], 0
        for g in grouped(batches, len(group)):
            if len(g["node"]) < 2:
                continue
            found = links_in_cell(g, least, probes)
            if len(found[0]):
                held.append(found)
                size += len(found[0])
            if size >= 65536:
                yield _batch(held)
                held, size = [], 0
        if held:
            yield _batch(held)

    def _batch(held):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], ["node", "root", "links"])

    return (full.repartition(*group).sortWithinPartitions(*group)
            .mapInArrow(run, "node bigint, root bigint, links bigint"))


def embedding_groups(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                     least: float = 0.95, tables: int = 8, probes: int = 4, blocks: int = 2,
                     width: float = 1.7, seed: int = 42, tile: int = 1024) -> DataFrame:
    """Per row: identifier, ``n_links`` and ``component_id``."""
    v = F.col(vector_col)
    usable = (v.isNotNull() & (F.size(v) > 0)
              & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
              & F.exists(v, lambda x: x != 0))
    rows = apart(vectors, id_col, vector_col)[0].select(
        F.col(id_col).alias("_id"), v.alias("_vector"),
        F.coalesce(usable, F.lit(False)).alias("_usable"),
        F.xxhash64(v).alias("_h1"), F.hash(v).alias("_h2"))
    distinct = (rows.where("_usable").groupBy("_h1", "_h2")
                .agg(F.min("_id").alias("least_id"), F.count(F.lit(1)).alias("copies"),
                     F.first("_vector").alias("vector"))
                .withColumn("node", F.monotonically_increasing_id()))
    coded = materialize(_coded(distinct, tables, probes, blocks, width, seed), "lattice-cells")
    linked = materialize(_linked(coded, least, probes, tile), "lattice-links")
    counts = linked.groupBy(F.col("node").alias("_n")).agg(F.sum("links").alias("_links"))
    roots = components(linked, "node", "root").withColumnsRenamed({"node": "_m", "root": "_root"})
    tagged = (coded.join(counts, F.col("node") == F.col("_n"), "left")
              .join(roots, F.col("node") == F.col("_m"), "left")
              .select("_h1", "_h2", "least_id", F.coalesce("_root", "node").alias("_root"),
                      (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    least_ids = tagged.groupBy("_root").agg(F.min("least_id").alias("component_id"))
    found = tagged.join(least_ids, "_root").select("_h1", "_h2", "n_links", "component_id")
    alone = rows.where("not _usable").select(
        F.col("_id").alias(id_col), F.lit(0).cast("bigint").alias("n_links"),
        F.col("_id").alias("component_id"))
    return (rows.where("_usable").select("_id", "_h1", "_h2").join(found, ["_h1", "_h2"])
            .select(F.col("_id").alias(id_col), "n_links", "component_id").unionByName(alone))
