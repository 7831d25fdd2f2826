"""Near-duplicate vectors by int8 tile products.

Two vectors are linked if their cosine, in double precision, is ``SIMILARITY`` or more.
Rows of equal vectors are one node.  Vectors are compared in tiles: blocks of nodes
against blocks of nodes.  In a tile each unit vector x is quantised to int8, x = s q + e
with one scale s, and |e| is known; so for two vectors

    | x.y - s s' (q.q') |  <=  |e| + |e'| + |e| |e'|

rigorously (and a little more for rounding).  The int8 products are sums of integers
below 2 ** 24 and so exact in single precision.  A pair whose upper bound is below the
threshold is done with, one whose lower bound is above it is a link; only those in between
are computed again from the original vectors in double precision.

A tile gives no pairs: for each of its nodes that has links their number, and the
node that stands for its connected component within the tile; so its output follows its
rows however dense a group of copies is.  Numbers are added up by node, and the
components of all tiles' edges are those of the links.

Which tiles: nodes lie in the cell of the nearest of up to ``CELLS`` pivots (centres
fitted on a bounded sample), cells are cut into blocks by a hash.  A node u is also sent
to each later cell that can hold a vector within the threshold's angle t of it: its angle
to the pivot is at most t more than the largest in that cell, and at most 2 t more than
that to its own pivot.  Neither leaves out a link; where vectors form no clusters, all tiles
remain.

Defined results: vectors that are null, empty, zero, of another length than most, or
hold null or non-finite components, and rows with a null id, link with nothing; rows equal
in id and vector are one vector, each gets the same result; rows of one id with
different vectors are different vectors; an empty table gives an empty one; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, materialize
from .neardup import attach, components

SIMILARITY = 0.9
#: Pivots at most; numbers of the sample that they are fitted on, and its rows, at most.
CELLS, SAMPLE_NUMBERS, SAMPLE_ROWS = 256, 4_000_000, 8192
#: Nodes of a block: at least, at most; between them it grows with the root of their number, so that what is sent does, too.
LEAST_BLOCK, MOST_BLOCK = 2048, 16_384
#: Components of a block's vectors, at most (32 MB as doubles).
BLOCK_NUMBERS = 1 << 22
#: Pairs of a tile that are looked at together.
TOGETHER = 1 << 21
#: Products of so many int8 components are below 2 ** 24.
EXACT_DIM = 1024
#: More than the rounding of scaled single-precision products, and of angles.
SLACK, ANGLE_SLACK = 2e-6, 1e-6
_SIGN = -(1 << 63)


def _valid(vec: Column) -> Column:
    finite = F.forall(vec, lambda v: F.coalesce((F.abs(v) < float("inf")) & ~F.isnan(v), F.lit(False)))
    return vec.isNotNull() & (F.size(vec) > 0) & finite & F.exists(vec, lambda v: v != 0)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows divided by a power of two near their largest component: cosines stay the same to the last bit, squares don't overflow."""
    _, e = np.frexp(np.abs(x).max(axis=1, keepdims=True))
    return np.ldexp(x, -e)


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


class Side:
    """A block's vectors, exact and quantised."""

    def __init__(self, x: np.ndarray):
        self.x = scaled(x)
        self.norm = norms(self.x)
        unit = self.x / self.norm[:, None]
        self.scale = np.abs(unit).max(axis=1) / 127
        q = np.rint(unit / self.scale[:, None])
        self.error = norms(unit - self.scale[:, None] * q) + 1e-9
        self.q = q.astype(np.int8)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of int8 rows: integers, exact in each run of EXACT_DIM components."""
    total = None
    for k in range(0, a.shape[1], EXACT_DIM):
        s = a[:, k:k + EXACT_DIM].astype(np.float32) @ b[:, k:k + EXACT_DIM].astype(np.float32).T
        total = s if total is None else total.astype(np.float64) + s
    return total


def linked(a: Side, b: Side, similarity: float = SIMILARITY) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(rows of a, rows of b) that are linked, some rows of a at a time; and how many pairs were computed in full."""
    step = max(1, TOGETHER // max(1, len(b.q)))
    worst = b.error.max(initial=0.0)
    for i in range(0, len(a.q), step):
        own = slice(i, i + step)
        near = products(a.q[own], b.q) * a.scale[own, None].astype(np.float32) * b.scale.astype(np.float32)
        error = a.error[own]
        r, c = np.nonzero(near >= (similarity - SLACK - error - worst * (1 + error))[:, None].astype(np.float32))
        s = near[r, c].astype(np.float64)
        bound = error[r] + b.error[c] + error[r] * b.error[c] + SLACK
        sure = s - bound >= similarity
        open_ = np.flatnonzero(~sure & (s + bound >= similarity))
        for j in range(0, len(open_), 1 << 16):
            k = open_[j:j + (1 << 16)]
            x, y = i + r[k], c[k]
            sure[k] = np.einsum("ij,ij->i", a.x[x], b.x[y]) / (a.norm[x] * b.norm[y]) >= similarity
        yield i + r[sure], c[sure], len(open_)


def unite(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Labels (each node's label is a node whose label is itself) after joining x and y pairwise: the least node of each component."""
    while True:
        lx, ly = label[x], label[y]
        open_ = lx != ly
        if not open_.any():
            return label
        x, y, lx, ly = x[open_], y[open_], lx[open_], ly[open_]
        np.minimum.at(label, np.maximum(lx, ly), np.minimum(lx, ly))
        while (label[label] != label).any():
            label = label[label]


def compare(nodes: list[bytes], copies: np.ndarray, side: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A tile's (links, representative) of each row: rows of side 0 against those of side 1, or against each other if there are none."""
    first = np.flatnonzero(side == 0)
    second = np.flatnonzero(side == 1)
    links, label = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
    if not len(first):
        return links, label
    alone = not len(second)
    second = first if alone else second
    a = Side(x[first])
    b = a if alone else Side(x[second])
    for r, c, _ in linked(a, b):
        r, c = first[r], second[c]
        if alone:  # each pair comes both ways
            r, c = r[r != c], c[r != c]
        links += np.bincount(r, copies[c], len(links)).astype(np.int64)
        if not alone:
            links += np.bincount(c, copies[r], len(links)).astype(np.int64)
        label = unite(label, r, c)
    return links, label


def centres(x: np.ndarray, n: int) -> np.ndarray:
    """n unit vectors, by a few rounds of means of the nearest."""
    x = scaled(x)
    x = x / norms(x)[:, None]
    c = x[np.random.default_rng(1).permutation(len(x))[:n]]
    for _ in range(6):
        home = (x @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, home, x)
        size = norms(sums)
        c = np.where(size[:, None] > 1e-9, sums / np.maximum(size, 1e-300)[:, None], c)
    return c


def angles(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return np.arccos(np.clip((x / norms(x)[:, None]) @ pivots.T, -1, 1))


def _floats(col: pa.Array, kind: type, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), kind).reshape(-1, dim).astype(np.float64)


def _nodes(rows: DataFrame, dim: int, kind: type, pivots: np.ndarray) -> DataFrame:
    """(node, h, x, copies, n, cell, angle), written: distinct vectors of rows (id, x binary); h: x's digest, n: rows.

    A node's key is its least id, in an order-keeping form, and h.
    """
    once = rows.groupBy("id", "x").agg(F.count("*").alias("n"))
    same = once.groupBy("x").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.sum("n").alias("n"))
    same = same.select(F.concat(F.unhex(F.lpad(F.hex(F.col("id").bitwiseXOR(F.lit(_SIGN))), 16, "0")), F.unhex(F.md5("x"))).alias("node"), F.unhex(F.md5("x")).alias("h"), "x", "copies", "n")
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                far = angles(_floats(b.column("x"), kind, dim), shared.value)
                cell = far.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32)), pa.array(far[np.arange(len(far)), cell])], [*b.schema.names, "cell", "angle"])

    return materialize(same.mapInArrow(run, "node binary, h binary, x binary, copies long, n long, cell int, angle double"), "vector-nodes")


def _tiles(nodes: DataFrame, n: int, dim: int, kind: type, pivots: np.ndarray) -> DataFrame:
    """(node, links, to), written: each tile's result for its nodes that have links."""
    shared = nodes.sparkSession.sparkContext.broadcast(pivots)
    most, cells = math.acos(SIMILARITY), len(pivots)
    found = {r["cell"]: r for r in nodes.groupBy("cell").agg(F.count("*").alias("n"), F.max("angle").alias("r")).collect()}  # CELLS rows at most
    radius = np.array([found[c]["r"] if c in found else -np.inf for c in range(cells)])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                far = angles(_floats(b.column("x"), kind, dim), shared.value)
                cell, own = b.column("cell").to_numpy(), b.column("angle").to_numpy()
                go = (far <= radius + most + ANGLE_SLACK) & (far <= (own + 2 * most + ANGLE_SLACK)[:, None]) & (np.arange(cells) > cell[:, None])
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([np.flatnonzero(g).astype(np.int32) for g in go], pa.list_(pa.int32()))], [*b.schema.names, "to"])

    routed = nodes.select("node", "x", "copies", "cell", "angle").mapInArrow(route, "node binary, x binary, copies long, cell int, angle double, to array<int>")
    routed = materialize(routed.drop("angle"), "vector-routes")
    visits = {r["q"]: r["n"] for r in routed.select(F.explode("to").alias("q")).groupBy("q").agg(F.count("*").alias("n")).collect()}  # CELLS rows at most
    block = int(max(64, min(MOST_BLOCK, max(LEAST_BLOCK, 8 * math.sqrt(n)), BLOCK_NUMBERS // dim)))
    per_cell = lambda sizes: F.array(*[F.lit(-(-s // block)) for s in sizes])
    own_blocks, visit_blocks = per_cell([found[c]["n"] if c in found else 0 for c in range(cells)]), per_cell([visits.get(c, 0) for c in range(cells)])
    counted = routed.withColumn("own", own_blocks[F.col("cell")]).withColumn("come", visit_blocks[F.col("cell")])
    counted = counted.withColumn("i", F.pmod(F.xxhash64("node"), F.col("own")).cast("int"))
    row = ["node", "x", "copies"]
    among = counted.select(*row, F.col("cell").alias("q"), "i", F.explode(F.sequence(F.lit(0), F.col("own") - 1)).alias("k"))
    among = among.select(*row, "q", F.lit(0).alias("kind"), F.least("i", "k").alias("i"), F.greatest("i", "k").alias("j"), (F.col("i") > F.col("k")).cast("int").alias("side"))
    hosts = counted.where("come > 0").select(*row, F.col("cell").alias("q"), F.lit(1).alias("kind"), "i", F.explode(F.sequence(F.lit(0), F.col("come") - 1)).alias("j"), F.lit(0).alias("side"))
    guests = routed.select(*row, F.explode("to").alias("q")).withColumn("j", F.pmod(F.xxhash64("node", F.lit(1)), visit_blocks[F.col("q")]).cast("int"))
    guests = guests.select(*row, "q", F.lit(1).alias("kind"), F.explode(F.sequence(F.lit(0), own_blocks[F.col("q")] - 1)).alias("i"), "j", F.lit(1).alias("side"))

    def tile(b: pa.Table) -> pa.Table:
        b = b.combine_chunks()
        names = b.column("node").to_pylist()
        side = b.column("side").to_numpy()
        # a pair of blocks without rows on one side has no pairs
        if b.column("i")[0] != b.column("j")[0] or b.column("kind")[0].as_py():
            if (side == 0).all() or (side == 1).all():
                side = np.ones(len(side), int)
        links, label = compare(names, b.column("copies").to_numpy(), side, _floats(b.column("x"), kind, dim))
        at = np.flatnonzero(links)
        return pa.table({"node": pa.array([names[k] for k in at], pa.binary()), "links": pa.array(links[at]), "to": pa.array([names[label[k]] for k in at], pa.binary())})

    every = among.unionByName(hosts).unionByName(guests)
    return materialize(every.groupBy("q", "kind", "i", "j").applyInArrow(tile, "node binary, links long, to binary"), "vector-tiles")


def classes(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) of every row: its linked vectors, the least id that links lead to, and whether that is its own."""
    spark = vectors.sparkSession
    kind = np.float32 if vectors.schema[vec_col].dataType.simpleString() == "array<float>" else np.float64
    rows = vectors.select(column(id_col).cast("long").alias("id"), column(vec_col).cast("array<double>").alias("v"))
    good = F.col("id").isNotNull() & _valid(F.col("v"))
    dims = rows.where(good).groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    alone = lambda r: r.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"))
    if dims is None:
        return alone(rows)
    dim, n = dims["dim"], dims["n"]
    takes_part = F.coalesce(good & (F.size("v") == dim), F.lit(False))
    sample = min(SAMPLE_ROWS, max(1, SAMPLE_NUMBERS // dim))
    taken = rows.where(takes_part).orderBy(F.xxhash64("id", F.lit(11)), "id").limit(sample).select("v").toArrow()
    x = np.unique(taken.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim), axis=0)
    pivots = centres(x, max(1, min(CELLS, n // LEAST_BLOCK, len(x))))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, dim)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in flat], pa.binary())], ["id", "x"])

    packed = materialize(rows.where(takes_part).mapInArrow(pack, "id long, x binary"), "vectors")
    nodes = _nodes(packed, dim, kind, pivots)
    tiles = _tiles(nodes, n, dim, kind, pivots)
    table = nodes.select("node", "h", "copies", "n").join(tiles.groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
    edges = tiles.where("node != to").select(F.col("node").alias("a"), F.col("to").alias("b"))
    if edges.isEmpty():
        table = table.withColumn("comp", F.col("node"))
    else:
        table = table.join(components(edges), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = F.conv(F.hex(F.substring("comp", 1, 8)), 16, -10).cast("long").bitwiseXOR(F.lit(_SIGN))
    table = materialize(table.select("h", "n", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), least.alias("component_id")), "vector-classes")
    found = attach(packed.select("id", F.unhex(F.md5("x")).alias("h")), table, "h", "n")
    found = found.select(F.col("id").alias(id_col), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
    return found.unionByName(alone(rows.where(~takes_part)))


#: DuckDB: the rows of ``classes`` (ids distinct, lengths equal).
CLASSES_SQL = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), m AS MATERIALIZED (
  SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS n FROM v
), link AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM m a JOIN m b ON a.vec_id <> b.vec_id AND list_inner_product(a.e, b.e) / (a.n * b.n) >= 0.9
), reach(a, b) AS (
  SELECT a, b FROM link
  UNION
  SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), least AS (
  SELECT a, least(a, min(b)) AS c FROM reach GROUP BY a
), degree AS (
  SELECT a, count(*) AS n FROM link GROUP BY a
)
SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, coalesce(l.c, e.vec_id) AS component_id, coalesce(l.c, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN least l ON e.vec_id = l.a LEFT JOIN degree d ON e.vec_id = d.a
"""
