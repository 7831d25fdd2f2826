"""Vector codes: four codebooks of 256 integer entries, searched by a GNAT.

A component x becomes the integer floor(1024 x); vectors are cut into four equal
consecutive parts (the first ones hold one component more where four doesn't divide the
length).  A part's codebook starts as that part of the 256 rows of least id; each round
assigns every part to the nearest entry, ties to the lower index, and replaces each
entry by the floor of its parts' componentwise mean; unused entries stay.

The nearest entry is found by a geometric near-neighbour access tree over the entries:
a node holds split points, chosen far apart, and the other entries as children of their
nearest split point; for each split point and child it stores the range of the distances
between them.  A query takes its distances to a node's split points and leaves out each
child that some split point shows to be strictly farther than the best entry so far.
Distances are square roots, rounded outwards on both sides, so that rounding never
leaves out an entry that could be nearest or tie; squared distances themselves are exact
integers, by which entries are compared, then by index.  Queries go through the tree
together, each first into the child of its nearest split point.

Codebooks (256 x dimension numbers) and their trees are broadcast; sums come back as one
row for each entry and component.

Defined results: rows whose vector is null, empty, of another length than most, or
holds null or non-finite components are dropped, as are those with a component so large
(131,072 at 64 components) that a long doesn't hold sums of squares; rows of equal id and
vector count each; null ids come last; with fewer than 256 rows the codebooks are
smaller; null labels are together one label; an empty table gives an empty one; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, materialize
from .neardup import attach

LEVELS, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Split points of a node; entries of a node without children, at most; queries that go through the tree together.
DEGREE, LEAF, TOGETHER = 12, 16, 4096


# --- distances -------------------------------------------------------------------

def squared(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Exact squared distances (int64) of the rows of two integer matrices."""
    most = max(int(np.abs(q).max(initial=0)), int(np.abs(e).max(initial=0)))
    if 4 * q.shape[1] * most * most < 1 << 53:  # every sum is an integer that a double holds
        x, y = q.astype(np.float64), e.astype(np.float64)
        return ((x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2 * (x @ y.T)).astype(np.int64)
    out = np.empty((len(q), len(e)), np.int64)
    for k in range(len(e)):
        d = q - e[k]
        out[:, k] = (d * d).sum(axis=1)
    return out


def _below(squares: np.ndarray) -> np.ndarray:
    """Square roots, never too large: rounding to double and the root are off by less than two steps."""
    return np.maximum(0.0, np.nextafter(np.nextafter(np.sqrt(squares.astype(np.float64)), -np.inf), -np.inf))


def _above(squares: np.ndarray) -> np.ndarray:
    return np.nextafter(np.nextafter(np.sqrt(squares.astype(np.float64)), np.inf), np.inf)


# --- the tree ----------------------------------------------------------------------

class Node:
    """Split points (entries' indices, ascending); of each child its node (None: empty), and the least and largest distance from each split point."""

    def __init__(self, entries: np.ndarray, own: np.ndarray):
        self.children: list[Node | None] = []
        if len(own) <= LEAF:
            self.splits = own
            self.points = entries[own]
            return
        far = squared(entries[own], entries[own[:1]])[:, 0]
        chosen = [0]
        while len(chosen) < DEGREE and far.max() > 0:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, squared(entries[own], entries[own[chosen[-1:]]])[:, 0])
        if len(chosen) == 1:  # all entries are equal
            self.splits = own
            self.points = entries[own]
            return
        self.splits = own[sorted(chosen)]
        self.points = entries[self.splits]
        rest = np.setdiff1d(own, self.splits)
        d = squared(entries[rest], self.points)
        home = d.argmin(axis=1)
        k = len(self.splits)
        self.least, self.most = np.full((k, k), np.inf), np.full((k, k), -np.inf)  # [split point, child]
        for j in range(k):
            here = home == j
            if here.any():
                self.least[:, j], self.most[:, j] = _below(d[here].min(axis=0)), _above(d[here].max(axis=0))
                self.children.append(Node(entries, rest[here]))
            else:
                self.children.append(None)


class Tree:
    """A GNAT over a codebook's entries."""

    def __init__(self, entries: np.ndarray):
        self.root = Node(entries, np.arange(len(entries)))
        self.seen = 0  # distances computed

    def nearest(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of each row, ties to the lower index."""
        index, best = np.full(len(q), -1, np.int64), np.full(len(q), np.iinfo(np.int64).max)
        for i in range(0, len(q), TOGETHER):
            self._visit(self.root, q, np.arange(i, min(i + TOGETHER, len(q))), index, best)
        return index, best

    def _visit(self, node: Node, q: np.ndarray, rows: np.ndarray, index: np.ndarray, best: np.ndarray) -> None:
        d = squared(q[rows], node.points)
        self.seen += d.size
        k = d.argmin(axis=1)  # the first of equal ones: the lowest index of the node
        least, found = d[np.arange(len(rows)), k], node.splits[k]
        better = (least < best[rows]) | ((least == best[rows]) & (found < index[rows]))
        best[rows[better]], index[rows[better]] = least[better], found[better]
        if not node.children:
            return
        low, high = _below(d), _above(d)
        for first in (True, False):
            for j, child in enumerate(node.children):
                if child is None:
                    continue
                at = np.flatnonzero((k == j) == first)
                if not first:  # strictly farther than the best for some split point: left out
                    r = _above(best[rows[at]])[:, None]
                    inside = np.nextafter(low[at] - r, -np.inf) > node.most[:, j]
                    outside = np.nextafter(high[at] + r, np.inf) < node.least[:, j]
                    at = at[~(inside | outside).any(axis=1)]
                if len(at):
                    self._visit(child, q, rows[at], index, best)


# --- tables ------------------------------------------------------------------------

def cuts(dim: int) -> list[tuple[int, int]]:
    """The parts' ranges of components."""
    ends = np.cumsum([0, *(dim // PARTS + (p < dim % PARTS) for p in range(PARTS))]).tolist()
    return list(zip(ends[:-1], ends[1:]))


def _whole(vec: Column) -> Column:
    finite = F.forall(vec, lambda v: F.coalesce((F.abs(v) < float("inf")) & ~F.isnan(v), F.lit(False)))
    return vec.isNotNull() & (F.size(vec) > 0) & finite


def integers(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame | None, int]:
    """A written table (id, label, v array<int>) of the rows that take part, and their dimension (None, 0: none does)."""
    rows = vectors.select(column(id_col).cast("long").alias("id"), F.coalesce(F.concat(F.lit("="), column(label_col).cast("string")), F.lit("")).alias("label"), column(vec_col).cast("array<double>").alias("v"))
    rows = rows.where(_whole(F.col("v")))
    dims = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    if dims is None:
        return None, 0
    # differences of components are below 2 * limit: their squares' sum is below 2 ** 62
    limit = min(2.0**30, math.floor(math.sqrt(2.0**62 / dims["dim"]) / 2))
    rows = rows.where((F.size("v") == dims["dim"]) & F.forall("v", lambda x: F.abs(x) * LEVELS < limit))
    return materialize(rows.withColumn("v", F.transform("v", lambda x: F.floor(x * LEVELS).cast("int"))), "vector-integers"), dims["dim"]


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def codebooks(rows: DataFrame, dim: int, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The parts' entries after the rounds, of a written table (id, .., v)."""
    spark, parts = rows.sparkSession, cuts(dim)
    first = rows.select("id", "v").orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").toArrow()  # 256 rows
    start = _matrix(first.column("v").combine_chunks(), dim)
    books = [start[:, lo:hi] for lo, hi in parts]
    for _ in range(rounds if len(start) else 0):
        shared = spark.sparkContext.broadcast([(b, Tree(b)) for b in books])

        def add(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            n, sums = [np.zeros(len(b), np.int64) for b, _ in own], [np.zeros(b.shape, np.int64) for b, _ in own]
            for batch in batches:
                v = _matrix(batch.column(0), dim)
                for p, (lo, hi) in enumerate(parts):
                    k, _ = own[p][1].nearest(v[:, lo:hi])
                    order = np.argsort(k, kind="stable")
                    at = np.flatnonzero(np.diff(k[order], prepend=-1))
                    if len(at):
                        n[p] += np.bincount(k, minlength=len(n[p]))
                        sums[p][k[order][at]] += np.add.reduceat(v[order, lo:hi], at, axis=0)
            for p in range(PARTS):
                used = np.flatnonzero(n[p])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), p, np.int32)), pa.array(used.astype(np.int32)), pa.array(n[p][used]), pa.array(sums[p][used].tolist(), pa.list_(pa.int64()))], ["p", "k", "n", "s"])

        found = rows.select("v").mapInArrow(add, "p int, k int, n long, s array<long>").select("p", "k", "n", F.posexplode("s").alias("i", "s"))
        found = found.groupBy("p", "k", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).toArrow()  # entries x dimension rows
        books = [b.copy() for b in books]
        p, k, i, n, s = (found.column(c).to_numpy() for c in ("p", "k", "i", "n", "s"))
        for q in range(PARTS):
            books[q][k[p == q], i[p == q]] = np.floor_divide(s[p == q], n[p == q])
        shared.unpersist()
    return books


def encode(rows: DataFrame, dim: int, books: list[np.ndarray]) -> DataFrame:
    """(id, label, code, error) of a written table (id, label, v)."""
    shared, parts = rows.sparkSession.sparkContext.broadcast([Tree(b) for b in books]), cuts(dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column(2), dim)
            found = [t.nearest(v[:, lo:hi]) for t, (lo, hi) in zip(shared.value, parts)]
            codes = np.stack([k for k, _ in found], axis=1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(sum(d for _, d in found), pa.int64())], ["id", "label", "code", "error"])

    return rows.select("id", "label", "v").mapInArrow(run, "id long, label string, code string, error long")


def decode(code: str, books: list[np.ndarray]) -> np.ndarray:
    """The vector (in the input's scale) that a code stands for: its entries, side by side."""
    return np.concatenate([b[k] for b, k in zip(books, bytes.fromhex(code))]) / LEVELS


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry, position, joined by commas."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, list[np.ndarray]]:
    """(id, code, error, label_error, codebooks_sha256) of every row that takes part; and the codebooks."""
    rows, dim = integers(vectors, id_col, vec_col, label_col)
    if rows is None:
        return vectors.sparkSession.createDataFrame([], f"`{id_col}` long, code string, error long, label_error long, codebooks_sha256 string"), []
    books = codebooks(rows, dim)
    if not len(books[0]):
        return vectors.sparkSession.createDataFrame([], f"`{id_col}` long, code string, error long, label_error long, codebooks_sha256 string"), books
    coded = materialize(encode(rows, dim, books), "vector-codes")
    by_label = materialize(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "label-errors")
    found = attach(coded, by_label, "label", "n")
    return found.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")), books


def compress_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """DuckDB: the rows of ``compress`` (ids distinct, lengths equal and divisible by the parts)."""
    steps = [f"""
kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({LEVELS} * x::DOUBLE)) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), points AS MATERIALIZED (
  SELECT vec_id, label, p, list_slice(v, p * len(v) // {parts} + 1, (p + 1) * len(v) // {parts}) AS x FROM kept, range({parts}) AS r(p)
), book0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS k, x FROM points QUALIFY k < {entries}
)"""]
    for i in range(rounds + 1):
        steps.append(f"""near{i} AS MATERIALIZED (
  SELECT t.vec_id, t.p, any_value(t.label) AS label, any_value(t.x) AS x,
    min({{'d': list_inner_product(t.x, t.x) + list_inner_product(b.x, b.x) - 2 * list_inner_product(t.x, b.x), 'k': b.k}}) AS n
  FROM points t JOIN book{i} b ON t.p = b.p GROUP BY t.vec_id, t.p
)""")
        if i < rounds:
            steps.append(f"""book{i + 1} AS MATERIALIZED (
  SELECT b.p, b.k, coalesce(m.x, b.x) AS x FROM book{i} b LEFT JOIN (
    SELECT p, k, list(floor(s / c) ORDER BY i) AS x FROM (
      SELECT p, n.k AS k, i, sum(x[i]) AS s, count(*) AS c FROM near{i}, range(1, len(x) + 1) AS r(i) GROUP BY ALL
    ) GROUP BY p, k
  ) m ON b.p = m.p AND b.k = m.k
)""")
    return f"""WITH {", ".join(steps)}, coded AS (
  SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', n.k), '' ORDER BY p) AS code, sum(n.d)::BIGINT AS error FROM near{rounds} GROUP BY vec_id
), book AS (
  SELECT sha256(string_agg(x[i]::BIGINT::VARCHAR, ',' ORDER BY p, k, i)) AS h FROM book{rounds}, range(1, len(x) + 1) AS r(i)
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, (SELECT h FROM book) AS codebooks_sha256 FROM coded
"""
