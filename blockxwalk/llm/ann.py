"""Approximate nearest neighbours by learned partitions.

On a bounded sample of the vectors, a neighbour graph (largest inner products)
is split into balanced parts: recursive halving along the main axis of the
vectors gives a start, then nodes move to the part of most of their neighbours
as long as the sizes stay in bounds.  A small network learns, from a vector, the
parts in which its neighbours are.  Every row of the table is indexed in its
most probable part; a query goes to so many of its most probable parts that on
held-out sample queries the recall against brute force reaches ``RECALL``, and
until they hold more than ``k`` rows.  In the parts the inner products are
computed in full and the nearest are reranked by exact double precision.

A query's floor, the k-th score among the sample's rows in its parts, keeps the
blocks from passing on what can't be among its nearest.

A part is worked through in blocks of rows and blocks of queries (by hashes of
their ids), so that no task gets more than two blocks, however many rows or
queries a part or one often repeated vector has.

Defined results: rows whose id is null, or whose vector is null, zero, of
another length than most, or holds null or non-finite components, take no part;
rows equal in id and vector count once; all rows with the query's own id are
left out of its result; equal scores go by smaller id; an empty table gives an
empty one; other columns of the input are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column, materialize

#: Rows of the sample that partitions and network are fitted on, at most.
SAMPLE = 6000
#: Rows to a part, about; parts at most; neighbours in the graph; hidden units; recall on the sample.
PART_ROWS, MAX_PARTS, GRAPH, HIDDEN, RECALL = 1500, 256, 10, 64, 0.95
#: Rows of candidates and of queries that one task compares at once.
BLOCK = 4096


def _products(a: np.ndarray, b: np.ndarray, k: int, own: np.ndarray | None = None) -> np.ndarray:
    """Indices in b of the k largest inner products of each row of a; own: the index to leave out."""
    out = []
    for i in range(0, len(a), 512):
        s = a[i:i + 512] @ b.T
        if own is not None:
            s[np.arange(len(s)), own[i:i + 512]] = -np.inf
        k_ = min(k, s.shape[1])
        out.append(np.argpartition(-s, k_ - 1, axis=1)[:, :k_])
    return np.concatenate(out) if out else np.zeros((0, k), int)


def balanced_parts(x: np.ndarray, near: np.ndarray, parts: int, slack: float = 0.1, sweeps: int = 8) -> np.ndarray:
    """A balanced partition of the neighbour graph: the part of each row."""
    part = np.zeros(len(x), int)
    rng = np.random.default_rng(1)

    def halve(rows: np.ndarray, first: int, n: int) -> None:
        if n == 1:
            part[rows] = first
            return
        centred = x[rows] - x[rows].mean(axis=0)
        axis = rng.normal(size=x.shape[1])
        for _ in range(10):
            axis = centred.T @ (centred @ axis)
            axis /= np.linalg.norm(axis) or 1.0
        left = n // 2
        order = rows[np.argsort(centred @ axis, kind="stable")]
        cut = len(rows) * left // n
        halve(order[:cut], first, left)
        halve(order[cut:], first + left, n - left)

    halve(np.arange(len(x)), 0, parts)
    size = np.bincount(part, minlength=parts)
    most, least = math.ceil((1 + slack) * len(x) / parts), math.floor((1 - slack) * len(x) / parts)
    back = [[] for _ in x]  # edges in both directions
    for i, row in enumerate(near):
        for j in row:
            back[j].append(i)
    edges = [np.concatenate([near[i], np.array(b, int)]) for i, b in enumerate(back)]
    for _ in range(sweeps):
        moved = 0
        for i in rng.permutation(len(x)):
            votes = np.bincount(part[edges[i]], minlength=parts)
            now, to = part[i], int(votes.argmax())
            if votes[to] > votes[now] and size[to] < most and size[now] > least:
                part[i] = to
                size[to] += 1
                size[now] -= 1
                moved += 1
        if moved < len(x) // 200:
            break
    return part


def _network(x: np.ndarray, target: np.ndarray, parts: int, epochs: int = 40) -> dict:
    """One hidden layer and a softmax over the parts, by Adam steps on the cross entropy."""
    rng = np.random.default_rng(2)
    scale = 1.0 / max(1e-12, float(np.sqrt((x * x).sum(axis=1).mean())))
    p = {"a": rng.normal(size=(x.shape[1], HIDDEN)) / math.sqrt(x.shape[1]) * 3, "b": np.zeros(HIDDEN), "c": rng.normal(size=(HIDDEN, parts)) / math.sqrt(HIDDEN), "d": np.zeros(parts), "e": np.zeros((x.shape[1], parts))}
    m, v = {k: np.zeros_like(w) for k, w in p.items()}, {k: np.zeros_like(w) for k, w in p.items()}
    x, step = x * scale, 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 128)):
            step += 1
            xb = x[rows]
            h = np.tanh(xb @ p["a"] + p["b"])
            g = (_softmax(h @ p["c"] + p["d"] + xb @ p["e"]) - target[rows]) / len(rows)
            back = (g @ p["c"].T) * (1 - h * h)
            for k, grad in {"a": xb.T @ back, "b": back.sum(axis=0), "c": h.T @ g, "d": g.sum(axis=0), "e": xb.T @ g}.items():
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad * grad
                p[k] = p[k] - 0.005 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return p | {"scale": scale}


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def routes(net: dict, x: np.ndarray) -> np.ndarray:
    """Log-odds of the parts, by row."""
    x = x * net["scale"]
    return np.tanh(x @ net["a"] + net["b"]) @ net["c"] + net["d"] + x @ net["e"]


def fit(x: np.ndarray, rows: int, k: int) -> dict:
    """The index of a sample x of ``rows`` vectors: network, number of parts, parts to probe."""
    parts = max(1, min(MAX_PARTS, rows // PART_ROWS, len(x) // 16))
    if parts == 1:
        return {"parts": 1, "probes": 1, "net": None}
    every = np.arange(len(x))
    near = _products(x, x, GRAPH, every)
    part = balanced_parts(x, near, parts)
    test = every % 5 == 0
    target = np.zeros((len(x), parts))
    for j in range(near.shape[1]):
        target[every, part[near[:, j]]] += 1
    target[every, part] += 1  # its own part: that is where the row will be looked for
    target /= target.sum(axis=1, keepdims=True)
    net = _network(x[~test], target[~test], parts)
    # recall of brute force on the held-out rows by number of probes; as dense a neighbourhood as k of all rows
    k_sample = max(1, min(len(x) - 1, max(GRAPH, round(k * len(x) / max(rows, 1)))))
    truth = _products(x[test], x, k_sample, every[test])
    where = routes(net, x).argmax(axis=1)
    order = np.argsort(-routes(net, x[test]), axis=1, kind="stable")
    rank = np.empty_like(order)
    rank[np.arange(len(order))[:, None], order] = np.arange(parts)
    hit = np.sort(rank[np.arange(len(order))[:, None], where[truth]].ravel())
    probes = int(hit[min(len(hit) - 1, math.ceil(RECALL * len(hit)) - 1)]) + 1
    return {"parts": parts, "probes": min(parts, probes), "net": net}


def _valid(vec: Column) -> Column:
    finite = F.forall(vec, lambda v: F.coalesce((F.abs(v) < float("inf")) & ~F.isnan(v), F.lit(False)))
    return vec.isNotNull() & (F.size(vec) > 0) & finite & F.exists(vec, lambda v: v != 0)


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    flat = col.flatten() if isinstance(col, pa.ListArray) else pa.concat_arrays(col.chunks).flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, <id>, score): the k nearest found of each query row, of all rows but its own."""
    spark = vectors.sparkSession
    rows = vectors.select(column(id_col).cast("long").alias("id"), column(vec_col).cast("array<double>").alias("v"), is_query.alias("q"))
    rows = rows.where(F.col("id").isNotNull() & _valid(F.col("v")))
    dims = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    if dims is None:
        return spark.createDataFrame([], f"query_id long, rank int, `{id_col}` long, score double")
    dim, n = dims["dim"], dims["n"]
    rows = rows.where(F.size("v") == dim)

    # the sample: the first rows by a hash, equal vectors once
    taken = rows.select("id", "v").orderBy(F.xxhash64("id", F.lit(3)), "id").limit(sample).select("v").toArrow()
    x = np.unique(_matrix(taken.column("v"), dim), axis=0)
    x = x[np.random.default_rng(0).permutation(len(x))]
    index = fit(x, n, k)
    shared = spark.sparkContext.broadcast((index["net"], x))
    parts, probes = index["parts"], index["probes"]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, _ = shared.value
        for b in batches:
            if b.num_rows:
                best = np.zeros(b.num_rows, np.int32) if net is None else routes(net, _matrix(b.column(1), dim)).argmax(axis=1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(best)], ["id", "v", "q", "part"])

    indexed = materialize(rows.mapInArrow(assign, "id long, v array<double>, q boolean, part int"), "ann-index")
    found = {r["part"]: (r["n"], r["nq"]) for r in indexed.groupBy("part").agg(F.count("*").alias("n"), F.sum(F.col("q").cast("int")).alias("nq")).collect()}  # MAX_PARTS rows at most
    size = np.array([found.get(p, (0, 0))[0] for p in range(parts)])
    blocks = np.maximum(1, -(-size // BLOCK)).astype(np.int32)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, known = shared.value
        home = np.zeros(len(known), int) if net is None else routes(net, known).argmax(axis=1)
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                q = _matrix(part.column(1), dim)
                order = np.zeros((len(q), 1), int) if net is None else np.argsort(-routes(net, q), axis=1, kind="stable")
                held = np.cumsum(size[order], axis=1)
                need = np.maximum(probes, (held <= k).sum(axis=1) + 1).clip(max=parts)
                # no result is below the score of k of the sample's rows that the query will meet (one more, as one may be its own)
                met = np.zeros((len(q), parts), bool)
                met[np.arange(len(q))[:, None], order] = np.arange(order.shape[1]) < need[:, None]
                s = np.where(met[:, home], q @ known.T, -np.inf)
                floor = np.partition(s, s.shape[1] - k - 1, axis=1)[:, s.shape[1] - k - 1] if s.shape[1] > k else np.full(len(q), -np.inf)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(floor), pa.array([o[:c] for o, c in zip(order, need)], pa.list_(pa.int32()))], ["id", "v", "floor", "to"])

    queries = indexed.where("q").select("id", "v").mapInArrow(route, "id long, v array<double>, floor double, to array<int>")
    queries = materialize(queries.select("id", "v", "floor", F.explode("to").alias("part")), "ann-queries")
    asked = {r["part"]: r["n"] for r in queries.groupBy("part").agg(F.count("*").alias("n")).collect()}  # MAX_PARTS rows at most
    query_blocks = [max(1, -(-asked.get(p, 0) // BLOCK)) for p in range(parts)]
    by_part = lambda values: F.array(*[F.lit(int(b)) for b in values])
    row_blocks, ask_blocks = F.element_at(by_part(blocks), F.col("part") + 1), F.element_at(by_part(query_blocks), F.col("part") + 1)
    own_block = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), n).cast("int")
    left = queries.select("id", "v", "floor", "part", own_block(ask_blocks, 5).alias("qb"), F.explode(F.sequence(F.lit(0), row_blocks - 1)).alias("cb"))
    wanted = indexed.where(by_part([asked.get(p, 0) for p in range(parts)])[F.col("part")] > 0)
    right = wanted.select("id", "v", "part", own_block(row_blocks, 7).alias("cb"), F.explode(F.sequence(F.lit(0), ask_blocks - 1)).alias("qb"))
    keys = ["part", "qb", "cb"]

    def compare(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        return _nearest(a.column("id").to_numpy(), _matrix(a.column("v"), dim), a.column("floor").to_numpy(), b.column("id").to_numpy(), _matrix(b.column("v"), dim), k)

    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, "query_id long, vec long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec"))
    near = near.distinct().withColumn("rank", rank).where(F.col("rank") <= k)
    return near.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("vec").alias(id_col), "score")


def _nearest(qid: np.ndarray, q: np.ndarray, floor: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int) -> pa.Table:
    """The k nearest of a block's rows for each of its queries, none below the query's floor, scores summed exactly."""
    # equal vectors are compared once; of their ids the k + 1 smallest can be needed (one may be the query's)
    order = np.lexsort((cid,))
    cid, c = cid[order], c[order]
    unique, which = np.unique(c, axis=0, return_inverse=True)
    by_vector = np.argsort(which.ravel(), kind="stable")
    starts = np.searchsorted(which.ravel()[by_vector], np.arange(len(unique) + 1))
    members = [np.unique(cid[by_vector[a:b]])[:k + 1] for a, b in zip(starts[:-1], starts[1:])]
    out_q, out_c, out_s = [], [], []
    bound = 1e-13 * max(1, q.shape[1]) * np.abs(unique).max()
    for i in range(0, len(q), 256):
        s = q[i:i + 256] @ unique.T
        take = min(k + 1, s.shape[1])
        least = np.partition(s, s.shape[1] - take, axis=1)[:, s.shape[1] - take]
        for r in range(len(s)):
            slack = bound * max(1e-300, np.abs(q[i + r]).max())
            found = []
            for u in np.flatnonzero(s[r] >= max(least[r], floor[i + r]) - 2 * slack):
                exact = math.fsum(q[i + r] * unique[u])
                found += [(-exact, int(x)) for x in members[u] if x != qid[i + r]]
            found.sort()
            out_q += [qid[i + r]] * len(found[:k])
            out_c += [x for _, x in found[:k]]
            out_s += [-x for x, _ in found[:k]]
    return pa.table({"query_id": pa.array(out_q, pa.int64()), "vec": pa.array(out_c, pa.int64()), "score": pa.array(out_s, pa.float64())})
