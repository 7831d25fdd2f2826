"""Near-duplicate vectors against all pairs in double precision."""

import numpy as np
import pytest

from blockxwalk.llm import vecdup
from blockxwalk.llm.queries import op11_vecdup

KINDS = "vec_id long, embedding array<float>, n_links int, h string"


def brute(rows):
    """Sorted (id, n_links, component_id, kept) of rows (id, vector); vectors of odd rows are None."""
    once = sorted({(i, tuple(v)) for i, v in rows if v is not None and i is not None})
    x = np.array([v for _, v in once], np.float64)
    n = np.sqrt((x * x).sum(axis=1)) if len(x) else x
    link = ((x @ x.T) / np.outer(n, n) >= 0.9) if len(x) else np.zeros((0, 0), bool)
    np.fill_diagonal(link, False)
    label = np.arange(len(once))
    while True:
        new = np.array([min([label[k], *label[link[k]]]) for k in range(len(once))], int)
        if (new == label).all():
            break
        label = new
    found = {r: (int(link[k].sum()), once[label[k]][0]) for k, r in enumerate(once)}
    out = []
    for i, v in rows:
        d, c = found[(i, tuple(v))] if v is not None and i is not None else (0, i)
        out.append((i is None, i or 0, d, c or 0, i is not None and c == i))
    return sorted(out)


def result(df):
    return sorted((r["vec_id"] is None, r["vec_id"] or 0, r["n_links"], r["component_id"] or 0, r["kept"]) for r in df.collect())


def f32(x):
    return [float(v) for v in np.asarray(x, np.float32)]


def clustered(rng, n, dim, spread):
    c = rng.normal(size=(12, dim))
    return c[rng.integers(0, 12, n)] + spread * rng.normal(size=(n, dim))


@pytest.mark.parametrize("dim", [1, 3, 64, 1500])
def test_bounds_hold_and_links_are_exact(dim):
    rng = np.random.default_rng(dim)
    x, y = clustered(rng, 150, dim, 0.33), clustered(rng, 90, dim, 0.33) * rng.lognormal(size=(90, 1))
    a, b = vecdup.Side(x), vecdup.Side(y)
    cos = (x @ y.T) / np.outer(np.sqrt((x * x).sum(axis=1)), np.sqrt((y * y).sum(axis=1)))
    near = vecdup.products(a.q, b.q) * a.scale[:, None] * b.scale
    assert (vecdup.products(a.q, b.q) == a.q.astype(int) @ b.q.astype(int).T).all()
    assert (abs(cos - near) <= a.error[:, None] + b.error + np.outer(a.error, b.error) + vecdup.SLACK).all()
    got, full = set(), 0
    for r, c, n in vecdup.linked(a, b):
        got |= set(zip(r.tolist(), c.tolist()))
        full += n
    assert got == set(zip(*map(np.ndarray.tolist, np.nonzero(cos >= 0.9))))
    assert full < 0.2 * cos.size


def test_only_open_pairs_are_computed_in_full():
    rng = np.random.default_rng(5)
    x = clustered(rng, 400, 64, 0.05)
    a = vecdup.Side(x)
    assert sum(n for _, _, n in vecdup.linked(a, a)) == 0  # copies of a cluster are sure


def test_extreme_lengths():
    x = np.array([[1e300, 1e300], [1e-300, 1e-300], [5e-324, 5e-324], [1e300, -1e300]])
    a = vecdup.Side(x)
    assert [(r.tolist(), c.tolist()) for r, c, _ in vecdup.linked(a, a)] == [([0, 0, 0, 1, 1, 1, 2, 2, 2, 3], [0, 1, 2, 0, 1, 2, 0, 1, 2, 3])]


def test_odd_rows_ties_and_repeats(spark):
    rng = np.random.default_rng(1)
    rows = [(i, f32(v)) for i, v in enumerate(clustered(rng, 200, 6, 0.2))]
    rows += [(-5, rows[0][1]), (300, rows[0][1]), (300, rows[0][1]), (301, f32(np.array(rows[1][1]) * 3)), rows[2], (3, f32(-np.array(rows[3][1])))]
    odd = [(400, None), (401, []), (402, [0.0] * 6), (403, [1.0] * 5), (404, [None] + [1.0] * 5), (405, [float("nan")] * 6), (406, [float("inf")] + [1.0] * 5), (None, rows[0][1]), (None, None)]
    df = spark.createDataFrame([(*r, 9, "x") for r in rows + odd], KINDS)
    want = brute(rows + [(i, None if i else v) for i, v in odd])
    assert result(vecdup.classes(df)) == want
    assert result(vecdup.classes(df.where("vec_id in (400, 402, 405)"))) == brute([(400, None), (402, None), (405, None)])
    assert vecdup.classes(df.limit(0)).collect() == []


def test_a_hot_vector_cells_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(vecdup, "LEAST_BLOCK", 40)
    monkeypatch.setattr(vecdup, "MOST_BLOCK", 40)
    monkeypatch.setattr("blockxwalk.llm.neardup.HOT_ROWS", 50)
    rng = np.random.default_rng(2)
    x = clustered(rng, 900, 8, 0.15)
    x[:300] = x[0]  # a third are one vector
    x[300:500] = x[300] + 0.02 * rng.normal(size=(200, 8))  # and many near copies
    rows = [(int(i), f32(v)) for i, v in zip(rng.permutation(900) - 100, x)]
    df = spark.createDataFrame([(*r, 9, "x") for r in rows], KINDS)
    assert result(vecdup.classes(df)) == brute(rows)
    monkeypatch.setattr(vecdup, "BLOCK_NUMBERS", 64 * 8)  # smaller blocks for long vectors
    doubles = df.selectExpr("vec_id", "cast(embedding as array<double>) as embedding")
    assert result(vecdup.classes(doubles)) == brute(rows)


def test_far_cells_are_left_out(spark, monkeypatch):
    """Nodes are sent to the cells they can have links in only."""
    monkeypatch.setattr(vecdup, "LEAST_BLOCK", 40)
    sent = []
    usual = vecdup.materialize

    def spy(df, name):
        df = usual(df, name)
        if name == "vector-routes":
            sent.append((df.selectExpr("sum(size(to)) as n").first()["n"], df.count()))
        return df

    monkeypatch.setattr(vecdup, "materialize", spy)
    rng = np.random.default_rng(3)
    rows = [(i, f32(v)) for i, v in enumerate(np.eye(12)[rng.integers(0, 12, 600)] * 3 + 0.02 * rng.normal(size=(600, 12)))]
    assert result(vecdup.classes(spark.createDataFrame([(*r, 9, "x") for r in rows], KINDS))) == brute(rows)
    n, count = sent[0]
    assert n < 0.25 * count * 14


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert result(op11_vecdup(spark, sf)) == brute(rows)


def test_near_copies_of_the_given_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    x = np.array([v for _, v in rows])
    unit = rng.normal(size=(1500, 64))
    unit /= np.sqrt((unit * unit).sum(axis=1))[:, None]
    at = rng.integers(0, 60, 1500)
    # cosines to their source spread around the threshold
    more = [(100_000 + k, f32(x[s] + w * u)) for k, (s, w, u) in enumerate(zip(at, rng.uniform(0.2, 0.7, 1500), unit))]
    df = spark.createDataFrame([(*r, 9, "x") for r in rows + more], KINDS)
    assert result(vecdup.classes(df)) == brute([(i, f32(v)) for i, v in rows] + more)
