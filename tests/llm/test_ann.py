"""Nearest neighbours against brute force."""

import math

import numpy as np
from pyspark.sql import functions as F

from blockxwalk.llm import ann
from blockxwalk.llm.queries import op9_ann

KINDS = "vec_id long, embedding array<float>, part int, q boolean"


def brute(ids, x, k=20):
    out = {}
    for i in np.flatnonzero(ids % 20 == 0):
        s = [(-math.fsum(x[i].astype(float) * x[j].astype(float)), int(ids[j])) for j in range(len(ids)) if ids[j] != ids[i]]
        out[int(ids[i])] = [(j, -v) for v, j in sorted(s)[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def search(spark, rows):
    return found(ann.search(spark.createDataFrame([(*r, 1, False) for r in rows], KINDS), F.col("vec_id") % 20 == 0))


def test_odd_vectors_take_no_part_and_ties(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 4)).astype(np.float32)
    x[10:50] = x[10]  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(100, None), (120, [0.0] * 4), (140, [1.0, None, 1.0, 1.0]), (160, [float("nan"), 1.0, 1.0, 1.0]), (180, [float("inf"), 1.0, 1.0, 1.0]), (200, [1.0]), (220, []), (None, [1.0] * 4)]
    assert search(spark, rows + odd + rows[:3]) == brute(np.arange(60), x)


def test_fewer_rows_than_k_and_none(spark):
    x = np.eye(3, dtype=np.float32)
    got = search(spark, [(20 * i, v.tolist()) for i, v in enumerate(x)])
    assert got == brute(np.arange(3) * 20, x) and all(len(v) == 2 for v in got.values())
    assert search(spark, []) == {}


def test_partitions_blocks_and_one_hot_vector(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART_ROWS", 200)
    monkeypatch.setattr(ann, "BLOCK", 100)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 16))
    x = (centres[rng.integers(0, 20, 3000)] + 0.3 * rng.normal(size=(3000, 16))).astype(np.float32)
    x[:1000] = x[0]
    ids = rng.permutation(3000)
    got, want = search(spark, [(int(i), v.tolist()) for i, v in zip(ids, x)]), brute(ids, x)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    assert np.mean([len({j for j, _ in got[q]} & {j for j, _ in want[q]}) / 20 for q in want]) >= 0.9
    exact = {int(i): v.astype(float) for i, v in zip(ids, x)}
    assert all(s == math.fsum(exact[q] * exact[j]) for q in got for j, s in got[q])


def test_parts_are_balanced():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 8))
    sizes = np.bincount(ann.balanced_parts(x, ann._products(x, x, 10, np.arange(2000)), 7), minlength=7)
    assert sizes.min() >= 0.85 * 2000 / 7 and sizes.max() <= 1.15 * 2000 / 7


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows])
    got, want = found(op9_ann(spark, sf)), brute(ids, x)
    assert np.mean([len({j for j, _ in got[q]} & {j for j, _ in want[q]}) / 20 for q in want]) >= 0.9
