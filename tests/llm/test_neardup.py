"""Near-duplicate classes against all pairs."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from blockxwalk.llm import neardup
from blockxwalk.llm.queries import op6_neardup


def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def weighted(t):
    w = words(t)
    found = Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter([("raw", t or "")])
    return {x: 1 + math.log(n) for x, n in found.items()}


def plain_similarity(x, y):
    """Probability Jaccard by its definition; of plain sets, where all weights are 1, by counting."""
    both, every = x.keys() & y.keys(), x.keys() | y.keys()
    if max(*x.values(), *y.values()) == 1:
        return len(both) / len(every)
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in every) for i in both)


def plain_classes(docs):
    """Least id by row."""
    sets = [weighted(t) for _, t in docs]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, s in enumerate(sets):
        both = defaultdict(int)
        for x in s:
            for j in holders[x]:
                if j > i:
                    both[j] += 1
        for j in both:
            if find(i) != find(j) and (s.keys() == sets[j].keys() and s == sets[j] or plain_similarity(s, sets[j]) >= 0.8 - 1e-9):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(docs):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return [least.get(find(i)) for i in range(len(docs))]


def frame(spark, docs):
    return spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, node string, n int")


def same(spark, docs):
    got = neardup.classes(frame(spark, docs))[0].collect()
    assert len(got) == len(docs)
    want = plain_classes(docs)
    assert sorted(((r["id"], r["class_id"]) for r in got), key=str) == sorted(((key, c) for (key, _), c in zip(docs, want)), key=str)
    return want


def edit(rng, w, n):
    w = list(w)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**9)}"
    return w


def corpus(seed, groups, copies, shared):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(groups):
        base = [word() for _ in range(rng.choice([3, 20, 100, 300]))]
        texts.append(base)
        for _ in range(rng.randrange(copies)):
            texts.append(edit(rng, base, rng.randrange(max(1, len(base) // 40) + 1)))
    for _ in range(shared):  # one passage in all of them, else nothing
        texts.append([word() for _ in range(30)] + passage + [word() for _ in range(30)])
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def test_against_all_pairs(spark):
    docs = corpus(1, 60, 6, 60) + [(9001, None), (9002, ""), (9003, "!!"), (9004, "!!"), (9005, "one two"), (9006, "One, two!"), (9007, "a b c d e f " * 3000)]
    assert len(set(same(spark, docs))) < len(docs) - 20


@pytest.mark.parametrize("depth", [8, 2])
def test_large_groups_and_buckets(spark, monkeypatch, depth):
    """Many near copies of one text, some of which have copies of their own; one passage in many documents."""
    monkeypatch.setattr(neardup, "SMALL", 3)
    monkeypatch.setattr(neardup, "DEPTH", depth)
    monkeypatch.setattr(neardup, "HOT_ROWS", 5)
    rng = random.Random(4)
    base = [f"b{i}" for i in range(200)]
    near = [edit(rng, base, rng.randrange(1, 12)) for _ in range(60)]
    near += [edit(rng, near[rng.randrange(20)], rng.randrange(1, 4)) for _ in range(30)] + [base[:-k] for k in range(1, 40, 6)]
    docs = [(10_000 + i, " ".join(w)) for i, w in enumerate(near)] + [(20_000, " ".join(base))]
    passage = [f"p{i}" for i in range(90)]
    docs += [(30_000 + i, " ".join(passage + [f"x{i // 2}_{k}_{i % 2 if k < 4 else 0}" for k in range(25)])) for i in range(50)]
    assert len(set(same(spark, docs))) > 20


def test_null_and_repeated_ids(spark):
    t = "a b c d e f g h"
    docs = [(None, t), (5, t), (5, t), (3, t + " i"), (7, "other text here"), (7, t), (None, "alone one two")]
    same(spark, docs)
    kept = neardup.keep_one(frame(spark, docs))
    assert kept.columns == ["doc_id", "text", "node", "n"]
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [3, 7, None]


def test_empty(spark):
    df = frame(spark, [(1, "a")]).limit(0)
    assert neardup.classes(df)[0].collect() == []
    assert neardup.keep_one(df).collect() == []


@pytest.mark.parametrize("a,b", [(0, 0), (10, 3), (40, 40)])
def test_registers_estimate_probability_jaccard(a, b):
    rng = np.random.default_rng(1)
    e = rng.integers(1, 2**63, 100).astype(np.uint64)
    wx, wy = np.r_[np.ones(60), np.full(40, 3.0)], np.r_[np.ones(60), np.full(40, 1.0)]
    x, y = e[a:], e[:100 - b]
    wx, wy = wx[a:], wy[:100 - b]
    m = 4000
    r = neardup.prob_min_hash(np.r_[x, y], np.r_[wx, wy], np.repeat([0, 1], [len(x), len(y)]), 2, m)
    dx, dy = dict(zip(x, wx)), dict(zip(y, wy))
    want = sum(1 / sum(max(dx.get(j, 0) / dx[i], dy.get(j, 0) / dy[i]) for j in dx.keys() | dy.keys()) for i in dx.keys() & dy.keys())
    assert abs((r[0] == r[1]).mean() - want) < 0.03


def test_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = {r["doc_id"]: r["class_id"] for r in op6_neardup(spark, "/root/testdata/sf0.001").collect()}
    assert got == dict(zip([i for i, _ in docs], plain_classes(docs)))


def test_exact_similarity():
    rng = np.random.default_rng(3)
    for _ in range(200):
        x, y = (np.unique(rng.integers(0, 40, rng.integers(1, 40))).astype(np.uint32) for _ in "xy")
        nx, ny = (rng.choice([1, 1, 2, 30], len(e)) for e in (x, y))
        a, b = neardup.unpack(neardup.pack(np.repeat(x, nx))), neardup.unpack(neardup.pack(np.repeat(y, ny)))
        assert (a[0] == x).all() and np.allclose(a[1], 1 + np.log(nx))
        got = neardup.probability_jaccard(*a, *b)
        assert abs(got - plain_similarity(dict(zip(x.tolist(), a[1])), dict(zip(y.tolist(), b[1])))) < 1e-12
        # the bounds that prefixes and references go by
        i, j = neardup.shared(x, y)
        p, q = a[1] / a[1].sum(), b[1] / b[1].sum()
        s, t = p[i].sum(), q[j].sum()
        assert got <= np.minimum(p[i], q[j]).sum() + 1e-12 and (not len(i) or got <= 1 / (1 / s + 1 / t - 1) + 1e-12)


def test_bound_of_pairs_that_share_inside_a_reference_only():
    rng = np.random.default_rng(4)
    high = 0
    for _ in range(3000):
        r, least = rng.choice(60, rng.integers(20, 60), replace=False), rng.choice([0.5, 0.95])
        x, y = (np.unique(np.r_[rng.choice(r, rng.integers(int(len(r) * least), len(r) + 1), replace=False), base + np.arange(rng.integers(0, 3))]) for base in (100, 200))
        counts = rng.choice([1, 1, 1, 2, 9], 300)
        a, b = (neardup.weights(np.where(rng.random(len(v)) < least, counts[v], 1)) for v in (x, y))
        inside = [np.isin(v, r) for v in (x, y)]
        held, extra = [i.sum() for i in inside], [w[i].sum() - i.sum() for w, i in zip((a, b), inside)]
        s = min(a[inside[0]].sum(), held[1] + extra[0]) / a.sum()
        t = min(b[inside[1]].sum(), held[0] + extra[1]) / b.sum()
        got = neardup.probability_jaccard(x, a, y, b)
        assert got <= 1 / (1 / s + 1 / t - 1) + 1e-12
        if got >= 0.8:
            high += 1
            assert held[1] >= 0.8 * a.sum() - extra[0] - 1e-9 and held[1] - 0.25 * extra[1] <= held[0] / 0.8 + 1e-9
    assert high > 20


def test_copies_with_other_repeat_counts(spark):
    """Repeat counts are weights: a passage that one text repeats often tells it from its copy, one repeated a few times doesn't."""
    rows = []
    for i, n in enumerate([0, 1, 2, 3, 5, 8, 20, 100, 500]):
        words = [f"w{i}x{j}" for j in range(204)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words + words[:24] * n))]
    want = same(spark, rows)
    assert 0 < sum(a == b for a, b in zip(want[::2], want[1::2])) < 9


def test_recall_on_planted_copies(spark):
    """Pairs whose similarity is 0.8 or little more, repeats included."""
    rng = random.Random(8)
    rows = []
    for i in range(300):
        base = [f"b{i}x{j}" for j in range(120)]
        base += base[:30] * rng.randrange(3)
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(edit(rng, base, rng.randrange(1, 4))))]
    same(spark, rows)


def test_rows_that_do_not_come_straight_from_a_file(spark, tmp_path):
    """Rows of a file that are repeated have one place: they are written anew."""
    docs = corpus(2, 10, 4, 5)
    spark.createDataFrame([(*d, "m", 2) for d in docs], "doc_id long, text string, _metadata string, file int").repartition(3).write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    kept = sorted({c for c in plain_classes(docs)})
    for rows in (df, df.where("doc_id >= 0").select("file", "text", "doc_id", "_metadata"), df.selectExpr("*", "explode(array(1, 2)) as at"), df.unionByName(df)):
        found = neardup.keep_one(rows)
        assert found.columns == rows.columns and sorted(r["doc_id"] for r in found.collect()) == kept
