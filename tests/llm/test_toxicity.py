"""Toxicity: held-out labels, and the noisy-or by plain arithmetic."""

import math
import random
import zlib

import numpy as np

from blockxwalk.llm import toxicity
from blockxwalk.llm.queries import op4_toxicity

DOCS, LABELS = "doc_id long, text string, score double, toxic int", "doc_id long, toxic int"


def corpus(n, seed=1):
    """Documents of invented sentences; toxic ones hold one or two bad words, with changing endings, somewhere."""
    rng = random.Random(seed)
    words = ["".join(rng.choice(["an", "er", "th", "in", "on", "re"]) for _ in range(rng.randrange(1, 4))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        sentences = [[rng.choice(words) for _ in range(rng.randrange(4, 12))] for _ in range(rng.randrange(1, 30))]
        toxic = rng.random() < 0.25
        for _ in range(rng.randrange(1, 3) if toxic else 0):
            s = rng.choice(sentences)
            s.insert(rng.randrange(len(s)), rng.choice(["idiot", "scum", "zokra" + rng.choice(words)]))
        docs.append((i, ". ".join(" ".join(s) for s in sentences), 0.0, 9))
        labels.append((i, int(toxic)))
    return docs, labels


def frames(spark, docs, labels):
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)


def test_held_out_documents_and_sentences(spark):
    docs, labels = corpus(2500)
    d, l = frames(spark, docs, labels)
    got = {r["doc_id"]: r for r in toxicity.score(d, toxicity.fit(d, l)).collect()}
    held = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    right = np.mean([(got[i]["score"] >= 0.5) == (y == 1) for i, y in held])
    assert right >= 0.95
    bad = [s for i, y in held if y for s in got[i]["sentences"]]
    texts = {i: t for i, t, *_ in docs}
    named = [any(w in texts[i][s["start"]:s["end"]] for w in ("idiot", "scum", "zokra")) for i, y in held if y for s in got[i]["sentences"]]
    assert bad and np.mean(named) >= 0.9


def test_held_out_labels_are_not_learned(spark):
    docs, labels = corpus(400)
    d, l = frames(spark, docs, labels)
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    a, b = toxicity.fit(d, l), toxicity.fit(d, spark.createDataFrame(turned, LABELS))
    assert np.array_equal(a["w"], b["w"]) and a["shift"] == b["shift"]


def plain_fit(rows):
    """The trained weights by plain loops over lists of sentences: (weights, bias, shift), of rows (id hash, text, label) in order."""
    bags = []
    for _, t, _ in rows:
        bag = []
        for m in toxicity.SENTENCE.finditer(t or ""):
            f = [x for w in set(m.group().lower().split()) for x in toxicity.features(w)]
            if f:
                bag.append(f)
        bags.append(bag)
    seen = {}
    for bag in bags:
        for x in {x for s in bag for x in s}:
            seen[x] = seen.get(x, 0) + 1
    bags = [[[x for x in s if seen[x] >= toxicity.LEAST_DOCS] for s in bag] for bag in bags]
    y, fold = [r[2] for r in rows], [r[0] % 7 == 0 for r in rows]
    w, g2, bias, b2, rng = {}, {}, -6.0, 1e-3, np.random.default_rng(7)
    odds = lambda s: sum(w.get(x, 0.0) for x in s) + bias
    learn = np.flatnonzero(~np.array(fold))
    for _ in range(toxicity.EPOCHS):
        rng.shuffle(learn)
        for i in range(0, len(learn), 64):
            grad, gb = {}, 0.0
            for d in learn[i:i + 64]:
                p = [1 / (1 + math.exp(-min(30, max(-30, odds(s))))) for s in bags[d]]
                clean = math.prod(1 - q for q in p)
                for s, q in zip(bags[d], p):
                    g = -q if y[d] == 0 else q * clean / max(1 - clean, 1e-12)
                    gb += g
                    for x in s:
                        grad[x] = grad.get(x, 0.0) + g
            for x, g in grad.items():
                g2[x] = g2.get(x, 1e-3) + g * g
                step = toxicity.RATE / math.sqrt(g2[x])
                moved = w.get(x, 0.0) + step * g
                w[x] = math.copysign(max(abs(moved) - step * toxicity.LASSO, 0), moved)
            b2 += gb * gb
            bias += toxicity.RATE * gb / math.sqrt(b2)
    return w, bias, bags


def test_query_against_a_plain_refit(spark, tmp_path):
    """Every score of the registered query, by a noisy-or trained and applied in plain Python."""
    docs, labels = corpus(160, 5)
    docs += [(900, "", None, None), (901, "an er idiot th", None, None)]
    d, l = frames(spark, docs, labels)
    d.write.parquet(str(tmp_path / "documents.parquet"))
    l.write.parquet(str(tmp_path / "labels.parquet"))
    got = {r["doc_id"]: r["score"] for r in op4_toxicity(spark, str(tmp_path)).collect()}
    hashed = {r["id"]: r["h"] for r in spark.createDataFrame([(i,) for i, _ in labels], "id long").selectExpr("id", "xxhash64(id) as h").collect()}
    texts = {r[0]: r[1] for r in docs}
    rows = sorted((hashed[i], texts[i], y) for i, y in labels if zlib.crc32(str(i).encode()) % 5)
    w, bias, bags = plain_fit(rows)
    noisy = lambda z: -sum(math.log1p(math.exp(v)) for v in z)  # noqa: E731  log of the probability that no sentence is toxic

    def log_odds(z):
        clean = min(noisy(z), -1e-9)
        return math.log(-math.expm1(clean)) - clean

    raw = [log_odds([sum(w.get(x, 0.0) for x in s) + bias for s in bag]) for bag in bags]
    held = sorted((r, row[2]) for r, row in zip(raw, rows) if row[0] % 7 == 0)
    wrong = [sum(t == 1 for _, t in held[:k]) + sum(t == 0 for _, t in held[k:]) for k in range(len(held) + 1)]
    edges = [held[0][0] - 1, *((a[0] + b[0]) / 2 for a, b in zip(held, held[1:])), held[-1][0] + 1]
    best = [k for k, n in enumerate(wrong) if n == min(wrong)]
    cut = edges[best[len(best) // 2]]
    for i, t, *_ in docs:
        z = [sum(w.get(x, 0.0) for v in set(m.group().lower().split()) for x in toxicity.features(v)) + bias for m in toxicity.SENTENCE.finditer(t) if m.group().split()]
        want = 1 / (1 + math.exp(-min(500, max(-500, log_odds(z) - cut))))
        assert abs(got[i] - want) < 1e-6, i


def test_noisy_or():
    w = toxicity.Weights({"w": np.zeros(1 << toxicity.BITS), "bias": 0.0, "scale": 1.0, "shift": 0.0})
    odds = np.array([-2.0, 0.5, -1.0])
    want = 1 - math.prod(1 - 1 / (1 + math.exp(-z)) for z in odds)
    assert abs(w.document(odds) - want) < 1e-12
    assert 0 <= w.document(np.zeros(0)) < 1e-6


def test_odd_rows(spark):
    docs, labels = corpus(300)
    odd = [(None, None, None, None), (None, "idiot scum.", None, 1), (5000, "", 1.0, 1), (5001, "!!! ... \n\n", 1.0, 1), (5002, "an " * 50_000, 1.0, 1), (0, docs[0][1], 0.0, 9)]
    d, l = frames(spark, docs + odd, labels + [(0, 1), (None, 1), (7, None), (9999, 1)])
    model = toxicity.fit(d, l)
    got = toxicity.score(d, model).collect()
    assert len(got) == 306 and all(0 <= r["score"] <= 1 for r in got)
    assert min(r["score"] for r in got) == next(r["score"] for r in got if r["doc_id"] == 5000)
    assert toxicity.score(d.limit(0), model).collect() == []
    kept = toxicity.keep_clean(d, model)
    assert kept.columns == d.columns and kept.count() == sum(r["score"] < 0.5 for r in got)
    for none in (l.limit(0), l.where("toxic = 0")):
        assert toxicity.fit(d, none) is None
    assert {r["score"] for r in toxicity.score(d, None).collect()} == {0.0}


def test_query(spark):
    rows = op4_toxicity(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.5)
