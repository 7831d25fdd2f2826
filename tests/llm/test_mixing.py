"""Poisson replication against a plain version and the given weights."""

import hashlib
import math
from collections import Counter

from blockxwalk.llm import mixing


def plain_copies(seed, i, text, mean):
    parts = max(1, math.ceil(mean / 500))
    n = 0
    for j in range(1, parts + 1):
        own = f"{seed}:{'' if i is None else i}:{hashlib.md5((text or '').encode()).hexdigest()}:{j}"
        u = int(hashlib.md5(own.encode()).hexdigest()[:13], 16) / 2**52
        k, p = 0, math.exp(-mean / parts)
        c = p
        while c <= u and k < 5000:
            k += 1
            p *= mean / parts / k
            c += p
        n += k
    return n


ROWS = [(i, f"text {i} " * (i % 7), "abc"[i % 3] if i % 11 else None, 9, 5) for i in range(400)]
KINDS = "doc_id long, text string, source string, copy int, cdf int"


def test_counts(spark):
    df = spark.createDataFrame([*ROWS, (None, None, "a", 1, 1)], KINDS)
    got = Counter(r["doc_id"] for r in mixing.mix(df).collect())
    volume = Counter()
    for _, t, s, _, _ in [*ROWS, (None, None, "a", 1, 1)]:
        volume[s] += len(t or "") + 1
    w = {s: math.sqrt(v) for s, v in volume.items()}
    for i, t, s, _, _ in [*ROWS, (None, None, "a", 1, 1)]:
        mean = sum(volume.values()) * w[s] / sum(w.values()) / volume[s]
        assert got[i] == plain_copies(1, i, t, mean), i


def test_weights_are_met_and_large_means(spark):
    rows = [(i, "x" * 99, "big" if i < 4000 else "small") for i in range(4001)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = Counter(r["source"] for r in mixing.mix(df, {"big": 1.0, "small": 1.0, "absent": 5.0}).select("source").collect())
    assert abs(got["big"] / 4001 - 0.5) < 0.05
    assert got["small"] == plain_copies(1, 4000, "x" * 99, 4001 * 0.5) and abs(got["small"] / 4001 - 0.5) < 0.05


def test_columns_kept_and_same_by_salted_join(spark, monkeypatch):
    df = spark.createDataFrame(ROWS, KINDS)
    a = mixing.mix(df)
    assert a.columns == ["doc_id", "text", "source", "cdf", "copy"]
    key = lambda r: tuple((v is not None, v) for v in r)
    rows = sorted(a.collect(), key=key)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(mixing.mix(df).collect(), key=key) == rows


def test_empty_and_zero_weights(spark):
    df = spark.createDataFrame(ROWS, KINDS)
    assert mixing.mix(df.limit(0)).collect() == []
    assert mixing.mix(df, {"a": 0.0}).collect() == []


def test_order_is_shuffled(spark):
    df = spark.createDataFrame([(i, "t", "s") for i in range(2000)], "doc_id long, text string, source string")
    ids = [r["doc_id"] for r in mixing.mix(df).collect()]
    up = sum(a < b for a, b in zip(ids, ids[1:]))
    assert 0.4 < up / len(ids) < 0.6
