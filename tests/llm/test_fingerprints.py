"""Fingerprints against a plain Python version."""

import hashlib
import random

from pyspark.sql import functions as F

from blockxwalk.llm import fingerprints as fp
from blockxwalk.llm.queries import op3_fingerprints


def jaccard(a, b):
    a, b = ({p for p in t.split("\n") if p} for t in (a, b))
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(t, following):
    k = len(t) // 2
    return t[:len(t) - k] + following[:k]


def check(rows, docs):
    """docs: (id, text) in order."""
    got = {r["id"]: r for r in rows}
    assert len(rows) == len(docs)
    seen = {}
    for i, (key, t) in enumerate(docs):
        t, following = t or "", docs[(i + 1) % len(docs)][1] or ""
        e, r = edited(t, following), got[key]
        assert r["n_chars"] == len(t)
        assert r["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest()
        assert abs(r["near_edited"] - jaccard(t, e)) < 1e-12
        assert abs(r["near_next"] - jaccard(t, following)) < 1e-12
        assert seen.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        assert seen.setdefault(e, r["edited_fingerprint"]) == r["edited_fingerprint"]


def make(n, seed):
    rng = random.Random(seed)
    pool = [f"paragraph {i} é \U0001f600" * rng.randrange(1, 3) for i in range(400)]
    return [(rng.randrange(10**12) - 5 * 10**11, "\n".join(rng.choices(pool, k=rng.choice([0, 1, 2, 5, 40, 300])))) for i in range(n)]


def test_likeness_is_exact(spark):
    docs = sorted(make(60, 1) + [(0, None), (1, ""), (2, "a\n" * 50_000), (3, "\n".join(map(str, range(6000))))])
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, next int")
    check(fp.compare(fp.edited(df)).collect(), docs)


def test_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(fp, "RANGE_ROWS", 2)
    docs = sorted(make(300, 2))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    check(fp.compare(fp.edited(df)).collect(), docs)


def test_peeling_recovers_the_digests(spark):
    a, b = [f"x{i}" for i in range(200)], [f"x{i}" for i in range(150, 230)]
    df = spark.createDataFrame([("\n".join(a), "\n".join(b))], "a string, b string").select(fp.paragraphs(F.col("a")).alias("a"), fp.paragraphs(F.col("b")).alias("b"))
    df = df.select("a", "b", fp.sketch(F.col("a")).alias("sa"), fp.sketch(F.col("b")).alias("sb"))
    r = df.select("a", "b", fp._peel(fp._subtract(F.col("sa"), F.col("sb"))).alias("small"), fp.recovered(F.col("a"), F.col("b")).alias("large"),
                  fp.differing(F.col("a"), F.col("b"), F.col("sa"), F.col("sb")).alias("d")).collect()[0]
    assert r["small"] is None
    assert set(r["large"]) == set(r["d"]) == set(r["a"]) ^ set(r["b"]) and len(r["d"]) == len(set(r["d"]))


def test_a_hundred_thousand_differing_lines_are_peeled(spark):
    df = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(80_000)), lambda i: F.xxhash64(i)).alias("a"), F.transform(F.sequence(F.lit(30_001), F.lit(130_000)), lambda i: F.xxhash64(i)).alias("b"))
    df = df.select("a", "b", fp.recovered(F.col("a"), F.col("b")).alias("d"))
    r = df.select(F.size("d").alias("n"), F.size(F.array_except(F.concat(F.array_except("a", "b"), F.array_except("b", "a")), "d")).alias("missing")).first()
    assert (r["n"], r["missing"]) == (80_000, 0)


def test_digests_of_equal_low_bits_are_told_apart(spark):
    """Digests that go to the same blocks up to the last bits."""
    df = spark.createDataFrame([([(i << 40) | 5 for i in range(-40, 40)] + [5 + (1 << 63) - (1 << 64)], [(3 << 62) - (1 << 64) + 5, 5])], "a array<bigint>, b array<bigint>")
    r = df.select("a", "b", fp.recovered(F.col("a"), F.col("b")).alias("d")).first()
    assert set(r["d"]) == set(r["a"]) ^ set(r["b"])


def test_one_document_and_none(spark):
    df = spark.createDataFrame([(7, "ab\ncd")], "doc_id long, text string")
    check(fp.compare(fp.edited(df)).collect(), [(7, "ab\ncd")])
    assert fp.compare(fp.edited(df.limit(0))).collect() == []


def test_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(1, "a\nb"), (1, "a\nb"), (None, "c"), (None, None), (5, "d")], "doc_id long, text string")
    assert fp.compare(fp.edited(df)).count() == 5


def test_query(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect())
    check(op3_fingerprints(spark, "/root/testdata/sf0.001").withColumnRenamed("doc_id", "id").collect(), docs)
