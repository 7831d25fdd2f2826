"""Keys with a large part of all rows, exact quantiles, chunked lists, noded lines: against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from blockxwalk.operators import joins
from blockxwalk.operators.chunks import chunked, ranked
from blockxwalk.operators.noding import noded, nodes
from blockxwalk.operators.quantiles import quantiles
from blockxwalk.plans import match as M
from blockxwalk.plans.derived import counts_per_block

GEOM = "array<array<struct<x:double,y:double>>>"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _sides(spark, n=3000):
    rnd = random.Random(1)
    left = [(rnd.choice(["hot", None, f"k{rnd.randrange(300)}"]), i) for i in range(n)]
    right = [("hot", "a"), ("hot", "b"), (None, "n"), (None, "m")] + [(f"k{i}", f"r{i}") for i in range(250)]
    return spark.createDataFrame(left, "k string, i int"), spark.createDataFrame(right, "k string, v string")


@pytest.mark.parametrize("null_safe", [True, False])
def test_a_heavy_key_is_split_over_salts(spark, null_safe):
    left, right = _sides(spark)
    assert sorted(joins.heavy_keys(left, ["k"], 0.1, 10), key=str)[0][0] in ("hot", None)
    assert len(joins.heavy_keys(left, ["k"], 0.1, 10)) == 2
    split = joins.inner_heavy(left, right, "k", null_safe, share=0.1, least=10)
    assert "__salt" in split._jdf.queryExecution().optimizedPlan().toString()
    assert split.columns == ["k", "i", "v"]
    assert _rows(split) == _rows(joins.inner(left, right, "k", null_safe))
    # a heavy key's rows go to many join keys
    own = left.where("k = 'hot'").select(F.pmod(F.xxhash64("k", "i"), F.lit(8)).alias("s")).groupBy("s").count()
    assert own.count() == 8


def test_no_salts_without_a_heavy_key(spark):
    left, right = _sides(spark)
    plain = joins.inner_heavy(left.where("k like 'k%'"), right, {"k": "k"}, False, share=0.1, least=10)
    assert "__salt" not in plain._jdf.queryExecution().optimizedPlan().toString()


def test_a_third_of_the_directory_on_one_segment(spark, monkeypatch):
    monkeypatch.setattr(joins, "HEAVY_ROWS", 50)
    rows = [(1, i // 50 + 1, i % 50 + 1, "0000007" if i % 3 == 0 else f"{i % 40:07d}", 1000 + i, str(i), None, "ST", "10001") for i in range(900)]
    pad = spark.createDataFrame(rows, "boro int, block int, lot int, segid string, bin bigint, lhnd string, hhnd string, stname string, zipcode string")
    lookup = spark.createDataFrame([(f"{i:07d}", i, i // 2) for i in range(40)], "segid_chr string, segment_id bigint, physical_id bigint")
    w1 = M.wave1(M.pad_keys(pad), lookup)
    assert "__salt" in w1._jdf.queryExecution().optimizedPlan().toString()
    want = {(f"1{i // 50 + 1:05d}{i % 50 + 1:04d}", 7 if i % 3 == 0 else i % 40, (7 if i % 3 == 0 else i % 40) // 2) for i in range(900)}
    assert set(map(tuple, w1.collect())) == want and w1.count() == len(want)


def test_counts_per_block(spark):
    pad = spark.createDataFrame([(1, 1, 1, 5, "1", None, "A", "z"), (1, 1, 1, 5, "1", None, "A", "z"), (1, 1, 1, 0, "2", None, "A", "z"), (1, 1, 2, None, None, "9", "B", "z"), (1, 1, None, 8, "1", None, "A", "z")],
                                "boro int, block int, lot int, bin bigint, lhnd string, hhnd string, stname string, zipcode string")
    b2p = spark.createDataFrame([("1000010001", 10, "W1"), ("1000010001", 10, "W2"), ("1000010002", 10, "W1"), ("1000010002", 20, "W1"), ("1000010003", 30, "W1"), (None, 30, "W1")], "bbl_chr string, physical_id bigint, source string")
    got = {r.physical_id: (r.n_bbls, r.n_bins, r.n_addresses) for r in counts_per_block(pad, b2p).collect()}
    assert got == {10: (3, 1, 3), 20: (1, None, 1), 30: (2, None, None)}


def test_quantiles_are_exact(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice([None, 0.0, -1.5, rnd.gauss(0, 1e6), rnd.expovariate(1) ** 9]), rnd.randrange(5)) for _ in range(4000)]
    df = spark.createDataFrame(rows, "a double, b int")
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    want = df.agg(*[F.percentile(c, q).alias(f"{c}{q}") for c in "ab" for q in qs]).first()
    got = quantiles(df, {"a": qs, "b": qs}, buckets=4)  # many rounds
    assert [v for c in "ab" for v in got[c]] == list(want) and quantiles(df, {"a": qs, "b": qs}) == got
    assert quantiles(df.limit(0), {"a": [0.5]}) == {"a": [None]}
    assert quantiles(spark.createDataFrame([(3.0,)], "a double"), {"a": [0.3]}) == {"a": [3.0]}


def test_summaries_plan_without_percentile(spark):
    from blockxwalk.operators.aggregates import six_number
    df = spark.createDataFrame([(i % 7,) for i in range(100)], "n int")
    out = six_number(df, "n")
    assert "percentile" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert tuple(out.first()) == (0.0, 1.0, 3.0, round(sum(i % 7 for i in range(100)) / 100, 6), 5.0, 6.0)


def test_chunks_of_a_hot_key(spark):
    """A key with most rows: ranks count through, chunks are bounded, joined chunks are the list."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 50 + 2).alias("k"), ((F.col("id") * 7919) % 30_000).alias("o"))
    df = df.withColumn("v", F.concat(F.lit("v"), F.col("o").cast("string"))).union(spark.createDataFrame([(None, 3, "x"), (None, 1, "y")], "k long, o long, v string"))
    got = {}
    for r in chunked(df, ["k"], ["o"], "v", 100).collect():
        assert r["n_values"] <= 100 and r["text"].count(";") == r["n_values"] - 1
        got.setdefault(r["k"], {})[r["chunk"]] = r["text"]
    want = {}
    for r in sorted(df.collect(), key=lambda r: r["o"]):
        want.setdefault(r["k"], []).append(r["v"])
    assert {k: ";".join(c[i] for i in range(len(c))) for k, c in got.items()} == {k: ";".join(v) for k, v in want.items()}
    assert len(got[1]) == 200
    places = ranked(df.where("k = 1"), [], ["o"]).orderBy("o").select("rank").collect()
    assert [r[0] for r in places] == list(range(len(places)))


def test_a_block_of_a_million_ids(spark):
    df = spark.range(1_000_000).select(F.lit(1).alias("k"), F.col("id").alias("o"), F.col("id").cast("string").alias("v"))
    out = chunked(df, ["k"], ["o"], "v", 1000)
    r = out.agg(F.count("*").alias("n"), F.sum("n_values").alias("v"), F.max("n_values").alias("most"), F.max("chunk").alias("last")).first()
    assert tuple(r) == (1000, 1_000_000, 1000, 999)
    assert out.where("chunk = 417").first()["text"].startswith("417000;417001;")


def _line(*points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def test_noded_lines(spark):
    """A crossing, a T, an overlap, a repeated line turned round, another group; a NULL group; nothing of no length."""
    rows = [(1, [_line((0, 0), (10, 0)), _line((5, -5), (5, 5))]), (1, [_line((10, 0), (0, 0))]), (1, [_line((8, 0), (14, 0)), _line((2, 0), (2, 3)), _line((7, 7), (7, 7))]),
            (2, [_line((0, 0), (10, 10), (20, 0))]), (2, [_line((0, 10), (10, 0))]), (None, [_line((0, 0), (4, 0))]), (None, [_line((1, -1), (1, 1))])]
    df = spark.createDataFrame(rows, f"physical_id int, geom {GEOM}")
    pieces = noded(df)
    got = {}
    for r in pieces.collect():
        got.setdefault(r["physical_id"], set()).add(tuple(r)[1:])
    xs = [0, 2, 5, 8, 10, 14]
    assert got[1] == {(a, 0, b, 0) for a, b in zip(xs, xs[1:])} | {(5, -5, 5, 0), (5, 0, 5, 5), (2, 0, 2, 3)}
    assert got[2] == {(0, 0, 5, 5), (5, 5, 10, 10), (10, 10, 20, 0), (0, 10, 5, 5), (5, 5, 10, 0)}
    assert got[None] == {(0, 0, 1, 0), (1, 0, 4, 0), (1, -1, 1, 0), (1, 0, 1, 1)}
    degree = {(r["x"], r["y"]): r["degree"] for r in nodes(pieces).where("physical_id = 1").collect()}
    assert degree[(5, 0)] == 4 and degree[(2, 0)] == 3 and degree[(14, 0)] == 1


def test_noded_random_lines_meet_at_nodes_only(spark):
    """No two pieces of a group share more than ends, and their length is the length of the union."""
    rnd = random.Random(6)
    lines = [[(rnd.randrange(60), rnd.randrange(60)) for _ in range(rnd.randrange(2, 4))] for _ in range(60)]
    df = spark.createDataFrame([(1, [_line(*p)]) for p in lines], f"physical_id int, geom {GEOM}")
    pieces = [tuple(r)[1:] for r in noded(df).collect()]
    assert len(pieces) == len(set(pieces)) > 200

    def side(a, b, c):
        v = (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
        return 0 if abs(v) < 1e-7 else (1 if v > 0 else -1)

    for i, p in enumerate(pieces):
        for q in pieces[:i]:
            a, b, c, d = p[:2], p[2:], q[:2], q[2:]
            assert not (side(a, b, c) * side(a, b, d) < 0 and side(c, d, a) * side(c, d, b) < 0)
    assert noded(df.limit(0)).collect() == []


def test_no_key_is_shuffled_to_be_counted_without_a_full_bucket(spark):
    """Keys are counted by bucket first; those of a bucket with too many rows by themselves."""
    df = spark.createDataFrame([(f"k{i}",) for i in range(5000)] + [("hot",)] * 900 + [(None,)] * 800, "k string")
    assert sorted(joins.heavy_keys(df, ["k"], 0.1, 10), key=str) == [("hot", 900), (None, 800)]
    assert joins.heavy_keys(df.where("k like 'k%'"), ["k"], 0.01, 50) == []


def test_the_directory_is_shuffled_once_for_wave_1(spark):
    """Repeated rows of the directory and of the segments meet behind one shuffle of each; the billing wave joins wave 1, not the directory."""
    streets = spark.createDataFrame([(1, 10, None), (1, 10, None), (2, 20, 8), (3, None, 8), (None, 30, 1)], "segment_id bigint, physical_id bigint, legacy_id bigint")
    pad = spark.createDataFrame([(1, 1, 1, "1"), (1, 1, 1, "1"), (1, 1, 2, "8"), (1, 1, 2, "2"), (1, None, 2, "2"), (1, 1, 3, None)], "boro int, block int, lot int, segid string")
    w1 = M.wave1(M.directory_keys(pad), M.segment_ids(streets))
    plan = w1._jdf.queryExecution().executedPlan().toString()
    assert plan.count("+- Exchange") + plan.count(":- Exchange") == 3  # of the keys, of the segments, of the matches
    want = {("1000010001", 1, 10), ("1000010002", 2, 20), ("1000010002", 3, None)}
    assert sorted(map(str, map(tuple, w1.collect()))) == sorted(map(str, want))
    bill = spark.createDataFrame([(2, 1, 1, 1, 1, 2), (2, 1, 1, 1, 1, 2), (2, 1, 2, 1, 1, 9), (2, 1, 3, 1, 1, 1)],
                                 "billboro int, billblock int, billlot int, loboro int, loblock int, lolot int")
    rem = spark.createDataFrame([("2000010001",), ("2000010002",), (None,)], "bbl_chr string")
    assert sorted(map(str, map(tuple, M.wave2b(rem, bill, w1).collect()))) == sorted(map(str, [("2000010001", 2, 20), ("2000010001", 3, None)]))


def test_rows_that_lie_in_order_are_not_dealt_again(spark):
    df = spark.createDataFrame([("b", 0, "x"), ("a", 1, "y"), ("a", 0, "z"), ("c", 0, "w"), ("c", 1, "v")], "f string, i bigint, v string")
    out = ranked(df, (), ("f", "i"), "place", lying=True)
    assert {r.v: r.place for r in out.collect()} == {"z": 0, "y": 1, "x": 2, "w": 3, "v": 4} and out.columns == ["f", "i", "v", "place"]
    assert {r.v: r.place for r in ranked(df, (), ("f", "i"), "place").collect()} == {r.v: r.place for r in out.collect()}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "BroadcastHashJoin" in plan
