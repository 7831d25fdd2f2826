from pyspark.sql import functions as F

from blockxwalk.operators import aggregates as A


def test_mode_null_can_win_and_ties_go_to_smallest(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 5), (2, 7), (2, 3), (3, None), (3, 4)], "k int, v int")
    out = {r.k: r.v for r in A.mode_by(df, "k", "v", "m").select("k", F.col("m").alias("v")).collect()}
    assert out == {1: None, 2: 3, 3: 4}


def test_n_distinct_counts_null(spark):
    df = spark.createDataFrame([(1,), (None,), (1,), (2,)], "v int")
    assert df.agg(A.n_distinct_na("v")).first()[0] == 3
    assert spark.createDataFrame([], "v int").agg(A.n_distinct_na("v")).first()[0] == 0


def test_concat_distinct_first_appearance_and_na(spark):
    df = spark.createDataFrame([(1, 10, "B"), (1, 11, "A"), (1, 12, "B"), (1, 13, None)],
                               "k int, o int, s string")
    r = A.concat_distinct(df, "k", ["s"], "o", "; ", "streets").first()
    assert r.streets == "B; A; NA"


def test_concat_left_then_right(spark):
    df = spark.createDataFrame([(1, 2, "x", "y"), (1, 1, "y", "z")], "k int, o int, l string, r string")
    r = A.concat_distinct(df, "k", ["l", "r"], "o", ";", "ids").first()
    assert r.ids == "y;x;z"


def test_top1_by_order(spark):
    df = spark.createDataFrame([(1, "A", 10.0, 5.0), (1, "B", 10.0, 9.0), (1, "C", 3.0, 99.0), (2, "Z", 1.0, 1.0),
                                (2, "Y", 1.0, 1.0)], "k int, s string, len double, span double")
    out = {r.k: r.s for r in A.top1_by(df, "k", [("len", "desc"), ("span", "desc"), ("s", "asc")]).collect()}
    assert out == {1: "B", 2: "Y"}


def test_six_number_linear_quantiles(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (10,)], "n int")
    r = A.six_number(df, "n").first()
    assert (r["min"], r.q1, r.median, r.mean, r.q3, r["max"]) == (1.0, 1.75, 2.5, 4.0, 4.75, 10.0)


def test_share_rounds_half_up(spark):
    df = spark.createDataFrame([("a", 1), ("b", 7)], "s string, n bigint")
    out = {r.s: r.pct for r in A.share(df, "n", "pct", 1).collect()}
    assert out == {"a": 12.5, "b": 87.5}
    df = spark.createDataFrame([("a", 1), ("b", 2)], "s string, n bigint")
    assert {r.s: r.pct for r in A.share(df, "n").collect()} == {"a": 33.3, "b": 66.7}


def test_combine_rows(spark):
    a = spark.createDataFrame([(1,)], "x bigint")
    b = spark.createDataFrame([(2,)], "y bigint")
    r = A.combine_rows(a, b).first()
    assert (r.x, r.y) == (1, 2)
