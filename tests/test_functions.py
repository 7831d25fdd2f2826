
from blockxwalk.functions import keys as K
from blockxwalk.functions import text as X


def one(spark, col, rows, schema="v string"):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(col.alias("o")).collect()]


def test_trim_ws_removes_tabs_and_newlines(spark):
    assert one(spark, X.trim_ws("v"), [("\t 100 \n",), (None,), ("",)]) == ["100", None, ""]


def test_not_blank(spark):
    assert one(spark, X.not_blank("v"), [("  ",), (None,), (" a",)]) == [False, False, True]


def test_pad_left_never_truncates(spark):
    assert one(spark, X.pad_left("v", 5), [("12",), ("123456",), (None,)]) == ["00012", "123456", None]


def test_digits_and_extract(spark):
    assert one(spark, X.digits("v"), [("1-23 a4",)]) == ["1234"]
    assert one(spark, X.extract_or_null("v", r"^[^;]+"), [("A; B",), (";x",), (None,)]) == ["A", None, None]


def test_truncate_width_40(spark):
    s = "X" * 45
    out = one(spark, X.truncate("v", 40), [(s,), ("short",)])
    assert out == ["X" * 37 + "...", "short"]


def test_int_text(spark):
    assert one(spark, X.int_text("v"), [(100.0,), (12.5,), (None,)], "v double") == ["100", "12.5", None]


def test_paste_na(spark):
    df = spark.createDataFrame([("12", None), (None, "MAIN")], "a string, b string")
    assert [r[0] for r in df.select(X.paste_na("a", "b")).collect()] == ["12 NA", "NA MAIN"]


def test_to_double_lenient(spark):
    rows = [(" 12 ",), ("12-34",), ("1e3",), ("12d",), ("-0.5",), ("inf",), (None,), ("NaN",)]
    out = one(spark, X.to_double("v"), rows)
    assert out[:5] == [12.0, None, 1000.0, None, -0.5]
    assert out[5] == float("inf") and out[6] is None and out[7] is None


def test_row_min_max_skip_null(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, None)], "a double, b double, c double")
    r = df.select(X.row_min("a", "b", "c"), X.row_max("a", "b", "c")).collect()
    assert tuple(r[0]) == (1.0, 3.0) and tuple(r[1]) == (None, None)


def test_not_in_keeps_null(spark):
    assert one(spark, X.not_in_keep_null("v", ["2", "3"]), [("2",), (None,), ("1",)]) == [False, True, True]


def test_plain_digits(spark):
    assert one(spark, X.plain_digits("v"), [(1000120007.0,), (None,)], "v double") == ["1000120007", None]


def test_bbl_key_rules(spark):
    df = spark.createDataFrame([(1, 123, 5), (1, None, 5), (3, 123456, 12345), (2, 7, 0)],
                               "b int, bl int, lt int")
    out = [r[0] for r in df.select(K.bbl_key("b", "bl", "lt")).collect()]
    assert out == ["1001230005", None, "312345612345", "2000070000"]


def test_bbl_key_staged_matches_column(spark):
    df = spark.createDataFrame([(1, 123, 5), (None, 1, 1), ("x", 1, 1)], "b string, bl int, lt int")
    a = [r[0] for r in df.select(K.bbl_key("b", "bl", "lt")).collect()]
    b = [r["k"] for r in K.with_bbl_key(df, "k", "b", "bl", "lt").collect()]
    assert a == b == ["1001230005", None, None]


def test_bbl_from_number(spark):
    out = one(spark, K.bbl_from_number("v"), [(1000120007.0,), (0.0,), (None,)], "v double")
    assert out == ["1000120007", "0000000000", None]


def test_segid_key(spark):
    out = one(spark, K.segid_key("v"), [(123,), (12345678,), (None,)], "v bigint")
    assert out == ["0000123", "12345678", None]


def test_integers_of_any_size_print_plainly(spark):
    from blockxwalk.functions.text import int_text, plain_digits
    df = spark.createDataFrame([(1e14,), (1e15,), (2e15,), (1e40,), (0.5,), (None,)], "x double")
    assert [r[0] for r in df.select(int_text("x")).collect()] == ["100000000000000", "1000000000000000", "2000000000000000", "1" + "0" * 40, "0.5", None]
    assert [r[0] for r in df.select(plain_digits("x")).collect()][1:4] == ["1000000000000000", "2000000000000000", "1" + "0" * 40]
    big = spark.createDataFrame([("9" * 45,)], "s string")
    assert big.select(plain_digits("s")).first()[0] == "9" * 45
    assert spark.range(9007199254740993, 9007199254740994).select(int_text("id")).first()[0] == "9007199254740993"
