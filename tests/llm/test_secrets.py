"""Secret scans against a plain Python version."""

import hashlib
import math
import random
import re
import time
from collections import Counter

import duckdb
import pytest

from blockxwalk.llm import secrets
from blockxwalk.llm.queries import op1_secrets

BASE = [("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
        ("access", r"AKIA[A-Z0-9]+"), ("hex", r"[0-9a-f]+")]


def plain(text):
    """All spans as (start, k, kind, end)."""
    out = []
    for m in re.finditer(BASE[0][1], text, re.A):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(BASE[1][1], text) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(BASE[2][1], text) if len(m[0]) >= 32]
    for k, (kind, chars, _, w, bits, needs) in enumerate(secrets.CLASSES):
        f = [round(1e6 * c * math.log2(c)) if c else 0 for c in range(w + 1)]
        most = round(1e6 * w * (math.log2(w) - bits))
        for m in re.finditer(f"[{chars}]{{{w},}}", text):
            if not all(re.search(n, m[0]) for n in needs) or any(re.search(a, m[0]) for a in secrets.ALLOW):
                continue
            merged = []
            for i in range(len(m[0]) - w + 1):
                if sum(f[c] for c in Counter(m[0][i:i + w]).values()) <= most:
                    if merged and merged[-1][1] >= i:
                        merged[-1][1] = i + w
                    else:
                        merged.append([i, i + w])
            out += [(m.start() + a, 3 + k, kind, m.start() + b) for a, b in merged]
    return sorted(out)


def digest(spans):
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in spans)


def rows_of(texts):
    rng = random.Random(5)
    alphabets = ["0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", "AKI012", "ab", "é \U0001f600"]
    for _ in range(150):
        parts = []
        for _ in range(rng.randrange(12)):
            a = rng.choice(alphabets)
            parts.append(rng.choice(["password=", "Token: ", "api_key='", "AKIA", " ", "\n", "é", "\U0001f600", "SECRET", "x"]))
            parts.append("".join(rng.choice(a) for _ in range(rng.choice([3, 8, 16, 30, 45]))))
        texts.append("".join(parts))
    return texts


FIXED = [None, "", "password=abcdefgh", "password: token", "password: token=abcdefgh12", "tOkEn='short", "AKIA" + "A" * 12, "AKIAAKIA" + "B" * 9,
         "a" * 32, "f" * 31, "\U0001f600 secret=\U0001f600 secret = 12345678", "id 123e4567-e89b-12d3-a456-426614174000 end",
         "0123456789abcdef" * 3, "x" * 50_000 + " passwd=hunter2hunter2", "deadbeefcafe0123456789abdcef9876 " * 40]


def test_all_spans(spark):
    texts = rows_of(list(FIXED))
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in secrets.scan(df).collect()}
    for i, t in enumerate(texts):
        assert got[i] == plain(t or ""), (i, t)
    assert any(s[1] > 2 for v in got.values() for s in v)


def test_empty_and_repeated(spark):
    df = spark.createDataFrame([(None, "token=abcdefgh"), (None, "token=abcdefgh")], "doc_id long, text string")
    assert [secrets_row["spans"][0]["end"] for secrets_row in secrets.scan(df).collect()] == [14, 14]
    assert secrets.scan(df.limit(0)).collect() == []


def test_allow_list_spares_base(spark):
    t = "token=0123456789abcdef0123456789abcdef"
    spans = secrets.scan(spark.createDataFrame([(1, t)], "doc_id long, text string")).collect()[0]["spans"]
    assert [s["kind"] for s in spans] == ["assign", "hex"]


def test_upper_case_hex_keys(spark):
    """Upper-case keys are found as lower-case ones are; digits or letters alone are none."""
    rng = random.Random(11)
    keys = ["".join(rng.choice("0123456789abcdef") for _ in range(n)) for n in (32, 40, 64) * 30]
    keys.append("9233a8ecf7c5b09fe5949719b6b82bc439e9329b")
    df = spark.createDataFrame([(i, f'TOKEN = " {k}`') for i, k in enumerate(keys)] + [(i + 1000, f'TOKEN = " {k.upper()}`') for i, k in enumerate(keys)] + [(5000, "4" * 9 + "1234567890" * 2 + " ABCDEFABCDEF" * 2)], "doc_id long, text string")
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in secrets.scan(df).collect()}
    for i in range(len(keys)):
        lower = [s[1:] for s in got[i] if s[0] == "entropy_hex"]
        assert lower and [s[1:] for s in got[i + 1000] if s[0] == "entropy_upper_hex"] == lower
    assert not [s for s in got[5000] if s[0] == "entropy_upper_hex"]


def test_allow_list_spares_the_rest_of_a_run(spark):
    """A key in the same run as a harmless word is found, the word by itself isn't."""
    key = "9f8Hj2Kq7LmZ3xWv5Tb1NcRy4PdG6sQe"
    runs = {f"v1/example/{key}": 11, f"test-key/{key}": 9, f"{key}xxxxxxxx": 0, f"/{key}/example/{key}": None, "123e4567-e89b-12d3-a456-426614174000": None, "0123456789abcdef" * 3: None,
            "9c3f1a7be24d8065xxxxxxxx9c3f1a7be24d8065": None, "my-example/some/long-path/of_words/2024": None}
    df = spark.createDataFrame([(i, f"é {r} end") for i, r in enumerate(runs)], "doc_id long, text string")
    got = {r["doc_id"]: [(s["start"] - 2, s["end"] - 2) for s in r["spans"] if s["kind"] == "entropy_base64"] for r in secrets.scan(df).collect()}
    for i, (r, start) in enumerate(runs.items()):
        if start is not None:  # the whole key, with the separator before it
            assert got[i] == [(max(0, start - 1), start + len(key))], (r, got[i])
    assert got[3] == [(0, 1 + len(key) + 1), (1 + len(key) + 8, len(f"/{key}/example/{key}"))]
    assert got[4] == got[5] == got[6] == got[7] == []


def test_a_long_text_of_keys_takes_linear_time(spark):
    """1 MB of hexadecimal runs in one text; spans that fill many lists."""
    rng = random.Random(3)
    runs = ["".join(rng.choice("0123456789abcdef") for _ in range(31)) for _ in range(32_000)]
    df = spark.createDataFrame([(1, " ".join(runs))], "doc_id long, text string")
    start = time.time()
    spans = [tuple(s) for s in secrets.scan(df).collect()[0]["spans"]]
    assert time.time() - start < 40  # 15 s on a free machine
    assert spans == plain(" ".join(runs)) and len(spans) > 20_000


def test_one_long_run_of_many_spans(spark):
    rng = random.Random(4)
    t = "".join("".join(rng.choice("0123456789abcdef") for _ in range(20)) + "a" * 25 for _ in range(3000))
    got = secrets.scan(spark.createDataFrame([(1, t)], "doc_id long, text string")).collect()[0]["spans"]
    assert [tuple(s) for s in got] == plain(t) and len(got) > 1000


def test_the_sql_knows_upper_case_keys_and_parts_of_runs(spark, tmp_path):
    key = "9f8Hj2Kq7LmZ3xWv5Tb1NcRy4PdG6sQe"
    texts = [f"v1/example/{key} and {key}xxxxxxxx", "TOKEN = \" 9233A8ECF7C5B09FE5949719B6B82BC439E9329B`", f"/{key}/example/{key}", "0123456789abcdef" * 3, "9c3f1a7be24d8065xxxxxxxx9c3f1a7be24d8065", None, "é " + key]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(secrets.scan_sql()).fetchall()
    assert sorted(want) == sorted(map(tuple, op1_secrets(spark, str(tmp_path)).collect())) and sum("entropy_upper_hex" in r[-1] for r in want) == 1


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query(spark, sf):
    rows = op1_secrets(spark, f"/root/testdata/{sf}").collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        spans = plain(texts[r["doc_id"]] or "")
        base = [s for s in spans if s[1] < 3]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[1] == k for s in base) for k in range(3)]
        assert r["base_sha256"] == hashlib.sha256(digest(base).encode()).hexdigest()
        assert r["spans"] == digest(spans)
