"""URL rules against plain string handling; the models against plain counts."""

import math
import random
from collections import Counter, defaultdict

import numpy as np

from blockxwalk.llm import urls
from blockxwalk.llm.queries import URL_RULES, op7_urls


def plain(url):
    url = url or ""
    if "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    at = min([i for i in (rest.find(c) for c in "/?#") if i >= 0] or [len(rest)])
    host, rest = rest[:at], rest[at:]
    end = min([i for i in (rest.find(c) for c in "?#") if i >= 0] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule, verdict in URL_RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and rest[:end].startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = rule, verdict
    return host, rest[:end], best


ODD = [None, "", "http://", "no scheme", "x://EXAMPLE.org/es/a", "https://a.example.org/en/12", "https://a.example.org/en/2", "http://org", "http://org/", "http://xorg/",
       "http://a.com/de/?q=/fr/", "http://a.com/fr/#x", "http://a.com?u=http://b.org/", "http://É.ORG/é", "a://b://c.org/", "http://a.org/\nx", "http://x.com/fr", "http://x.com/" + "z" * 20_000]


def test_host_path_rule(spark):
    df = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(ODD)] + [(0, None, "h", "v")], "page_id long, url string, host string, verdict string")
    got = urls.judge(df, URL_RULES).collect()
    assert len(got) == len(ODD) + 1
    for r in got:
        host, path, rule = plain(ODD[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule[0])
        assert r["verdict"] == rule[1] if rule else r["verdict"] in ("allow", "block")
    assert urls.judge(df.limit(0), URL_RULES).collect() == []
    assert {r["verdict"] for r in urls.judge(df, []).collect()} == {"allow"}


def rows(n, seed):
    rng = random.Random(seed)
    word = lambda bits: "".join(rng.choice(bits) for _ in range(rng.randrange(2, 5)))
    return [(f"http://{word(['an', 'er', 'th'])}.net/{word(['news', 'doc', 'wiki'])}/{i}" if i % 2 else f"http://{word(['win', 'bet', 'xx'])}.net/{word(['spin', 'cash'])}?{i}", bool(i % 2)) for i in range(n)]


def test_the_ratio_tells_the_classes(spark):
    model = urls.fit(spark.createDataFrame(rows(3000, 1), "url string, accepted boolean"))
    test = spark.createDataFrame(rows(600, 2), "url string, accepted boolean")
    got = urls.score(test, model, "url", ["accepted"]).collect()
    assert np.mean([(r["lm_score"] >= model["threshold"]) == r["accepted"] for r in got]) > 0.97


def test_counts_and_scores(spark):
    """Counts by order from plain dictionaries give the same probabilities (no collisions among so few grams)."""
    train = rows(60, 3)
    model = urls.fit(spark.createDataFrame(train + train[:5], "url string, accepted boolean"))
    fold = {r["url"] for r in spark.createDataFrame(train, "url string, accepted boolean").selectExpr("url", f"pmod(xxhash64(url), {urls.FOLDS}) f").where("f = 0").collect()}
    used = [t for t in train + train[:5] if t[0] not in fold]
    counts = {a: defaultdict(Counter) for a in (True, False)}
    for u, a in used:
        for i, c in enumerate(u):
            for k in range(urls.ORDER + 1):
                counts[a][tuple(u[max(0, i - k):i].rjust(k, "^"))][c] += 1
    total = 0.0
    u = "http://anth.net/news/1"
    for i, c in enumerate(u):
        p = {True: 1 / 256, False: 1 / 256}
        for a in p:
            for k in range(urls.ORDER + 1):
                seen = counts[a][tuple(u[max(0, i - k):i].rjust(k, "^"))]
                p[a] = (seen[c] + urls.MU * p[a]) / (sum(seen.values()) + urls.MU)
        total += math.log(p[True]) - math.log(p[False])
    assert abs(urls._scores([u], model["tables"])[0] - total / len(u)) < 0.02
    assert urls._scores(["", None], model["tables"]).tolist() == [0.0, 0.0]


def test_counts_grow_with_the_input(spark):
    """Half a million grams are counted apart from each other: scores equal plain counts'."""
    rng = random.Random(7)
    train = [("x://" + "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(44)), bool(i % 2)) for i in range(14_000)]
    df = spark.createDataFrame(train, "url string, accepted boolean")
    model = urls.fit(df)
    used = df.where(f"pmod(xxhash64(url), {urls.FOLDS}) > 0").collect()
    counts = {a: [Counter() for _ in range(urls.ORDER + 2)] for a in (True, False)}  # by length of the gram
    for u, a in used:
        t = "^" * urls.ORDER + u
        for i in range(urls.ORDER, len(t)):
            for n in range(urls.ORDER + 2):
                counts[a][n][t[i + 1 - n:i + 1] if n else ""] += 1
    contexts = {a: Counter() for a in counts}
    for a in counts:
        for own in counts[a][1:]:
            for gram, n in own.items():
                contexts[a][gram[:-1]] += n
    assert len(counts[True][urls.ORDER + 1]) + len(counts[False][urls.ORDER + 1]) > 400_000
    some = [used[0][0], used[1][0], "x://" + "ab1" * 14, "y://new.org/"]
    expected = []
    for u in some:
        t, total = "^" * urls.ORDER + u, 0.0
        for i in range(urls.ORDER, len(t)):
            for a, sign in ((True, 1), (False, -1)):
                p = 1 / 256
                for n in range(1, urls.ORDER + 2):
                    gram = t[i + 1 - n:i + 1]
                    p = (counts[a][n][gram] + urls.MU * p) / (contexts[a][gram[:-1]] + urls.MU)
                total += sign * math.log(p)
        expected.append(total / len(u))
    assert np.allclose(urls._scores(some, model["tables"]), expected, rtol=0, atol=1e-6)


def test_query(spark):
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    got = op7_urls(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(pages)
    for r in got:
        host, path, rule = plain(pages[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule[0]) and (not rule or r["verdict"] == rule[1])
