"""URL filters: host/path rules, and a character language-model ratio for the rest.

Two smoothed variable-order Markov models, one of accepted and one of rejected
URLs, give each byte a probability that interpolates the orders 0 to ``ORDER``:
p_k(c | ctx) = (n(ctx c) + mu p_{k-1}(c)) / (n(ctx) + mu).  A URL's score is the
mean log-likelihood difference by byte; the threshold is calibrated on a fold
that the counts leave out.  Accepted and rejected URLs are those that a rule
decides.  Counts are exact, a row for each gram of ``ORDER`` + 1 symbols, and grow
with the input: the shorter grams' counts are sums of the longer ones', the
probabilities follow by order from joins, and a URL's score is a sum over its
grams.  Distinct URLs are scored once; grams and URLs that many rows share are
joined by broadcast, the others by shuffles.  Log ratios are held in whole
billionths, so that the order of rows doesn't matter.

Defined results: a null URL or one without ``://`` has empty host and path; an
empty URL scores 0; without URLs of both classes every score is 0 and the
threshold 0, which allows; a repeated row gives a repeated result; an empty
table an empty one; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, column, materialize
from .neardup import _table, attach

ORDER, MU = 5, 4.0
#: Bits of a symbol (a byte, or START before a URL); six of them fill 54 bits of a gram's number, the last symbol lowest.
BITS, START = 9, 256
#: One URL in so many is left to the calibration; bins of its histogram of scores.
FOLDS, BINS, SPAN = 5, 2000, 10.0
MAX_RULES = 5000


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty if it is null or has no ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest fitting rule as struct(rule, verdict), else null.

    A rule is (``host/path prefix``, verdict); it fits its host, that host's
    subdomains, and paths that start with its own.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    parts = [(r, *r.partition("/")[::2], v) for r, v in rules]
    table = F.array(*[F.struct(F.lit(len(r)).alias("n"), F.lit(r).alias("rule"), F.lit(v).alias("verdict"), F.lit(h.lower()).alias("h"), F.lit("." + h.lower()).alias("dot_h"), F.lit("/" + p).alias("p")) for r, h, p, v in parts])
    fits = F.filter(table, lambda r: ((host == r["h"]) | host.endswith(r["dot_h"])) & path.startswith(r["p"]))
    best = F.array_max(fits)
    return F.when(best.isNotNull(), F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict")))


def _grams(urls: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The URL and the gram's number of each byte of the URLs, in a row."""
    raw = [(u or "").encode("utf-8", "replace") for u in urls]
    sizes = np.array([len(x) for x in raw], np.int64)
    owner = np.repeat(np.arange(len(raw)), sizes)
    text = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
    place = np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    grams = text.copy()
    for k in range(1, ORDER + 1):  # one more byte of context
        back = np.full(len(text), START, np.int64)
        back[k:] = np.where(place[k:] >= k, text[:-k], START)
        grams |= back << (BITS * k)
    return owner, grams


def _sums(rows: DataFrame) -> DataFrame:
    """(g, acc, rej, m): by gram the sums of the columns acc, rej and m of its occurrences, of rows (u, acc, rej, m)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in chunks(b):
                owner, grams = _grams(part.column(0).to_pylist())
                found, at = np.unique(grams, return_inverse=True)
                own = [part.column(c).to_numpy(zero_copy_only=False)[owner] for c in (1, 2, 3)]
                yield pa.RecordBatch.from_arrays([pa.array(found), *(pa.array(np.bincount(at, x, len(found)).astype(np.int64)) for x in own)], ["g", "acc", "rej", "m"])

    found = rows.select("u", *(F.col(c).cast("long") for c in ("acc", "rej", "m"))).mapInArrow(count, "g long, acc long, rej long, m long")
    return found.groupBy("g").agg(*(F.sum(c).alias(c) for c in ("acc", "rej", "m")))


def _entries(urls: DataFrame) -> DataFrame:
    """(uid, g, n): the grams of each URL and how often it has them, of rows (uid, u)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in chunks(b):
                owner, grams = _grams(part.column(1).to_pylist())
                order = np.lexsort((grams, owner))
                owner, grams = owner[order], grams[order]
                first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (grams[1:] != grams[:-1])])) if len(grams) else np.zeros(0, int)
                uid = part.column(0).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array(uid[owner[first]]), pa.array(grams[first]), pa.array(np.diff(first, append=len(grams)))], ["uid", "g", "n"])

    return urls.select("uid", "u").mapInArrow(run, "uid long, g long, n long")


def _suffix(k: int) -> Column:
    """The gram of order k that a longer gram g ends with."""
    return F.col("g").bitwiseAND(F.lit((1 << BITS * (k + 1)) - 1).cast("long"))


def _ratios(tables: DataFrame, wanted: DataFrame) -> DataFrame:
    """(g, v, m) of the wanted grams (g, m): the log-likelihood difference of the last byte in billionths."""
    both = tables.select("g", "acc", "rej", F.lit(0).cast("long").alias("m")).unionByName(wanted.select("g", F.lit(0).cast("long").alias("acc"), F.lit(0).cast("long").alias("rej"), "m"))
    totals = [F.sum(c).alias(c) for c in ("acc", "rej", "m")]
    levels = [_table(both.groupBy("g").agg(*totals), f"grams-{ORDER}")]
    for k in reversed(range(ORDER)):
        levels.insert(0, _table(levels[0].select(_suffix(k).alias("g"), "acc", "rej", "m").groupBy("g").agg(*totals), f"grams-{k}"))
    found = None
    for k, level in enumerate(levels):
        context = Window.partitionBy(F.shiftright("g", BITS))  # at most 256 grams
        rows = level.select("*", F.sum("acc").over(context).alias("in_acc"), F.sum("rej").over(context).alias("in_rej")).where("m > 0")
        if found is None:
            rows = rows.select("*", F.lit(1 / 256).alias("pa"), F.lit(1 / 256).alias("pr"))
        else:
            rows = rows.withColumn("s", _suffix(k - 1)).join(found.select(F.col("g").alias("s"), "pa", "pr"), "s")
        found = rows.select("g", "m", *[((F.col(n) + MU * F.col(p)) / (F.col(f"in_{n}") + MU)).alias(p) for n, p in (("acc", "pa"), ("rej", "pr"))])
    return found.select("g", "m", F.round((F.log("pa") - F.log("pr")) * 1e9).cast("long").alias("v"))


def _scores(urls: list[str | None], tables: DataFrame) -> np.ndarray:
    """Mean log-likelihood differences of a few URLs."""
    rows = tables.sparkSession.createDataFrame(list(enumerate(urls)), "i long, u string")
    return np.array([r["lm_score"] for r in sorted(score(rows, {"tables": tables}, "u", ["i"]).collect())])


def _tables(rows: DataFrame) -> DataFrame | None:
    """(g, acc, rej): how often accepted and rejected URLs have a gram, of all rows (u, a); None without URLs of both classes."""
    a = F.col("a").cast("int")
    tables = _table(_sums(rows.select("u", a.alias("acc"), (1 - a).alias("rej"), F.lit(0).alias("m"))).drop("m"), "counts")
    sums = tables.agg(F.sum("acc").alias("acc"), F.sum("rej").alias("rej")).first()
    return tables if sums["acc"] and sums["rej"] else None


def _threshold(held: DataFrame) -> float:
    """The score that separates the held-out rows (a, lm_score) best, from a histogram by class."""
    held = held.select("a", F.least(F.greatest(F.floor((F.col("lm_score") + SPAN / 2) / SPAN * BINS), F.lit(0)), F.lit(BINS - 1)).cast("int").alias("bin"))
    bins = np.zeros((2, BINS))
    for r in held.groupBy("a", "bin").count().collect():
        bins[0 if r["a"] else 1, r["bin"]] += r["count"]
    if not (bins[0].any() and bins[1].any()):
        return 0.0
    lost = np.concatenate([[0], np.cumsum(bins[0])]) / bins[0].sum()  # accepted URLs below each bin's edge
    let = 1 - np.concatenate([[0], np.cumsum(bins[1])]) / bins[1].sum()  # rejected ones from it on
    wrong = lost + let
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    edge = best[len(best) // 2]  # the middle of the edges that are as good
    return float(edge / BINS * SPAN - SPAN / 2)


def _fold(url: Column) -> Column:
    """The fold of a URL (null without one); fold 0 is held out."""
    return F.when(url.isNotNull(), F.pmod(F.xxhash64(url), F.lit(FOLDS)).cast("int"))


def fit(labelled: DataFrame, url_col: str = "url", accepted_col: str = "accepted") -> dict:
    """The model of labelled URLs (accepted: boolean; null: not used): exact counts over all rows, and the threshold."""
    rows = labelled.select(column(url_col).alias("u"), column(accepted_col).cast("boolean").alias("a")).where("a is not null and u is not null")
    rows = rows.withColumn("f", _fold(F.col("u")))
    tables = _tables(rows.where("f > 0"))
    if tables is None:
        return {"tables": None, "threshold": 0.0}
    return {"tables": tables, "threshold": _threshold(score(rows.where("f = 0"), {"tables": tables}, "u", ["a"]))}


def score(df: DataFrame, model: dict, url_col: str = "url", keep: list[str] = ()) -> DataFrame:
    """The columns ``keep`` and lm_score (double) of every row."""
    url = F.coalesce(column(url_col).cast("string"), F.lit(""))
    rows = df.select(*[column(c).alias(f"k{i}") for i, c in enumerate(keep)], url.alias("u"))
    names = [F.col(f"k{i}").alias(c) for i, c in enumerate(keep)]
    if model["tables"] is None:
        return rows.select(*names, F.lit(0.0).alias("lm_score"))
    urls = materialize(rows.groupBy("u").agg(F.count("*").alias("copies")).withColumn("uid", F.monotonically_increasing_id()), "urls")
    wanted = _sums(urls.select("u", F.lit(0).alias("acc"), F.lit(0).alias("rej"), F.lit(1).alias("m"))).select("g", "m")
    entries = attach(_entries(urls), _table(_ratios(model["tables"], wanted), "ratios"), "g", "m")
    sums = entries.groupBy("uid").agg(F.sum(F.col("n") * F.col("v")).alias("total"), F.sum("n").alias("n"))
    found = urls.join(sums, "uid", "left").select("u", "copies", F.coalesce(F.col("total") / F.col("n") / 1e9, F.lit(0.0)).alias("lm_score"))
    return attach(rows, _table(found, "url-scores"), "u", "copies").select(*names, "lm_score")


def judge(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, lm_score) of every row: a rule's verdict, else the models'."""
    url = column(url_col).cast("string")
    host, path = host_path(url)
    rows = pages.select(column(id_col).alias("id"), url.alias("u"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("r", matching_rule(F.col("host"), F.col("path"), rules))
    rows = rows.select("id", "u", "host", "path", F.col("r.rule").alias("rule"), F.col("r.verdict").alias("v"), _fold(F.col("u")).alias("f"))
    accepted = (F.col("v") == "allow").alias("a")
    tables = _tables(rows.where("v is not null and f > 0").select("u", accepted))
    out, threshold = score(rows, {"tables": tables}, "u", ["id", "host", "path", "rule", "v", "f"]), 0.0
    if tables is not None:  # all rows are scored once; those of the fold that the counts leave out give the threshold
        out = materialize(out, "scored-urls")
        threshold = _threshold(out.where("v is not null and f = 0").select(accepted, "lm_score"))
    return out.select(
        F.col("id").alias(id_col), "host", "path", "rule",
        F.coalesce("v", F.when(F.col("lm_score") >= threshold, "allow").otherwise("block")).alias("verdict"), "lm_score")
