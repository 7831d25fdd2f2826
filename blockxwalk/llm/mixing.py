"""Mixing sources to target weights by Poisson replication.

A source's target repetition rate is its weight's share of the total volume over
its own volume (characters, and one for each row).  Each document draws its
number of copies from a Poisson distribution of that mean by inverting the
distribution function at a uniform number hashed from seed, id and text; it is
exploded by that count, and all copies are shuffled into a global random order:
dealt by a hash of (seed, id, text, copy) and sorted by it in each task.

A mean above ``PART`` is drawn as a sum of equal parts, each from a hash of its
own, so that no probability underflows.

Defined results: a null source is a source of its own; null text counts as
empty; equal (id, text) rows draw equal counts; sources without a given weight
have weight 0, given weights of absent sources don't count; without any weight
above 0 nothing is returned; an empty table gives an empty one; other columns are
kept as they are (one named like the copy column gives way to it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, materialize, normal_text

PART = 500.0
#: Rates of at most so many sources are broadcast; of more, they are joined by salted keys.
BROADCAST_SOURCES, SALTS = 20_000, 32


def uniform(seed: int, *parts: Column) -> Column:
    """52 hashed bits as a double in [0, 1)."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None, alpha: float = 0.5, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(source, volume, rate, parts, cdf): by source; default weights are volume ** alpha."""
    volume = docs.select(column(source_col).cast("string").alias("source"), (F.length(normal_text(text_col)) + 1).cast("long").alias("v")).groupBy("source").agg(F.sum("v").alias("volume"))
    if weights is None:
        volume = volume.withColumn("w", F.pow(F.col("volume").cast("double"), F.lit(float(alpha))))
    else:
        given = docs.sparkSession.createDataFrame([(k, float(w)) for k, w in weights.items()] or [(None, 0.0)], "s string, w double")
        volume = volume.join(given, F.col("source").eqNullSafe(F.col("s")), "left").select("source", "volume", F.coalesce("w", F.lit(0.0)).alias("w"))
    volume = materialize(volume, "mix-volumes")
    total = volume.agg(F.sum("volume").alias("t"), F.sum("w").alias("w")).first()  # one row
    rate = F.lit(float(total["t"] or 0)) * F.col("w") / F.lit(float(total["w"])) / F.col("volume") if total["w"] else F.lit(0.0)
    out = volume.select("source", "volume", rate.alias("rate"))
    out = out.withColumn("parts", F.greatest(F.ceil(F.col("rate") / PART), F.lit(1)).cast("int"))
    return out.withColumn("cdf", _cdf(F.col("rate") / F.col("parts")))


def _cdf(mean: Column) -> Column:
    """array<double>: the Poisson distribution function from 0 on, until the rest is below 2 ** -60."""
    terms = F.ceil(mean + 12 * F.sqrt(mean) + 30).cast("int")
    first = F.exp(-mean)
    start = F.struct(first.alias("p"), first.alias("c"), F.array(first).alias("all"))

    def step(s: Column, k: Column) -> Column:
        p = s["p"] * mean / k
        return F.struct(p.alias("p"), (s["c"] + p).alias("c"), F.concat(s["all"], F.array(s["c"] + p)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), terms), start, step, lambda s: s["all"])


def copies(seed: int, id_col: Column, text: Column) -> Column:
    """The number of copies, of columns ``parts`` and ``cdf``."""
    own = [F.coalesce(id_col.cast("string"), F.lit("")), F.md5(text)]
    draw = lambda j: F.size(F.filter("cdf", lambda c: c <= uniform(seed, *own, j.cast("string"))))
    return F.when(F.col("parts") == 1, _invert(uniform(seed, *own, F.lit("1")))).otherwise(
        F.aggregate(F.sequence(F.lit(1), F.col("parts")), F.lit(0), lambda n, j: n + draw(j)))


def _invert(u: Column) -> Column:
    """The least k whose distribution function is above u."""
    found = F.transform(F.array(u), lambda x: F.size(F.filter("cdf", lambda c: c <= x)))
    return found[0]


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, alpha: float = 0.5, seed: int = 1, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", copy_col: str = "copy") -> DataFrame:
    """The documents' columns and the copy's number (from 1), in a global random order."""
    names = [c for c in docs.columns if c != copy_col]
    found = materialize(rates(docs, weights, alpha, source_col, text_col).select("source", "parts", "cdf"), "mix-rates")
    rows = docs.select(F.struct(*[column(c) for c in names]).alias("d"), column(id_col).alias("i"), normal_text(text_col).alias("t"), column(source_col).cast("string").alias("s"))
    same = F.col("s").eqNullSafe(F.col("source"))
    if found.count() <= BROADCAST_SOURCES:
        rows = rows.join(F.broadcast(found), same)
    else:  # a source that holds many rows is dealt over the salts
        salted = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("own_salt", F.pmod(F.xxhash64("i", "t"), F.lit(SALTS)).cast("int"))
        rows = rows.join(salted, same & (F.col("own_salt") == F.col("salt")))
    rows = rows.select("d", "i", F.xxhash64("t").alias("h"), copies(seed, F.col("i"), F.col("t")).alias("n")).where("n > 0")
    rows = rows.select("d", "i", "h", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    rows = rows.select("d", "copy", F.xxhash64(F.lit(seed), "i", "h", "copy").alias("key"))
    rows = rows.repartition("key").sortWithinPartitions("key")
    return rows.select(*[F.col("d")[c].alias(c) for c in names], F.col("copy").cast("long").alias(copy_col))


#: DuckDB: the rows of ``mix`` with default weights and seed 1 (columns of ``documents`` and copy).
MIX_SQL = """
WITH RECURSIVE volume AS (
  SELECT source, sum(length(coalesce(text, '')) + 1) AS volume FROM documents GROUP BY source
), weight AS (
  SELECT source, volume, pow(volume::DOUBLE, 0.5) AS w FROM volume
), rate AS (
  SELECT source, (SELECT sum(volume) FROM weight)::DOUBLE * w / (SELECT sum(w) FROM weight) / volume AS rate FROM weight
), part AS (
  SELECT source, greatest(ceil(rate / 500.0), 1)::INT AS parts, rate / greatest(ceil(rate / 500.0), 1) AS mean FROM rate
), cdf(source, mean, k, p, c) AS (
  SELECT source, mean, 0, exp(-mean), exp(-mean) FROM part
  UNION ALL
  SELECT source, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM cdf WHERE k < ceil(mean + 12 * sqrt(mean) + 30)
), steps AS (
  SELECT source, list(c ORDER BY k) AS cs FROM cdf GROUP BY source
), draw AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, s.cs,
    ('0x' || substr(md5('1:' || coalesce(d.doc_id::VARCHAR, '') || ':' || md5(coalesce(d.text, '')) || ':' || j::VARCHAR), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u
  FROM documents d JOIN part p ON d.source IS NOT DISTINCT FROM p.source JOIN steps s ON d.source IS NOT DISTINCT FROM s.source, range(1, p.parts + 1) AS r(j)
), counted AS (
  SELECT doc_id, text, lang, source, n_chars, sum(len(list_filter(cs, lambda c: c <= u)))::BIGINT AS n FROM draw GROUP BY ALL
)
SELECT doc_id, text, lang, source, n_chars, copy FROM counted, range(1, n + 1) AS r(copy)
"""
