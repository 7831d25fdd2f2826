"""Equi-joins with the key semantics of data-frame joins: NULL matches NULL.

``eqNullSafe`` keys still plan as hash / sort-merge joins (Catalyst rewrites
``a <=> b`` into a coalesce+isnull key pair).  No join here hints a broadcast:
Catalyst broadcasts a side only when its estimated size is under
``spark.sql.autoBroadcastJoinThreshold`` and AQE re-checks with the measured
shuffle size, which is exactly the "broadcast behind a size check" rule.

Key arguments are either a name shared by both sides, a list of such names, or
a ``{left_name: right_name}`` mapping.  As with data-frame joins, the output
keeps the left key column and drops the right one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KeySpec = str | Sequence[str] | Mapping[str, str]


def _pairs(on: KeySpec) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    if isinstance(on, Mapping):
        return list(on.items())
    return [(k, k) for k in on]


def join_keys(left: DataFrame, right: DataFrame, on: KeySpec, how: str = "inner",
              null_safe: bool = True) -> DataFrame:
    """Join on key pairs; right key columns are dropped from the output."""
    pairs = _pairs(on)
    r = right
    tmp = []
    for i, (_lk, rk) in enumerate(pairs):
        t = f"__rk{i}"
        r = r.withColumnRenamed(rk, t)
        tmp.append(t)
    cond = None
    for (lk, _rk), t in zip(pairs, tmp):
        lc, rc = F.col(f"__l.`{lk}`"), F.col(f"__r.`{t}`")
        c = lc.eqNullSafe(rc) if null_safe else (lc == rc)
        cond = c if cond is None else cond & c
    # aliases keep the condition unambiguous when both sides share lineage
    out = left.alias("__l").join(r.alias("__r"), cond, how)
    if how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
        return out
    return out.drop(*tmp)


def inner(left: DataFrame, right: DataFrame, on: KeySpec, null_safe: bool = True) -> DataFrame:
    return join_keys(left, right, on, "inner", null_safe)


#: A key is heavy if it has more than this part of a side's rows, and this many.
HEAVY_SHARE, HEAVY_ROWS = 1 / 200, 100_000
#: Keys are first counted by so many buckets of their hash: those of a bucket without too many rows aren't heavy.
BUCKETS = 4096
#: The columns of ``spread``: a row's salt, and how many its key has.
SALT, SALTS = "__salt", "__salts"


def heavy_keys(df: DataFrame, keys: Sequence[str], share: float | None = None, least: int | None = None) -> list[tuple]:
    """(key.., rows) of the keys with more than a share of all rows: fewer than 1 / share of them.  NULL is a key.

    Only keys in a bucket with too many rows are shuffled to be counted.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))
    by_bucket = [tuple(r) for r in df.groupBy(bucket.alias("_b")).agg(F.count(F.lit(1))).collect()]
    bound = max(HEAVY_ROWS if least is None else least, sum(n for _, n in by_bucket) * (HEAVY_SHARE if share is None else share))
    full = [b for b, n in by_bucket if n > bound]
    if not full:
        return []
    counts = df.where(bucket.isin(full)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))  # combined map-side: a heavy key is a row a task
    return [tuple(r) for r in counts.where(F.col("_n") > bound).collect()]


def _salts(df: DataFrame, keys: Sequence[str], hot: list[tuple]) -> DataFrame:
    """(__h0.., __salts): at least as many salts as make a key's part as small as the largest key that isn't heavy."""
    fewest = min(h[-1] for h in hot)
    fields = [T.StructField(f"__h{i}", df.schema[k].dataType) for i, k in enumerate(keys)]
    salts = df.sparkSession.createDataFrame([(*h[:-1], 8 * -(-h[-1] // fewest)) for h in hot], T.StructType([*fields, T.StructField(SALTS, T.IntegerType())]))
    return F.broadcast(salts)  # fewer than 1 / share rows


def _dealt(df: DataFrame, keys: Sequence[str], salts: DataFrame) -> DataFrame:
    own = left_outer(df, salts, {k: f"__h{i}" for i, k in enumerate(keys)})
    return own.withColumn(SALT, F.when(F.col(SALTS).isNotNull(), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.col(SALTS)).cast("int")).otherwise(0))


def spread(df: DataFrame, keys: Sequence[str], share: float | None = None, least: int | None = None) -> DataFrame:
    """The rows with ``__salt`` and ``__salts``, by which a heavy key's rows are dealt; others have 0 of 1.  Equal rows have the same."""
    hot = heavy_keys(df, keys, share, least)
    if not hot:
        return df.select("*", F.lit(0).alias(SALT), F.lit(1).alias(SALTS))
    return _dealt(df, keys, _salts(df, keys, hot)).withColumn(SALTS, F.coalesce(SALTS, F.lit(1)))


def carried(df: DataFrame, keys: Sequence[str], size: int = 1_000) -> DataFrame:
    """(*keys, _chunk, _some): the other columns of the distinct rows, whose keys aren't NULL, in arrays of ``size`` structs at most.

    Numbers of chunks differ within a key, from 0; some may be left out.
    """
    rest = [c for c in df.columns if c not in keys]
    own = spread(df.dropna(subset=list(keys)), keys)
    # one shuffle serves the distinct rows and the arrays
    own = own.repartition(*keys, SALT).distinct().groupBy(*keys, SALT, SALTS).agg(F.collect_list(F.struct(*rest)).alias("_all"))
    parts = F.transform(F.sequence(F.lit(1), F.size("_all"), F.lit(size)), lambda i: F.slice("_all", i, F.lit(size)))
    own = own.select(*keys, SALT, SALTS, F.posexplode(parts).alias("_at", "_some"))
    return own.select(*keys, (F.col("_at").cast("bigint") * F.col(SALTS) + F.col(SALT)).alias("_chunk"), "_some")


def inner_heavy(left: DataFrame, right: DataFrame, on: KeySpec, null_safe: bool = True, share: float | None = None, least: int | None = None,
                distinct: bool = False) -> DataFrame:
    """``inner`` in which a key with a large part of the left rows is dealt over many tasks.

    One aggregate finds the left side's heavy keys.  Their rows are split over
    salts by a hash of the row (rows that are equal in all columns stay together), in
    proportion to the key's rows; the right rows of these keys are replicated to the
    salts.  Without heavy keys it is the plain join.

    With ``distinct`` rows of a side that are equal count once.  They are made so behind the join's own shuffle.
    """
    pairs = _pairs(on)
    hot = heavy_keys(left, [lk for lk, _ in pairs], share, least)
    if not null_safe:
        hot = [h for h in hot if all(v is not None for v in h[:-1])]
    once = lambda df, keys: df.repartition(*keys).distinct() if distinct else df
    if not hot:
        return inner(once(left, [lk for lk, _ in pairs]), once(right, [rk for _, rk in pairs]), on, null_safe)
    salts = _salts(left, [lk for lk, _ in pairs], hot)
    own = _dealt(left, [lk for lk, _ in pairs], salts).drop(SALTS)
    other = left_outer(right, salts, {rk: f"__h{i}" for i, (_, rk) in enumerate(pairs)})
    other = other.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.coalesce(SALTS, F.lit(1)) - 1))).drop(SALTS)
    own, other = once(own, [*[lk for lk, _ in pairs], SALT]), once(other, [*[rk for _, rk in pairs], SALT])
    return join_keys(own, other, {**dict(pairs), SALT: SALT}, "inner", null_safe).drop(SALT)


def left_outer(left: DataFrame, right: DataFrame, on: KeySpec, null_safe: bool = True) -> DataFrame:
    return join_keys(left, right, on, "left", null_safe)


def remaining(keys: DataFrame, matched: DataFrame, on: KeySpec) -> DataFrame:
    """Rows of ``keys`` whose key has no match in ``matched`` (NULL-safe anti join)."""
    return join_keys(keys, matched, on, "left_anti", True)


def restrict(df: DataFrame, keys: DataFrame, on: KeySpec) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys`` (NULL-safe semi join)."""
    return join_keys(df, keys, on, "left_semi", True)


def merge_overrides(df: DataFrame, overrides: DataFrame, key: str, pairs: Mapping[str, str],
                    extra: Sequence[str] = ()) -> DataFrame:
    """Left-join manual values and let them win: ``col = coalesce(manual, col)``.

    ``pairs = {target_col: override_col}``.  Repeated override keys multiply
    rows, as a left join does.
    """
    sel = overrides.select(key, *pairs.values(), *extra)
    j = left_outer(df, sel, key)
    for target, manual in pairs.items():
        j = j.withColumn(target, F.coalesce(F.col(manual), F.col(target)))
    return j
