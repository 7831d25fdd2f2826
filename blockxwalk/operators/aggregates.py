"""Group roll-ups: named counts, NULL-aware distinct counts, mode, ordered
distinct concatenation, top-1 per group, six-number summary, shares.

Scale notes
-----------
* Every per-group pick (mode, top-1) is an *aggregation* ``min(struct(...))``
  rather than ``row_number()`` over a window: the aggregate is combined
  map-side, so a key holding a third of all rows is reduced inside each map
  task before the shuffle instead of being sorted in a single task.
* Ordered distinct concatenation first de-duplicates ``(key, value)`` with
  ``min(order)`` (again combined map-side and shuffled on the *pair*, which
  spreads a hot key over many tasks); only the distinct values -- exactly what
  the output row must hold -- are collected per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import ColumnOrName, col, na_text
from ..session import materialize
from .quantiles import quantiles


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """Rows per group, count typed BIGINT."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias(name))


def n_distinct_na(c: ColumnOrName) -> Column:
    """Distinct count where NULL counts as one more value (aggregate Column)."""
    x = col(c)
    return (F.countDistinct(x) + F.coalesce(F.max(x.isNull().cast("int")), F.lit(0))).cast("bigint")


def sum0(c: ColumnOrName) -> Column:
    """Sum skipping NULLs; an all-NULL or empty group sums to 0."""
    return F.coalesce(F.sum(col(c)), F.lit(0))


def count_if0(cond: Column) -> Column:
    """Number of rows where ``cond`` is true (NULL counts as false)."""
    return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("bigint")


def _asc_nulls_last(c: Column) -> list[Column]:
    # struct ordering puts NULL first; a leading is-null flag moves it last
    return [c.isNull(), c]


def mode_by(df: DataFrame, key: str, value: str, out: str | None = None) -> DataFrame:
    """Most frequent ``value`` per ``key``; NULL is a value of its own and can win.

    Ties go to the smallest value, NULL last.  (``F.mode`` ignores NULLs.)
    """
    out = out or value
    counts = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    pick = F.min(F.struct((-F.col("_n")).alias("k0"), *[c.alias(f"k{i + 1}") for i, c in
                                                         enumerate(_asc_nulls_last(F.col(value)))]))
    return counts.groupBy(key).agg(pick["k2"].alias(out))


def top1_by(df: DataFrame, keys: str | Sequence[str], order: Sequence[tuple[str, str]],
            cols: Sequence[str] | None = None) -> DataFrame:
    """One row per group: the first row under ``order`` (``[(col, 'asc'|'desc'), ...]``).

    ``asc`` sorts NULL last.  ``desc`` requires a numeric column (it is negated).
    Remaining ties are broken by the other selected columns, so the pick is
    deterministic.  Computed as a map-side-combinable ``min(struct)``.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = [c for c in (cols or df.columns) if c not in keys]
    sort_fields = []
    for c, direction in order:
        if direction == "desc":
            sort_fields += [F.col(c).isNull(), -F.col(c)]
        else:
            sort_fields += _asc_nulls_last(F.col(c))
    payload = F.struct(*[F.col(c) for c in cols])
    st = F.struct(*[f.alias(f"_o{i}") for i, f in enumerate(sort_fields)], payload.alias("_p"))
    agg = df.groupBy(*keys).agg(F.min(st).alias("_best"))
    return agg.select(*keys, *[F.col("_best._p")[c].alias(c) for c in cols])


def _attr_is(idx: int):
    # one-argument lambda: Spark's filter() reads a 2-argument one as (x, index)
    return lambda s: s["_a"] == F.lit(idx)


def first_appearances(df: DataFrame, key: str, lists: dict[str, Sequence[str]], order: str, names: bool = True) -> DataFrame:
    """(key, list or its number ``_a``, value, place): the distinct values of each list of columns by key.

    ``place`` orders them: all values of the first column come before those of
    the second, and values of one column by the least ``order`` of their rows.
    One scan and one hash aggregate: a minimum for either side, no struct.
    """
    rows = [F.struct(F.lit(a).alias("_a"), na_text(c).alias("value"), F.lit(side).alias("_s"))
            for a, cols_ in enumerate(lists.values()) for side, c in enumerate(cols_)]
    sides = max(len(c) for c in lists.values())
    stacked = df.select(key, F.col(order).alias("_ord"), F.inline(F.array(*rows)))
    by_side = [F.min(F.when(F.col("_s") == i, F.col("_ord"))).alias(f"_o{i}") for i in range(sides)]
    first = stacked.groupBy(key, "_a", "value").agg(F.min("_s").alias("_s"), *by_side)
    place = F.struct(F.col("_s").alias("side"), F.coalesce(*[F.when(F.col("_s") == i, F.col(f"_o{i}")) for i in range(sides)]).alias("ord"))
    out = first.select(key, "_a", "value", place.alias("place"))
    if not names:
        return out
    return out.withColumn("list", F.element_at(F.array(*[F.lit(n) for n in lists]), F.col("_a") + 1)).select(key, "list", "value", "place")


def concat_distinct_many(df: DataFrame, key: str, specs: dict[str, tuple[Sequence[str], str]],
                         order: str, count_of: dict[str, str] | None = None) -> DataFrame:
    """Several "paste unique values" columns per group in one pass.

    ``specs = {out_name: ([col, ...], sep)}``.  Values are taken in order of
    first appearance, where rows are ordered by ``order`` and, for several
    source columns, all values of the first column come before those of the
    second (the order of ``c(left, right)``).  NULL prints as ``NA``.
    ``count_of = {count_name: out_name}`` adds the number of distinct values.
    """
    first = first_appearances(df, key, {n: cols_ for n, (cols_, _sep) in specs.items()}, order, names=False)
    # one collect per key holding only distinct values, sorted by (attribute, first appearance)
    allv = first.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_a", "place", "value"))).alias("_all"))
    outs = []
    for a_idx, (name, (_cols, sep)) in enumerate(specs.items()):
        arr = F.transform(F.filter("_all", _attr_is(a_idx)), lambda s: s["value"])
        outs.append(F.array_join(arr, sep).alias(name))
        for cnt_name, src in (count_of or {}).items():
            if src == name:
                outs.append(F.size(arr).cast("bigint").alias(cnt_name))
    return allv.select(key, *outs)


def concat_distinct(df: DataFrame, key: str, cols: Sequence[str], order: str, sep: str,
                    out: str) -> DataFrame:
    """Single ``paste(unique(c(cols...)), collapse=sep)`` per group."""
    return concat_distinct_many(df, key, {out: (cols, sep)}, order)


def six_number(df: DataFrame, c: str, prefix: str = "") -> DataFrame:
    """min, 1st quartile, median, mean, 3rd quartile, max (linear interpolation)."""
    x = F.col(c).cast("double")
    values = materialize(df.select(x.alias("x")), "six-number")
    q1, median, q3 = (F.lit(v).cast("double") for v in quantiles(values, {"x": [0.25, 0.5, 0.75]})["x"])
    s = values.agg(F.min("x").alias("lo"), F.round(F.avg("x"), 6).alias("mean"), F.max("x").alias("hi"))
    return s.select(F.col("lo").alias(f"{prefix}min"), q1.alias(f"{prefix}q1"), median.alias(f"{prefix}median"),
                    F.col("mean").alias(f"{prefix}mean"), q3.alias(f"{prefix}q3"), F.col("hi").alias(f"{prefix}max"))


def share(df: DataFrame, n: str, out: str = "pct", digits: int = 1) -> DataFrame:
    """``n`` as a percentage of the column total, rounded half-up to ``digits``.

    Exact integer arithmetic, so no floating-point rounding ties.  Meant for
    count tables with one row per category; the total is a window over them.
    """
    scale = 10 ** digits
    tmp = df.withColumn("_total", F.sum(F.col(n)).over(Window.partitionBy()).cast("bigint"))
    q = F.expr(f"(bigint(`{n}`) * {200 * scale} + _total) div (_total * 2)")
    return tmp.withColumn(out, q.cast("double") / F.lit(float(scale))).drop("_total")


def combine_rows(*one_row_dfs: DataFrame) -> DataFrame:
    """Put several single-row aggregates side by side (union + max, no join)."""
    cols = [c for d in one_row_dfs for c in d.columns]
    u = one_row_dfs[0]
    for d in one_row_dfs[1:]:
        u = u.unionByName(d, allowMissingColumns=True)
    return u.agg(*[F.max(c).alias(c) for c in cols])
