"""A key holding a third of all rows: results stay whole and exact, and the
per-group picks are aggregates (no Window operator that sorts one group in one task)."""
import random
from collections import Counter

from pyspark.sql import functions as F

from blockxwalk.operators.aggregates import concat_distinct, mode_by, top1_by
from blockxwalk.plans.blocks import physical_blocks


def _streets(spark, n=3000, seed=5):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        pid = 1 if i % 3 == 0 else rnd.randint(2, 200)          # block 1 holds a third of the rows
        rows.append((i, pid, f"ST {rnd.randint(0, 40)}", rnd.choice([1, 2, None]), rnd.randint(100, 103),
                     f"{rnd.randint(0, 5):06d}", float(rnd.randint(0, 500)) if i % 7 else None))
    return rows, spark.createDataFrame(rows, "segment_id bigint, physical_id bigint, street string, l_boro int, "
                                             "l_cd int, lct2020 string, shape_length double")


def _mode(vals):
    c = Counter(vals)
    best = max(c.values())
    cands = [v for v in c if c[v] == best]
    non_null = sorted(v for v in cands if v is not None)
    return non_null[0] if non_null else None


def test_hot_block_rollup_is_exact(spark):
    rows, df = _streets(spark)
    got = {r.physical_id: r for r in physical_blocks(df).collect()}
    hot = [r for r in rows if r[1] == 1]
    assert got[1].n_segments == len(hot) == 1000
    assert got[1].total_length_ft == sum(r[6] for r in hot if r[6] is not None)
    first = {}
    for r in sorted(hot):
        first.setdefault(r[2], r[0])
    assert got[1].streets == "; ".join(sorted(first, key=first.get))
    assert got[1].boro == _mode([r[3] for r in hot])
    assert got[1].cd == _mode([r[4] for r in hot])
    assert got[1].ct2020 == _mode([r[5] for r in hot])
    assert len(got) == len({r[1] for r in rows})


def test_hot_key_operators_plan_without_window(spark):
    _rows, df = _streets(spark)
    plans = [physical_blocks(df), mode_by(df, "physical_id", "l_boro"),
             top1_by(df, "physical_id", [("shape_length", "desc"), ("segment_id", "asc")]),
             concat_distinct(df, "physical_id", ["street"], "segment_id", ";", "s")]
    for p in plans:
        text = p._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in text
        assert p.count() == df.select("physical_id").distinct().count()
    top = {r.physical_id: r.segment_id for r in plans[2].collect()}
    hot = df.filter("physical_id = 1").orderBy(F.col("shape_length").desc_nulls_last(), "segment_id").first()
    assert top[1] == hot.segment_id
