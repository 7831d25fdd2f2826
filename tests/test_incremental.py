"""Matching after a change equals matching from scratch; finished and untouched waves aren't written again."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from blockxwalk.plans import match as M
from blockxwalk.plans.incremental import IncrementalMatch, content_digest
from blockxwalk.plans.pipeline import BlockCrosswalk
from blockxwalk.sources.fixtures import Inputs

SF = "/root/testdata/sf0.001"


def _rows(matches):
    return {w: sorted(map(tuple, m.collect()), key=str) for w, m in matches.items()}


def _written(state):
    return {d: os.stat(os.path.join(state, d, "_SUCCESS")).st_mtime_ns for d in os.listdir(state) if not d.startswith("last")}


def test_digest_is_of_the_content(spark):
    a = spark.createDataFrame([(1, None, [[1]]), (2, "x", [[1], []])], "a int, b string, c array<array<int>>")
    same = a.repartition(3).orderBy(F.desc("a"))
    assert content_digest(a) == content_digest(same)
    assert len({content_digest(d) for d in (a, a.unionByName(a), a.limit(1), a.withColumn("b", F.lit("x")), a.withColumn("c", F.array(F.flatten("c"))), a.limit(0))}) == 6


@pytest.fixture(scope="module")
def first(spark, tmp_path_factory):
    """The matches of a first run, and its state."""
    i, state = Inputs(spark, SF), str(tmp_path_factory.mktemp("state"))
    run = IncrementalMatch(BlockCrosswalk(i.segments, i.parcels, i.pad_addr, i.pad_bill), state)
    before = _rows(run.matches())
    assert set(run.done.values()) == {"whole"}
    return i, before, state


def test_finished_waves_are_read(spark, first):
    i, before, state = first
    assert before == _rows(BlockCrosswalk(i.segments, i.parcels, i.pad_addr, i.pad_bill).cascade.matches)
    files = _written(state)
    again = IncrementalMatch(BlockCrosswalk(i.segments, i.parcels, i.pad_addr, i.pad_bill), state)
    assert _rows(again.matches()) == before and set(again.done.values()) == {"kept"} and _written(state) == files


@pytest.mark.parametrize("change", ["parcels", "lines"])
def test_a_change_touches_its_keys_only(spark, tmp_path, first, change):
    i, before, state = first
    state = shutil.copytree(state, str(tmp_path / "state"))
    files = _written(state)
    segments, parcels = i.segments, i.parcels
    move = lambda df, test: df.withColumn("geom", F.when(test, F.transform("geom", lambda p: F.transform(p, lambda v: F.struct((v["x"] + 700).alias("x"), (v["y"] - 300).alias("y"))))).otherwise(F.col("geom")))
    if change == "parcels":
        parcels = move(parcels, (F.col("block") % 6 == 1) & (F.col("lot") % 10 == 9)).where("lot is null or not (block = 3 and lot = 30)")
    else:
        segments = move(segments.where("segment_id % 149 != 0"), F.col("segment_id") % 151 == 0)
    x = BlockCrosswalk(segments, parcels, i.pad_addr, i.pad_bill)
    later = IncrementalMatch(x, state)
    got = _rows(later.matches())
    assert got == _rows(BlockCrosswalk(segments, parcels, i.pad_addr, i.pad_bill).cascade.matches)
    assert later.done[M.W3] == later.done[M.W4] == "changed keys"
    assert got[M.W3] != before[M.W3] or got[M.W4] != before[M.W4]
    if change == "parcels":
        assert later.done[M.W1] == "kept"
    assert all(_written(state)[d] == t for d, t in files.items())
    # few keys went through the distance join
    same = [d for d in os.listdir(state) if d.startswith(M.W3) and d.endswith("-same")]
    keys = [d for d in _written(state).keys() - files.keys() if d.startswith(M.W3) and d.endswith("-keys")]
    assert len(same) == len(keys) == 1
    assert spark.read.parquet(f"{state}/{same[0]}").count() > 0.6 * spark.read.parquet(f"{state}/{keys[0]}").count()
