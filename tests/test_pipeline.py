"""Pipeline invariants on the smallest driver tables, plus an oracle spot check."""
import duckdb
import pytest
from pyspark.sql import functions as F

from blockxwalk.plans import match as M
from blockxwalk.plans.pipeline import BlockCrosswalk
from blockxwalk.plans.registry import crosswalk
from blockxwalk.sources.fixtures import Inputs

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def xw(spark):
    return crosswalk(spark, SF_SMALL)


def test_waves_are_disjoint_and_cover_all_keys(xw):
    c = xw.cascade
    seen = set()
    for name, m in c.matches.items():
        keys = {r.bbl_chr for r in m.select("bbl_chr").distinct().collect()}
        assert not (keys & seen), name
        seen |= keys
    rem = {r.bbl_chr for r in c.final_remaining.collect()}
    allk = {r.bbl_chr for r in M.all_bbls(xw.parcels_keyed).collect()}
    assert (allk - rem) <= seen and not (rem & seen)
    assert allk == (allk & seen) | rem


def test_wave_qa_counts_consistent(xw):
    qa = sorted(xw.wave_qa.collect(), key=lambda r: r.wave_no)
    total = xw.parcels_keyed.select("bbl_chr").distinct().count()
    assert [r.wave for r in qa] == [M.W1, M.W2A, M.W2B, M.W3, M.W4]
    assert all(a.remaining >= b.remaining for a, b in zip(qa, qa[1:]))
    assert qa[-1].remaining <= total


def test_billing_wave_optional(spark):
    i = Inputs(spark, SF_SMALL)
    x = BlockCrosswalk(i.segments, i.parcels, i.pad_addr, None, i.overrides)
    assert M.W2B not in x.cascade.matches
    assert x.wave_qa.count() == 4


def test_master_one_row_per_block(xw):
    m = xw.master
    assert m.count() == m.select("physical_id").distinct().count() == xw.physical_blocks.count()


def test_overrides_win(xw):
    names = xw.block_names
    manual = names.filter(F.col("name_source") == "manual")
    assert manual.count() > 0
    assert manual.filter(F.col("block_name").startswith("SURVEYED BLOCK")).count() == manual.count()


def test_review_reasons(xw):
    reasons = {r.review_reason for r in xw.review.select("review_reason").distinct().collect()}
    assert reasons <= {"no_addresses", "large_address_span", "single_address", "other"}


def test_no_python_udfs_in_core_plans(xw):
    for df in (xw.master, xw.bbl_to_physical, xw.master_full, xw.nearest):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PythonUDF" not in plan and "EvalPython" not in plan


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    from blockxwalk.plans import oracle, registry
    assert set(registry.queries()) == set(oracle.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", ["physical_blocks", "names_merged", "block_id_summary", "wave1", "wave2a",
                                  "wave3", "wave4", "match_rate", "master_full", "unmatched", "map_layer"])
def test_oracle_spot_check(spark, name):
    import __spark_entry__ as E
    from tools.oracle_check import TABLES, digest
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows) == digest(dcols, drows)


def test_write_all_outputs(spark, xw, tmp_dir):
    from blockxwalk.sources.sinks import OUTPUTS, write_all, write_map_layer
    paths = write_all(xw, tmp_dir)
    assert set(paths) == set(OUTPUTS) | {"physical_blocks", "physical_block_parts"}
    assert spark.read.parquet(paths["master_block_list_full"]).count() == xw.master_full.count()
    parts = spark.read.parquet(paths["physical_block_parts"])
    assert parts.count() == xw.block_parts.count() == parts.filter(F.col("wkt").startswith("MULTILINESTRING")).count() > 0
    write_map_layer(xw.map_layer("nypd"), tmp_dir + "/map")
    assert spark.read.text(tmp_dir + "/map").count() == xw.map_layer("nypd").count()


def test_filters_pushed_and_columns_pruned(spark, xw):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")  # untruncated scan metadata
    q = xw.city_streets.select("segment_id", "physical_id")
    plan = q._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PushedFilters: [" in plan and "EqualTo(status,2)" in plan and "EqualTo(segment_typ,U)" in plan
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    read = scan.split("ReadSchema: ")[1]
    assert "street" not in read and "geom" not in read      # only the needed columns are read


def test_house_numbers_are_parsed_once(xw):
    plan = xw.street_ranges._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") <= 4 and plan.count("RLIKE") <= 4


def test_master_reads_the_segments_three_times_at_most(xw, spark):
    from blockxwalk.plans import registry
    x = registry._FromFolder(Inputs(spark, SF_SMALL))
    plan = x.master._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") <= 4  # segments three times, overrides once


def test_inputs_and_waves_only_as_asked(spark, monkeypatch):
    from blockxwalk.plans import registry
    from blockxwalk.sources import fixtures
    monkeypatch.setattr(fixtures, "_WRITTEN", {})
    x = registry._FromFolder(Inputs(spark, SF_SMALL))
    registry.QUERIES["zip_pairs"](x)
    assert {k[2] for k in fixtures._WRITTEN} == {"segments"}
    registry.QUERIES["wave1"](x)
    assert list(x.cascade._built) == [M.W1]


def test_other_attribute_types(spark):
    from blockxwalk.plans import blocks as B
    rows = [(1, 10, "A ST", "B4", None, 31, 5.0), (1, 11, "B ST", "B4", 7, 32, None), (1, 12, "A ST", None, 7, 32, 2.0)]
    df = spark.createDataFrame(rows, "physical_id bigint, segment_id bigint, street string, l_boro string, l_cd bigint, lct2020 int, shape_length double")
    r = B.physical_blocks(df).first()
    assert (r.n_segments, r.total_length_ft, r.streets, r.boro, r.cd, r.ct2020) == (3, 7.0, "A ST; B ST", "B4", 7, 32)


def test_parcels_of_another_crs_are_aligned(spark):
    from blockxwalk.functions.geometry import srid_of, to_srid
    i = Inputs(spark, SF_SMALL)
    x = BlockCrosswalk(i.segments, to_srid(i.parcels, 4326), i.pad_addr)
    assert srid_of(x.parcels) == 2263


def test_no_cluster_is_an_error(spark):
    from blockxwalk.operators.graph import zip_cluster
    lonely = spark.createDataFrame([("10001", ["10002"], 1)], "zip1 string, neighbors array<string>, degree bigint")
    with pytest.raises(ValueError):
        zip_cluster(lonely, 4, 1, check=True)


def test_later_waves_need_the_keys_of_wave_3_only(spark):
    """Wave 4 and the unmatched keys are the same whether the pairs of wave 3 are built before or not at all."""
    i = Inputs(spark, SF_SMALL)
    a, b = (BlockCrosswalk(i.segments, i.parcels, i.pad_addr, i.pad_bill, i.overrides) for _ in range(2))
    rows = lambda df: sorted(map(str, df.collect()))
    late = rows(a.wave(M.W4)), rows(a.unmatched)
    assert M.W3 not in a.cascade._built
    whole = rows(b.wave(M.W3))
    assert (rows(b.wave(M.W4)), rows(b.unmatched)) == late and rows(a.wave(M.W3)) == whole and M.W3 not in b.cascade._matched


def test_address_summary_without_the_list(spark):
    """Counts of the address list, from a count by BBL: no address meets a block."""
    from blockxwalk.plans import derived as D
    pad = spark.createDataFrame([(1, 1, 1, "5", None, "A ST", 7, "10001"), (1, 1, 1, "5", None, "A ST", 7, "10001"), (1, 1, 1, None, "6", None, 8, "10001"),
                                 (1, 2, 1, "5", None, "B ST", 0, None), (1, 3, 1, "9", None, "C ST", 1, None), (1, None, 1, "9", None, "C ST", 1, None)],
                                "boro int, block int, lot int, lhnd string, hhnd string, stname string, bin int, zipcode string")
    b2p = spark.createDataFrame([("1000010001", 10, "x"), ("1000010001", 10, "y"), ("1000010001", None, "x"), ("1000020001", 10, "x"), (None, 11, "x")], "bbl_chr string, physical_id int, source string")
    got = D.address_summary(pad, b2p)
    rows = D.address_list(pad, b2p)
    assert [tuple(r) for r in got.collect()] == [(rows.count(), rows.select("physical_id").distinct().count())] == [(5, 2)]
    assert "n_addr_bbl" in got._jdf.queryExecution().optimizedPlan().toString()


def test_pairs_of_wave_3_are_not_written(spark):
    """The crosswalk's counts come from wave 3's plan: its pairs are no table, and are grouped where they are found."""
    from blockxwalk.session import written_tables
    i = Inputs(spark, SF_SMALL)
    x = BlockCrosswalk(i.segments, i.parcels, i.pad_addr, i.pad_bill, i.overrides)
    before = set(written_tables(spark))
    qa = {r.wave: r.pairs_added for r in x.wave_qa.collect()}
    assert qa[M.W3] == x.wave(M.W3).count() > 0
    n = x.bbl_summary.first()
    assert n.bbl_physical_pairs == x.bbl_segment_physical.select("bbl_chr", "physical_id").distinct().count() == x.master_full.agg({"n_bbls": "sum"}).first()[0]
    assert not [t for t in set(written_tables(spark)) - before if M.W3 in t and "keys" not in t]


def test_one_nearest_join_serves_waves_3_and_4(spark):
    """The keys of wave 3 and wave 4 come from one join: it is written once, and wave 4 is as by a join of its own."""
    from blockxwalk.session import written_tables
    i = Inputs(spark, SF_SMALL)
    x = BlockCrosswalk(i.segments, i.parcels, i.pad_addr, i.pad_bill, i.overrides)
    before = set(written_tables(spark))
    got = sorted(map(tuple, x.wave(M.W4).select(*M.MATCH_COLS).collect()), key=str)
    joins = [t for t in set(written_tables(spark)) - before if "nearest-so-far" in t]
    assert len(joins) == 1
    left = x.cascade.left_before(M.W4)
    assert got == sorted(map(tuple, M.wave4(left, x.parcels_keyed, x.line_edges).collect()), key=str) and got
    assert {r[0] for r in x.cascade.keys_of(M.W3).collect()} == {r[0] for r in M.wave3(x.cascade.left_before(M.W3), x.parcels_keyed, x.line_edges).select("bbl_chr").collect()}
