"""Crosswalks derived from the BBL matches: BBL/segment/block, BIN, addresses,
per-block counts on the master table, and the unmatched-parcel report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import with_bbl_key
from ..functions.text import paste_na
from ..operators.aggregates import combine_rows, count_by, count_if0, n_distinct_na, share, six_number
from ..operators.quantiles import quantiles
from ..operators.ordering import sort_desc
from ..operators.joins import inner, inner_heavy, join_keys, left_outer, restrict
from ..session import materialize

KEY = "physical_id"


def bbl_summary(b2p: DataFrame, matched_keys: DataFrame, unmatched_keys: DataFrame) -> DataFrame:
    """``matched_keys``: the distinct BBLs of ``b2p``."""
    blocks = b2p.groupBy(KEY).agg(F.count(F.lit(1)).alias("_n"))  # combined map-side
    s = blocks.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("bbl_physical_pairs"), F.count(F.lit(1)).cast("bigint").alias("physical_ids_with_bbls"))
    m = matched_keys.agg(F.count(F.lit(1)).cast("bigint").alias("bbls_matched"))
    u = unmatched_keys.agg(F.count(F.lit(1)).cast("bigint").alias("bbls_unmatched"))
    return combine_rows(s, m, u).select("bbl_physical_pairs", "bbls_matched", "physical_ids_with_bbls", "bbls_unmatched")


def match_rate(b2p: DataFrame) -> DataFrame:
    return share(count_by(b2p, "source", name="n_pairs"), "n_pairs", "pct", 1)


def bins(pad: DataFrame) -> DataFrame:
    """The rows of ``bin_to_bbl``, as often as the directory has them."""
    return (with_bbl_key(pad, "bbl_chr", "boro", "block", "lot").select("bin", "bbl_chr")
            .filter(F.col("bin").isNotNull() & (F.col("bin") != 0) & F.col("bbl_chr").isNotNull()))


def bin_to_bbl(pad: DataFrame) -> DataFrame:
    return bins(pad).distinct()


def bin_to_physical(pad: DataFrame, b2p: DataFrame) -> DataFrame:
    """(BIN, BBL, block): both sides are distinct, so their join is too."""
    return inner(bin_to_bbl(pad), block_bbl_pairs(b2p), "bbl_chr", null_safe=False).select("bin", "bbl_chr", KEY)


def counted_blocks(counted: DataFrame) -> DataFrame:
    """physical_id, n_bbls, n_bins, n_addresses of (bbl_chr, physical_id) pairs, distinct, that carry ``counts_per_bbl``: no join."""
    return counted.groupBy(KEY).agg(F.count(F.lit(1)).cast("bigint").alias("n_bbls"), F.sum("n_bins_bbl").cast("bigint").alias("n_bins"), F.sum("n_addr_bbl").cast("bigint").alias("n_addresses"))


def bin_summary(pad: DataFrame, per_block: DataFrame, matched_keys: DataFrame) -> DataFrame:
    """Pairs, distinct BINs and blocks with BINs of ``bin_to_physical`` --
    computed from the counts per block, without expanding the many-to-many join."""
    s = per_block.agg(F.coalesce(F.sum("n_bins"), F.lit(0)).cast("bigint").alias("bin_physical_pairs"),
                      F.count(F.when(F.col("n_bins").isNotNull(), F.col(KEY))).cast("bigint").alias("physical_ids_with_bins"))
    bins = join_keys(bin_to_bbl(pad), matched_keys, "bbl_chr", "left_semi", null_safe=False)
    return combine_rows(s, bins.agg(n_distinct_na("bin").alias("distinct_bins"))) \
        .select("bin_physical_pairs", "distinct_bins", "physical_ids_with_bins")


def addresses(pad: DataFrame) -> DataFrame:
    """The rows of ``bbl_addresses``, as often as the directory has them."""
    a = with_bbl_key(pad, "bbl_chr", "boro", "block", "lot").select("bbl_chr", "bin",
                   F.coalesce("lhnd", "hhnd").alias("house_num"), F.col("stname").alias("street_name"),
                   "boro", F.col("zipcode").alias("zip"))
    a = a.withColumn("address", paste_na("house_num", "street_name")).filter(F.col("bbl_chr").isNotNull())
    return a.select("bbl_chr", "address", "bin", "boro", "zip")


def bbl_addresses(pad: DataFrame) -> DataFrame:
    """Distinct directory addresses per BBL: house number (low, else high) + street."""
    return addresses(pad).distinct()


def match_inputs(parcels_keyed: DataFrame, lookup: DataFrame) -> DataFrame:
    """How many distinct parcel keys and segment lookup rows the matching starts from."""
    return combine_rows(parcels_keyed.agg(n_distinct_na("bbl_chr").alias("total_bbls")),
                        lookup.agg(F.count(F.lit(1)).cast("bigint").alias("lookup_rows")))


def address_summary(pad: DataFrame, b2p: DataFrame) -> DataFrame:
    """Addresses in all and blocks that have any: the rows of ``address_list``, counted by BBL without expanding them."""
    linked = inner(block_bbl_pairs(b2p), addresses_per_bbl(pad), "bbl_chr", null_safe=False)
    return linked.agg(F.coalesce(F.sum("n_addr_bbl"), F.lit(0)).cast("bigint").alias("total_addresses"), n_distinct_na(KEY).alias("blocks_with_addresses"))


def address_list(pad: DataFrame, b2p: DataFrame) -> DataFrame:
    """Every directory address with its block(s)."""
    j = inner_heavy(bbl_addresses(pad), block_bbl_pairs(b2p), "bbl_chr", null_safe=False)
    return j.select(KEY, "address", "bin", "bbl_chr", "boro", "zip")


def block_bbl_pairs(b2p: DataFrame) -> DataFrame:
    return b2p.select("bbl_chr", KEY).distinct()


def addresses_per_bbl(pad: DataFrame) -> DataFrame:
    return count_by(bbl_addresses(pad), "bbl_chr", name="n_addr_bbl")


def addr_per_block(per_block: DataFrame) -> DataFrame:
    """Rows of ``address_list`` per block.

    Each row carries its BBL, so rows of different BBLs never coincide: a block's number is
    the sum of the distinct counts of its BBLs.  A BBL holding a third of all rows is
    reduced to one count row before it meets the pairs."""
    return per_block.where(F.col("n_addresses").isNotNull()).select(KEY, "n_addresses")


def addr_per_block_summary(per_block: DataFrame) -> DataFrame:
    return six_number(per_block, "n_addresses")


def counts_per_bbl(pad: DataFrame) -> DataFrame:
    """bbl_chr, n_bins_bbl, n_addr_bbl in one pass over the directory (NULL where a BBL has no BIN).

    Rows are first made distinct in all that the counts look at, so that a BBL with a
    third of all rows is spread over many tasks, as are its values.
    """
    a = bbl_addresses(pad)
    bins = F.when(F.col("bin") != 0, F.col("bin"))
    n = a.groupBy("bbl_chr").agg(F.countDistinct(bins).cast("bigint").alias("n_bins_bbl"), F.count(F.lit(1)).cast("bigint").alias("n_addr_bbl"))
    return n.withColumn("n_bins_bbl", F.when(F.col("n_bins_bbl") > 0, F.col("n_bins_bbl")))


def counts_per_block(pad: DataFrame, b2p: DataFrame) -> DataFrame:
    """physical_id, n_bbls, n_bins, n_addresses: one pass over the pairs and one over the directory."""
    pairs = b2p.groupBy("bbl_chr", KEY).agg(F.count(F.lit(1)).alias("_n"))
    j = join_keys(pairs, counts_per_bbl(pad), "bbl_chr", "left", null_safe=False)
    return j.groupBy(KEY).agg(F.sum("_n").cast("bigint").alias("n_bbls"), F.sum("n_bins_bbl").cast("bigint").alias("n_bins"), F.sum("n_addr_bbl").cast("bigint").alias("n_addresses"))


def master_full(master: DataFrame, per_block: DataFrame) -> DataFrame:
    """Master table plus BBL / BIN / address counts (NULL where a block has none)."""
    return left_outer(master, per_block, KEY)


def master_full_summary(mf: DataFrame) -> DataFrame:
    counts = materialize(mf.select("n_bbls", "n_bins", "n_addresses"), "block-counts")
    medians = quantiles(counts, {"n_bbls": [0.5], "n_bins": [0.5], "n_addresses": [0.5]})
    found = counts.agg(F.count(F.lit(1)).cast("bigint").alias("total_blocks"),
                  count_if0(F.col("n_bbls") > 0).alias("blocks_with_bbls"),
                  count_if0(F.col("n_bins") > 0).alias("blocks_with_bins"),
                  count_if0(F.col("n_addresses") > 0).alias("blocks_with_addresses"))
    return found.select("*", *[F.lit(medians[c][0]).cast("double").alias(n) for c, n in (("n_bbls", "median_bbls"), ("n_bins", "median_bins"), ("n_addresses", "median_addresses"))])


UNMATCHED_COLS = ("bbl_chr", "boro_code", "block", "lot", "address", "land_use", "owner_type", "owner_name")


def unmatched(parcels_keyed: DataFrame, final_remaining: DataFrame) -> DataFrame:
    return restrict(parcels_keyed, final_remaining, "bbl_chr").select(*UNMATCHED_COLS)


def unmatched_by_land_use(u: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` land uses among unmatched parcels (ties by land use)."""
    return sort_desc(count_by(u, "land_use", name="n"), "n", "land_use").limit(n)
