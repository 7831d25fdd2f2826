"""Block stage: physical-block roll-up, names with overrides, review flags,
id summaries and the master block table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import clean_parts
from ..functions.text import (extract_or_null, feet_to_miles, int_text, is_finite, na_text,
                              to_double, trim_ws, truncate)
from ..operators.aggregates import concat_distinct_many, count_by, count_if0, first_appearances, n_distinct_na, sum0, top1_by
from ..operators.chunks import chunked
from ..operators.joins import left_outer, merge_overrides
from ..operators.noding import noded
from ..operators.ordering import sample_n, sort_desc

KEY = "physical_id"

# Name sources, review thresholds and the review labels.
SOURCE_AUTO = "auto"
SOURCE_NO_ADDR = "auto_no_addr"
SOURCE_MANUAL = "manual"
NO_ADDR_PREFIX = "[No addr] "
NO_ADDR_PATTERN = r"^\[No addr\]"
NAME_WIDTH = 40
LARGE_SPAN = 500
REASON_NO_ADDR = "no_addresses"
REASON_LARGE_SPAN = "large_address_span"
REASON_SINGLE = "single_address"
REASON_OTHER = "other"


def dissolve_parts(streets: DataFrame) -> DataFrame:
    """Long form of the block geometry: one row per distinct line part of a block.

    This is the scalable shape of the dissolve (no per-block collection)."""
    parts = streets.select(KEY, F.explode(clean_parts("geom")).alias("part"))
    return parts.distinct()


def dissolve(streets: DataFrame) -> DataFrame:
    """physical_id, geom: the distinct parts of all segments of a block, sorted.

    Parts are collected after de-duplication only; they are not noded or
    merged end to end (lengths come from the segment attribute)."""
    return dissolve_parts(streets).groupBy(KEY).agg(F.array_sort(F.collect_list("part")).alias("geom"))


def block_lines(streets: DataFrame) -> DataFrame:
    """physical_id, x1, y1, x2, y2: each block's segments cut at crossings and overlaps, every piece once."""
    return noded(streets, (KEY,))


def physical_blocks(streets: DataFrame, order: str = "segment_id", with_geom: bool = False) -> DataFrame:
    """One row per physical block.

    n_segments, total_length_ft (NULL lengths skipped), ``streets`` (distinct
    street names in order of first segment, "; "-joined, NULL printed NA),
    and the modal left-side borough, community district and census tract
    (NULL can be the mode; ties go to the smallest value).

    One pass, two shuffles: each segment becomes four (attribute, value) rows,
    pre-aggregated on the pair (count, first segment, length) -- spreading a
    hot block over many tasks -- then rolled up once per block with
    conditional aggregates.  No joins, so a NULL block id is simply a group.
    """
    # one value slot for each attribute, of the attribute's own type
    slots = {"street": "street", "boro": "l_boro", "cd": "l_cd", "ct2020": "lct2020"}

    def row(a, own):
        return F.struct(F.lit(a).alias("a"), *[
            (F.col(c) if slot == own else F.lit(None).cast(streets.schema[c].dataType)).alias(f"v_{slot}") for slot, c in slots.items()])

    stacked = streets.select(KEY, order, "shape_length", F.inline(F.array(*[row(a, slot) for a, slot in enumerate(slots)])))
    pairs = stacked.groupBy(KEY, "a", *[f"v_{x}" for x in slots]).agg(
        F.count(F.lit(1)).alias("n"), F.min(order).alias("first"), F.sum("shape_length").alias("len"))
    is_a = lambda i: F.col("a") == i

    def mode(i, slot):
        return F.min(F.when(is_a(i), F.struct((-F.col("n")).alias("k0"), F.col(f"v_{slot}").isNull().alias("k1"),
                                              F.col(f"v_{slot}").alias("v"))))["v"].alias(slot)

    out = pairs.groupBy(KEY).agg(
        F.sum(F.when(is_a(0), F.col("n"))).cast("bigint").alias("n_segments"),
        F.coalesce(F.sum(F.when(is_a(0), F.col("len"))), F.lit(0.0)).cast("double").alias("total_length_ft"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(is_a(0), F.struct("first", na_text("v_street").alias("s"))))),
                                 lambda x: x["s"]), "; ").alias("streets"),
        mode(1, "boro"), mode(2, "cd"), mode(3, "ct2020"))
    if with_geom:
        out = left_outer(out, dissolve(streets), KEY)
    return out


def segment_addresses(streets: DataFrame) -> DataFrame:
    """Lowest / highest house number per segment over the four range ends.

    The numbers are parsed in one lambda over the four ends, and the result goes
    through a generator: a filter on it can't be pushed below and so parses nothing twice.
    """
    ends = F.array("from_left", "to_left", "from_right", "to_right")
    parse = lambda c: F.transform(F.array(trim_ws(c)), lambda t: to_double(t, trimmed=True))[0]
    found = F.transform(F.array(F.transform(ends, parse)), lambda n: F.struct(
        F.array_min(n).alias("addr_min"), F.array_max(n).alias("addr_max")))
    return streets.select(KEY, "segment_id", "street", "shape_length", F.inline(found)).select(
        KEY, "segment_id", "street", "addr_min", "addr_max", "shape_length")


def street_ranges(streets: DataFrame) -> DataFrame:
    """Address range, span, length and segment count per (block, street)."""
    s = segment_addresses(streets).filter(is_finite("addr_min") & is_finite("addr_max"))
    return (s.groupBy(KEY, "street")
            .agg(F.min("addr_min").alias("addr_low"), F.max("addr_max").alias("addr_high"),
                 sum0("shape_length").cast("double").alias("street_length"),
                 F.count(F.lit(1)).cast("bigint").alias("n_segments"))
            .withColumn("addr_span", F.col("addr_high") - F.col("addr_low")))


NAME_COLS = ("physical_id", "block_name", "primary_street", "addr_low", "addr_high", "name_source")


def names_auto(ranges: DataFrame, blocks: DataFrame, keep=()) -> DataFrame:
    """Algorithmic name per block: the longest street (then widest span, then
    street name) gives "low-high STREET"; blocks without any usable address
    get "[No addr] <first street>".  Every range's block is one of the blocks, whose
    columns ``keep`` are passed on."""
    best = top1_by(ranges, KEY, [("street_length", "desc"), ("addr_span", "desc"), ("street", "asc")],
                   cols=["street", "addr_low", "addr_high", "street_length", "addr_span"])
    j = left_outer(blocks.select(KEY, "streets", *keep), best.withColumn("named", F.lit(True)), KEY)
    named = F.coalesce("named", F.lit(False))
    primary = extract_or_null("streets", r"^[^;]+")
    return j.select(
        KEY,
        F.when(named, F.concat(int_text("addr_low"), F.lit("-"), int_text("addr_high"), F.lit(" "), na_text("street")))
        .otherwise(F.concat(F.lit(NO_ADDR_PREFIX), na_text(truncate(primary, NAME_WIDTH)))).alias("block_name"),
        F.when(named, F.col("street")).otherwise(primary).alias("primary_street"), "addr_low", "addr_high",
        F.when(named, F.lit(SOURCE_AUTO)).otherwise(F.lit(SOURCE_NO_ADDR)).alias("name_source"), *keep)


def names_merged(auto: DataFrame, overrides: DataFrame | None, keep=()) -> DataFrame:
    """Auto names with surveyed values winning wherever present."""
    if overrides is None:
        return auto.withColumn("notes", F.lit(None).cast("string"))
    j = merge_overrides(auto, overrides, KEY,
                        {"block_name": "block_name_manual", "primary_street": "primary_street_manual",
                         "addr_low": "addr_low_manual", "addr_high": "addr_high_manual"},
                        extra=("notes",))
    j = j.withColumn("name_source", F.when(F.col("block_name_manual").isNotNull(), F.lit(SOURCE_MANUAL))
                     .otherwise(F.col("name_source")))
    return j.select(*NAME_COLS, "notes", *keep)


def name_coverage(names: DataFrame) -> DataFrame:
    return names.agg(count_if0(F.col("addr_low").isNotNull()).alias("blocks_with_addresses"),
                     count_if0(F.col("addr_low").isNull()).alias("blocks_without_addresses"))


def names_by_source(names: DataFrame) -> DataFrame:
    return count_by(names, "name_source", name="n_blocks")


def name_sample(names: DataFrame, n: int = 15, seed: int = 1) -> DataFrame:
    """Reproducible sample of up to ``n`` named blocks that have addresses."""
    return sample_n(names.filter(F.col("addr_low").isNotNull()), n, KEY, seed) \
        .select(KEY, "block_name", "name_source")


def review(names: DataFrame, blocks: DataFrame) -> DataFrame:
    """Blocks needing a field check, with the first matching reason."""
    span = F.col("addr_high") - F.col("addr_low")
    has_low = F.col("addr_low").isNotNull()
    flagged = names.filter(
        (F.col("name_source") == SOURCE_NO_ADDR)
        | F.col("block_name").rlike(NO_ADDR_PATTERN)
        | ((span > LARGE_SPAN) & has_low)
        | ((span == 0) & has_low)
        | F.col("addr_low").isNull())
    j = left_outer(flagged, blocks.select(KEY, "boro", "cd", "streets"), KEY)
    reason = (F.when(F.col("addr_low").isNull(), REASON_NO_ADDR)
              .when(span > LARGE_SPAN, REASON_LARGE_SPAN)
              .when(span == 0, REASON_SINGLE)
              .otherwise(REASON_OTHER))
    return j.withColumn("review_reason", reason)


def review_counts(rev: DataFrame) -> DataFrame:
    return count_by(rev, "review_reason", name="n_blocks")


# Output column -> source columns (left values before right).
ID_LISTS = {
    "segment_ids": ["segment_id"],
    "generic_ids": ["generic_id"],
    "fdny_ids": ["fdnyid"],
    "block_face_ids": ["l_block_face_id", "r_block_face_id"],
    "census_tracts_2020": ["lct2020", "rct2020"],
    "census_blocks_2020": ["lcb2020", "rcb2020"],
}
CENSUS_LISTS = ("census_tracts_2020", "census_blocks_2020")


def block_ids(xwalk: DataFrame, lists=tuple(ID_LISTS), order: str = "segment_id") -> DataFrame:
    """Long form (physical_id, list, value, place): the distinct ids of a block, one a row, NULL printed NA.

    This is the scalable shape of the id lists (no per-block collection)."""
    return first_appearances(xwalk, KEY, {n: ID_LISTS[n] for n in lists}, order)


#: Ids to a row of the chunked id lists.
CHUNK_IDS = 1000


def block_id_chunks(ids: DataFrame, size: int = CHUNK_IDS) -> DataFrame:
    """The id lists of ``block_id_summary`` in numbered chunks (physical_id, list, chunk, n_values, text) of bounded size.

    ``ids``: the long form.  A block's chunks in order, joined, are its list."""
    return chunked(ids, (KEY, "list"), ("place", "value"), "value", size)


def block_id_summary(xwalk: DataFrame, order: str = "segment_id", lists=tuple(ID_LISTS)) -> DataFrame:
    """Per block: ';'-joined distinct ids in segment order (left values before right)."""
    counts = {"n_segments": "segment_ids"} if "segment_ids" in lists else None
    out = concat_distinct_many(xwalk, KEY, {n: (ID_LISTS[n], ";") for n in lists}, order, count_of=counts)
    return out.select(KEY, *[c for n in lists for c in ([n, "n_segments"] if n == "segment_ids" else [n])])


BLOCK_COLS = ("n_segments", "total_length_ft", "boro", "cd", "ct2020")


def master(named: DataFrame, summary: DataFrame) -> DataFrame:
    """Blocks with their names (``names_merged`` that keeps ``BLOCK_COLS``) and census lists."""
    m = named.select(KEY, *BLOCK_COLS, *[c for c in NAME_COLS if c != KEY])
    return left_outer(m, summary.select(KEY, *CENSUS_LISTS), KEY)


def master_totals(m: DataFrame) -> DataFrame:
    return m.agg(F.count(F.lit(1)).cast("bigint").alias("total_blocks"),
                 F.sum("n_segments").cast("bigint").alias("total_segments"),
                 F.round(feet_to_miles(sum0("total_length_ft")), 6).alias("total_length_miles"),
                 count_if0(F.col("addr_low").isNotNull()).alias("blocks_with_addresses"),
                 count_if0(F.col("addr_low").isNull()).alias("blocks_no_addresses"),
                 n_distinct_na("boro").alias("n_boroughs"))


def master_by_boro(m: DataFrame) -> DataFrame:
    """Blocks by borough, most first (ties by borough)."""
    return sort_desc(count_by(m, "boro", name="n_blocks"), "n_blocks", "boro")


def master_by_source(m: DataFrame) -> DataFrame:
    return count_by(m, "name_source", name="n_blocks")
