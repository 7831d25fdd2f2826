"""Parcel (BBL) -> block matching in five waves.

1. ``W1_PAD``: address-directory rows give (BBL, segment id) directly.
2. ``W2_APPBBL``: a parcel's application BBL inherits the wave-1 segments of
   that base BBL (joins the wave-1 *output*).
3. ``W2_BILLING``: billing BBL -> low BBL -> directory segment ids (the low BBL's
   matches of wave 1, which is over the whole directory).
4. ``W3_BUFFER50``: every city-street line within 50 ft of the parcel.
5. ``W4_NEAREST150``: the single nearest line, if within 150 ft.

Each wave only sees BBLs no earlier wave matched.  BBL keys can be NULL
(parcels with a missing lot); NULL is one key throughout (NULL-safe joins).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import bbl_from_number, segid_key, with_bbl_key
from ..operators.cascade import Cascade, Wave
from ..operators.joins import inner, inner_heavy, left_outer, restrict
from ..operators.spatial import Edges, nearest_within, pairs_within
from ..session import materialize

# Wave tags and radii (feet).
W1, W2A, W2B, W3, W4 = "W1_PAD", "W2_APPBBL", "W2_BILLING", "W3_BUFFER50", "W4_NEAREST150"
BUFFER_FT = 50.0
NEAREST_FT = 150.0

MATCH_COLS = ("bbl_chr", "segment_id", "physical_id")


def parcel_keys(parcels: DataFrame) -> DataFrame:
    return (with_bbl_key(parcels, "bbl_chr", "boro_code", "block", "lot")
            .withColumn("appbbl_chr", bbl_from_number("appbbl")))


def all_bbls(keyed: DataFrame) -> DataFrame:
    return keyed.select("bbl_chr").distinct()


def segment_ids(streets: DataFrame) -> DataFrame:
    """The rows of ``segment_lookup``, some more than once."""
    ids = F.explode(F.array(segid_key("segment_id"), segid_key("legacy_id"))).alias("segid_chr")
    return streets.select(ids, "segment_id", "physical_id").filter(F.col("segid_chr").isNotNull() & F.col("segment_id").isNotNull())


def segment_lookup(streets: DataFrame) -> DataFrame:
    """Any 7-character segment id (canonical or legacy) -> (segment_id, physical_id)."""
    return segment_ids(streets).distinct()


def directory_keys(pad: DataFrame) -> DataFrame:
    """The rows of ``pad_keys``, as often as the directory has them."""
    k = with_bbl_key(pad, "bbl_chr", "boro", "block", "lot").select("bbl_chr", segid_key("segid").alias("segid_chr"))
    return k.filter(F.col("bbl_chr").isNotNull() & F.col("segid_chr").isNotNull())


def pad_keys(pad: DataFrame) -> DataFrame:
    """Distinct (bbl_chr, segid_chr) with a segment id: a directory repeats them for every address."""
    return directory_keys(pad).distinct()


def wave1(keys: DataFrame, lookup: DataFrame) -> DataFrame:
    """Matches of the directory's keys; a default segment id may hold a large part of them.

    Rows of ``keys`` and ``lookup`` may be repeated: they are made distinct where they meet.
    """
    return inner_heavy(keys, lookup, "segid_chr", null_safe=False, distinct=True).select(*MATCH_COLS).distinct()


def wave2a(rem: DataFrame, keyed: DataFrame, w1: DataFrame) -> DataFrame:
    app = keyed.filter(F.col("appbbl_chr").isNotNull()).select("bbl_chr", "appbbl_chr")
    j = inner(rem, app, "bbl_chr")  # NULL BBL matches NULL BBL here
    base = w1.select(F.col("bbl_chr").alias("base_bbl"), "segment_id", "physical_id")
    return inner(j, base, {"appbbl_chr": "base_bbl"}).select(*MATCH_COLS).distinct()


def billing_keys(bill: DataFrame) -> DataFrame:
    b = with_bbl_key(bill, "billbbl", "billboro", "billblock", "billlot")
    b = with_bbl_key(b, "lobbl", "loboro", "loblock", "lolot")
    return b.select("billbbl", "lobbl").filter(F.col("billbbl").isNotNull() & F.col("lobbl").isNotNull()).distinct()


def wave2b(rem: DataFrame, bill: DataFrame, w1: DataFrame) -> DataFrame:
    """The directory's matches of the low BBL: wave 1 has them for every BBL of the directory, so it isn't joined again."""
    j = inner(rem, billing_keys(bill), {"bbl_chr": "billbbl"}).select("bbl_chr", "lobbl")
    low = w1.select(F.col("bbl_chr").alias("lobbl"), "segment_id", "physical_id")
    return inner_heavy(low, j, "lobbl", null_safe=False).select(*MATCH_COLS).distinct()


def remaining_parcels(parcels_keyed: DataFrame, rem: DataFrame) -> DataFrame:
    return restrict(parcels_keyed, rem, "bbl_chr").select("bbl_chr", "geom")


def wave3(rem: DataFrame, parcels_keyed: DataFrame, lines: DataFrame | Edges, radius: float = BUFFER_FT,
          cell: float | None = None, salt: int = 1, write: bool = True, of: tuple[str, ...] = MATCH_COLS[1:], values: DataFrame | None = None,
          each: DataFrame | None = None) -> DataFrame:
    """(bbl_chr, columns ``of`` of the lines), distinct.  With ``values`` (a row a ``bbl_chr``) each pair carries its
    BBL's, NULL without any: they come with the parcels, so that the pairs need no join.  With ``each`` (any rows
    with a ``bbl_chr``) it is the pairs joined with the distinct rows: these go where a BBL's pairs are found."""
    polys, cols = remaining_parcels(parcels_keyed, rem), ["bbl_chr"]
    if values is not None:
        polys, cols = left_outer(polys, values, "bbl_chr", null_safe=False), values.columns
    if each is not None:
        return pairs_within(polys, lines, radius, cell, cols, salt=salt, write=write, of=of, each=each)
    return pairs_within(polys, lines, radius, cell, cols, salt=salt, write=write, of=of).select(*cols, *of)


def wave4_pairs(rem: DataFrame, parcels_keyed: DataFrame, lines: DataFrame | Edges, radius: float = NEAREST_FT,
                cell: float | None = None, salt: int = 1, write: bool = True) -> DataFrame:
    """Nearest line per remaining parcel row; one row per (BBL, segment, block)
    with the smallest distance among parcel rows sharing that triple."""
    polys = remaining_parcels(parcels_keyed, rem)
    near = nearest_within(polys, lines, radius, cell, salt=salt, write=write)
    return near.groupBy(*MATCH_COLS).agg(F.min("dist_ft").alias("dist_ft"))


class Nearest:
    """One nearest join for two waves: of the keys that wave 3 sees, the nearest lines within the larger of both radii.

    The keys of ``wave3`` are those with one within its radius, found without its pairs.  A parcel's nearest line
    doesn't depend on other parcels, so of the keys that are left then the same rows are ``wave4``'s.
    """

    def __init__(self, parcels_keyed: DataFrame, lines: Callable[[], Edges], buffer_ft: float = BUFFER_FT, nearest_ft: float = NEAREST_FT,
                 cell: float | None = None, salt: int = 1, write: bool = True):
        self.parcels_keyed, self.lines, self.buffer_ft, self.nearest_ft = parcels_keyed, lines, buffer_ft, nearest_ft
        self.cell, self.salt, self.write = cell, salt, write
        self._rows: DataFrame | None = None

    def wave3_keys(self, rem: DataFrame) -> DataFrame:
        near = wave4_pairs(rem, self.parcels_keyed, self.lines(), max(self.buffer_ft, self.nearest_ft), self.cell, self.salt, self.write)
        self._rows = materialize(near, "nearest-lines") if self.write else near
        return self._rows.where(F.col("dist_ft") <= self.buffer_ft).select("bbl_chr").distinct()

    def wave4(self, rem: DataFrame) -> DataFrame:
        """``rem``: what the keys of ``wave3_keys``, if it was asked, have left of its own."""
        if self._rows is None:
            return wave4(rem, self.parcels_keyed, self.lines(), self.nearest_ft, self.cell, self.salt, self.write)
        return restrict(self._rows.where(F.col("dist_ft") <= self.nearest_ft), rem, "bbl_chr").select(*MATCH_COLS)


def wave4(rem: DataFrame, parcels_keyed: DataFrame, lines: DataFrame | Edges, radius: float = NEAREST_FT,
          cell: float | None = None, salt: int = 1, write: bool = True) -> DataFrame:
    return wave4_pairs(rem, parcels_keyed, lines, radius, cell, salt, write).select(*MATCH_COLS)


def run_cascade(parcels_keyed: DataFrame, pad: DataFrame, bill: DataFrame | None, lookup: DataFrame,
                lines: Callable[[], Edges], *, buffer_ft: float = BUFFER_FT, nearest_ft: float = NEAREST_FT,
                cell: float | None = None, materialize: bool = True, salt: int = 1) -> Cascade:
    near = Nearest(parcels_keyed, lines, buffer_ft, nearest_ft, cell, salt, materialize)
    waves = [
        Wave(W1, lambda rem, done: wave1(directory_keys(pad), lookup)),
        Wave(W2A, lambda rem, done: wave2a(rem, parcels_keyed, done[W1])),
    ]
    if bill is not None:  # optional input: the billing wave is skipped without it
        waves.append(Wave(W2B, lambda rem, done: wave2b(rem, bill, done[W1])))
    waves += [
        Wave(W3, lambda rem, done: wave3(rem, parcels_keyed, lines(), buffer_ft, cell, salt, materialize),
             near.wave3_keys),
        Wave(W4, lambda rem, done: near.wave4(rem)),
    ]
    return Cascade(all_bbls(parcels_keyed), waves, "bbl_chr", MATCH_COLS, "source", materialize)
