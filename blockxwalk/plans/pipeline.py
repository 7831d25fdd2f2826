"""The whole block crosswalk as one object of lazily built DataFrames.

``BlockCrosswalk(segments, parcels, pad_addr, pad_bill, overrides)`` exposes
every intermediate and output table as an attribute.  Nothing runs until an
action; attributes are memoised so that every consumer shares one logical
sub-plan (and Spark reuses the identical exchanges when several outputs are
computed in one job).

``sources.sinks.write_all(x, out_dir)`` is the production entry: every
output is written as a table.  The cascade writes each wave to the shared
checkpoint folder, so the outputs depend on short plans over written tables
and a lost executor only re-runs the current stage.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import align_srid
from ..operators.graph import streets_in_zips, zip_cluster, zip_edges, zip_neighbors, zip_pairs
from ..operators.joins import left_outer
from ..session import materialize as write_and_read
from . import blocks as B
from . import derived as D
from . import match as M
from . import streets as S


class BlockCrosswalk:
    def __init__(self, segments: DataFrame, parcels: DataFrame, pad_addr: DataFrame,
                 pad_bill: DataFrame | None = None, overrides: DataFrame | None = None, *,
                 buffer_ft: float = M.BUFFER_FT, nearest_ft: float = M.NEAREST_FT,
                 cell: float | None = None, cluster_size: int = 4, seed: int = 1,
                 materialize: bool = True, salt: int = 1):
        # parcels in another CRS than the segments' are transformed to it
        self.segments, self.parcels, self.pad_addr = segments, align_srid(parcels, segments), pad_addr
        self.pad_bill, self.overrides = pad_bill, overrides
        self._set(buffer_ft, nearest_ft, cell, cluster_size, seed, materialize, salt)

    def _set(self, buffer_ft=M.BUFFER_FT, nearest_ft=M.NEAREST_FT, cell=None, cluster_size=4, seed=1, materialize=True, salt=1):
        self.buffer_ft, self.nearest_ft, self.cell = buffer_ft, nearest_ft, cell
        self.cluster_size, self.seed, self.materialize, self.salt = cluster_size, seed, materialize, salt

    # --- streets ------------------------------------------------------------------
    @cached_property
    def city_streets(self):
        return S.city_streets(self.segments)

    @cached_property
    def street_filter_qa(self):
        return S.street_filter_qa(self.segments)

    @cached_property
    def segments_per_block(self):
        return S.segments_per_block(self.segments)

    @cached_property
    def id_cardinality(self):
        return S.id_cardinality(self.city_streets)

    @cached_property
    def zip_pairs(self):
        return zip_pairs(self.city_streets)

    @cached_property
    def zip_edges(self):
        return zip_edges(self.city_streets)

    @cached_property
    def zip_neighbors(self):
        return zip_neighbors(self.zip_edges)

    @cached_property
    def zip_cluster(self):
        return zip_cluster(self.zip_neighbors, self.cluster_size, self.seed, check=True)

    @cached_property
    def streets_in_zips(self):
        return streets_in_zips(self.city_streets, self.zip_cluster)

    @cached_property
    def generic_multi(self):
        return S.generic_multi(self.city_streets)

    @cached_property
    def generic_multi_segments(self):
        return S.generic_multi_segments(self.city_streets, self.generic_multi)

    @cached_property
    def nypd_streets(self):
        return S.nypd_streets(self.city_streets)

    @cached_property
    def seg_to_physical(self):
        return S.seg_to_physical(self.city_streets)

    @cached_property
    def seg_to_physical_qa(self):
        return S.seg_to_physical_qa(self.seg_to_physical)

    @cached_property
    def lines(self):
        return S.lines(self.city_streets)

    @cached_property
    def line_edges(self):
        """The lines taken apart into edges, written once for all distance joins."""
        from ..operators.spatial import line_edges
        e = line_edges(self.lines)
        return e.write("line-edges") if self.materialize else e

    def map_layer(self, which: str = "zip"):
        src = {"zip": (self.streets_in_zips, S.LABEL_ZIP_STREETS),
               "generic": (self.generic_multi_segments, S.LABEL_GENERIC),
               "nypd": (self.nypd_streets, S.LABEL_NYPD)}[which]
        return S.map_layer(*src)

    def map_tiles(self, which: str = "zip", zooms=None):
        """A map layer cut into tiles (``operators.tiles``)."""
        from ..operators.tiles import ZOOMS, tile_pieces
        layer = self.map_layer(which)
        return tile_pieces(layer, [c for c in layer.columns if c != "geom"], zooms or ZOOMS)

    # --- blocks -------------------------------------------------------------------
    @cached_property
    def physical_blocks(self):
        return B.physical_blocks(self.city_streets)

    @cached_property
    def physical_blocks_geom(self):
        return B.physical_blocks(self.city_streets, with_geom=True)

    @cached_property
    def block_parts(self):
        return B.dissolve_parts(self.city_streets)

    @cached_property
    def block_lines(self):
        """The blocks' lines, noded and without overlaps: the union of their segments."""
        return B.block_lines(self.city_streets)

    @cached_property
    def street_ranges(self):
        return B.street_ranges(self.city_streets)

    @cached_property
    def names_auto(self):
        return B.names_auto(self.street_ranges, self.physical_blocks)

    @cached_property
    def block_names(self):
        return B.names_merged(self.names_auto, self.overrides)

    @cached_property
    def name_coverage(self):
        return B.name_coverage(self.block_names)

    @cached_property
    def names_by_source(self):
        return B.names_by_source(self.block_names)

    @cached_property
    def name_sample(self):
        return B.name_sample(self.block_names, 15, self.seed)

    @cached_property
    def review(self):
        return B.review(self.block_names, self.physical_blocks)

    @cached_property
    def review_counts(self):
        return B.review_counts(self.review)

    @cached_property
    def id_crosswalk(self):
        return S.id_crosswalk(self.city_streets)

    @cached_property
    def id_crosswalk_qa(self):
        return S.id_crosswalk_qa(self.id_crosswalk)

    @cached_property
    def block_ids(self):
        return B.block_ids(self.id_crosswalk)

    @cached_property
    def block_id_chunks(self):
        return B.block_id_chunks(self.block_ids)

    @cached_property
    def block_id_summary(self):
        return B.block_id_summary(self.id_crosswalk)

    @cached_property
    def master(self):
        named = B.names_merged(B.names_auto(self.street_ranges, self.physical_blocks, B.BLOCK_COLS), self.overrides, B.BLOCK_COLS)
        return B.master(named, B.block_id_summary(self.id_crosswalk, lists=B.CENSUS_LISTS))

    @cached_property
    def master_totals(self):
        return B.master_totals(self.master)

    @cached_property
    def master_by_boro(self):
        return B.master_by_boro(self.master)

    @cached_property
    def master_by_source(self):
        return B.master_by_source(self.master)

    # --- matching -----------------------------------------------------------------
    @cached_property
    def parcels_keyed(self):
        return M.parcel_keys(self.parcels)

    @cached_property
    def segment_lookup(self):
        return M.segment_lookup(self.city_streets)

    @cached_property
    def cascade(self):
        return M.run_cascade(self.parcels_keyed, self.pad_addr, self.pad_bill, M.segment_ids(self.city_streets),
                             lambda: self.line_edges, buffer_ft=self.buffer_ft, nearest_ft=self.nearest_ft,
                             cell=self.cell, materialize=self.materialize, salt=self.salt)

    def wave(self, name: str) -> DataFrame:
        return self.cascade.match(name)

    @cached_property
    def wave_qa(self):
        return self.cascade.qa()

    @cached_property
    def run_counts(self):
        """The counters that a run reports, as one table (stage, counter, n)."""
        waves = self.wave_qa.select(F.concat(F.lit("wave "), "wave").alias("stage"), F.inline(F.array(*[
            F.struct(F.lit(c).alias("counter"), F.col(c).alias("n")) for c in ("pairs_added", "keys_matched", "remaining")])))
        final = self.bbl_summary
        final = final.select(F.lit("crosswalk").alias("stage"), F.inline(F.array(*[F.struct(F.lit(c).alias("counter"), F.col(c).alias("n")) for c in final.columns])))
        return waves.unionByName(final)

    @cached_property
    def within_buffer(self):
        """All parcel-line pairs within the buffer radius, over all parcels."""
        from ..operators.spatial import within_distance
        return within_distance(self.parcels_keyed.select("bbl_chr", "geom"), self.line_edges, self.buffer_ft, self.cell,
                               salt=self.salt, write=self.materialize)

    def within_buffer_least(self, use: Callable[[DataFrame], DataFrame], least: Column, name: str):
        """By BBL and line the least of a column over ``use`` of the rows of ``within_buffer``: no pair is shuffled to be grouped."""
        from ..operators.spatial import least_within
        return least_within(self.parcels_keyed.select("bbl_chr", "geom"), self.line_edges, self.buffer_ft, use, least, name, self.cell,
                            salt=self.salt, write=self.materialize)

    @cached_property
    def nearest(self):
        """Nearest line within the nearest radius for every parcel row."""
        return M.wave4_pairs(M.all_bbls(self.parcels_keyed), self.parcels_keyed, self.line_edges,
                             self.nearest_ft, self.cell, self.salt, self.materialize)

    @cached_property
    def bbl_segment_physical(self):
        return self.cascade.all_matches()  # each wave's are distinct and have its name

    def _linked(self, *of: str, values: DataFrame | None = None) -> DataFrame:
        """(bbl_chr, columns ``of`` of the lines, source), distinct, over all waves; with ``values`` (a row a BBL) also these.

        The pairs of wave 3 are made distinct, and get their values, without a shuffle.
        """
        found = reduce(DataFrame.unionByName, self.cascade.written().values()).select("bbl_chr", *of, "source").distinct()
        if values is not None:
            found = left_outer(found, values, "bbl_chr", null_safe=False)
        near = M.wave3(self.cascade.left_before(M.W3), self.parcels_keyed, self.line_edges, self.buffer_ft, self.cell, self.salt, self.materialize, of, values)
        return found.unionByName(near.withColumn("source", F.lit(M.W3)))

    def _expanded(self, join: Callable[[DataFrame], DataFrame], each: DataFrame) -> DataFrame:
        """``join`` (of BBLs' blocks with ``each``) of the written waves, and the same rows of wave 3, whose BBLs are others: its pairs aren't shuffled."""
        found = join(reduce(DataFrame.unionByName, self.cascade.written().values()))
        near = M.wave3(self.cascade.left_before(M.W3), self.parcels_keyed, self.line_edges, self.buffer_ft, self.cell, self.salt, self.materialize, (D.KEY,), each=each)
        return found.unionByName(near.select(*found.columns))

    @cached_property
    def bbl_to_physical(self):
        return self._linked("physical_id")

    @cached_property
    def bbl_to_segment(self):
        return self._linked("segment_id")

    @cached_property
    def bbl_summary(self):
        return D.bbl_summary(self.bbl_to_physical, self.cascade.matched_keys(), self.cascade.final_remaining)

    @cached_property
    def match_rate(self):
        return D.match_rate(self.bbl_to_physical)

    # --- derived ------------------------------------------------------------------
    @cached_property
    def bin_to_physical(self):
        return self._expanded(lambda b2p: D.bin_to_physical(self.pad_addr, b2p), D.bins(self.pad_addr))

    @cached_property
    def match_inputs(self):
        return D.match_inputs(self.parcels_keyed, self.segment_lookup)

    @cached_property
    def bin_to_bbl(self):
        return D.bin_to_bbl(self.pad_addr)

    @cached_property
    def counts_per_block(self):
        """Block, BBLs, BINs and addresses: no pair of a BBL and a block is shuffled to be counted."""
        return D.counted_blocks(self._linked("physical_id", values=D.counts_per_bbl(self.pad_addr)))

    @cached_property
    def address_summary(self):
        n = self.counts_per_block.where(F.col("n_addresses").isNotNull())
        return n.agg(F.coalesce(F.sum("n_addresses"), F.lit(0)).cast("bigint").alias("total_addresses"), F.count(F.lit(1)).cast("bigint").alias("blocks_with_addresses"))

    @cached_property
    def bin_summary(self):
        return D.bin_summary(self.pad_addr, self.counts_per_block, self.cascade.matched_keys())

    @cached_property
    def address_list(self):
        return self._expanded(lambda b2p: D.address_list(self.pad_addr, b2p), D.addresses(self.pad_addr))

    @cached_property
    def addr_per_block(self):
        return D.addr_per_block(self.counts_per_block)

    @cached_property
    def addr_per_block_summary(self):
        return D.addr_per_block_summary(self.addr_per_block)

    @cached_property
    def master_full(self):
        return D.master_full(self.master, self.counts_per_block)

    @cached_property
    def master_full_summary(self):
        return D.master_full_summary(self.master_full)

    @cached_property
    def unmatched(self):
        return D.unmatched(self.parcels_keyed, self.cascade.final_remaining)

    @cached_property
    def unmatched_by_land_use(self):
        return D.unmatched_by_land_use(self.unmatched)

    def share(self) -> BlockCrosswalk:
        """Write the tables that several outputs use (blocks, names) once; later tables read them."""
        for name in ("physical_blocks", "block_names", "master"):
            setattr(self, name, write_and_read(getattr(self, name), name))
        return self
