"""Named queries over the driver's test tables: ``name -> (spark, sf_dir) -> DataFrame``.

Every query runs the full pipeline over the whole tables of the folder (the
domain inputs are built from the driver tables by ``sources.fixtures``).
Geometry arrays are left out of tabular results; the spatial outputs carry
distances or flat vertex rows instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import to_srid
from ..operators.chunks import ranked
from ..operators.noding import noded, nodes
from ..operators.tiles import tile_counts, tile_pieces
from ..schemas import PAD_ADDR, SRID_NY_FT, SRID_WGS84
from ..session import ensure_checkpoint_dir
from ..sources.fixtures import Inputs
from ..sources.readers import read_delimited, read_features, read_overrides
from ..sources.sinks import write_features, write_table
from . import blocks as B
from . import match as M
from . import streets as S
from .pipeline import BlockCrosswalk


# One pipeline per (application, folder): the inputs and the cascade's wave
# tables are written once per session and shared by every query built on them.
_PIPELINES: dict[tuple[str, str], BlockCrosswalk] = {}


class _FromFolder(BlockCrosswalk):
    """The crosswalk of one folder's tables; an input is prepared when a query first reads it."""

    def __init__(self, inputs: Inputs, **kw):
        self._inputs = inputs
        self._set(**kw)

    segments = cached_property(lambda self: self._inputs.segments)
    parcels = cached_property(lambda self: self._inputs.parcels)
    pad_addr = cached_property(lambda self: self._inputs.pad_addr)
    pad_bill = cached_property(lambda self: self._inputs.pad_bill)
    overrides = cached_property(lambda self: self._inputs.overrides)


def crosswalk(spark: SparkSession, sf_dir: str, **kw) -> BlockCrosswalk:
    key = (spark.sparkContext.applicationId, sf_dir)
    if kw:
        return _FromFolder(Inputs(spark, sf_dir), **kw)
    if key not in _PIPELINES:
        _PIPELINES[key] = _FromFolder(Inputs(spark, sf_dir))
    return _PIPELINES[key]


def within_50_lonlat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 ft join of parcels that come in longitude and latitude; distances to 0.01 ft, beyond the edge left out."""
    i = Inputs(spark, sf_dir)
    lonlat = to_srid(i.parcels, SRID_WGS84)
    x = BlockCrosswalk(i.segments, lonlat, i.pad_addr)
    near = lambda d: d.withColumn("dist_ft", F.round("dist_ft", 2)).where("dist_ft < 49.9 and (dist_ft = 0 or dist_ft > 0.1)")
    return x.within_buffer_least(near, F.floor(F.col("dist_ft") / 10), "tens_ft")


_WRITTEN: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """The path of files that a round trip reads back: written on first use by a session, for a folder's tables."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
        write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The address directory written as padded text and read back."""
    pad = Inputs(spark, sf_dir).pad_addr
    text = pad.select(*[F.rpad(F.coalesce(F.col(c).cast("string"), F.lit("NA" if c == "stname" else "")), 24, " ").alias(c) for c in pad.columns])
    path = _once(spark, sf_dir, "directory", text.write.option("header", True).option("ignoreTrailingWhiteSpace", False).csv)
    return read_delimited(spark, path, PAD_ADDR)




def overrides_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The survey file written as text and read back, after the template that a first run writes (no rows)."""
    survey = Inputs(spark, sf_dir).overrides
    empty = _once(spark, sf_dir, "survey-template", lambda path: None)
    first = read_overrides(spark, empty)  # nothing is there, so the template is written
    full = _once(spark, sf_dir, "survey", survey.write.option("header", True).option("nullValue", "NA").csv)
    return first.unionByName(read_overrides(spark, full))


def features_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parcels written as WKB polygons, lines as WKB and as WKT, read back as layers; a row for each vertex."""
    i = Inputs(spark, sf_dir)
    out = None
    for name, df, key, kind, wkb in (("parcels", i.parcels.withColumn("id", F.col("address")), "id", "POLYGON", True),
                                     ("lines", i.segments.withColumn("id", F.col("segment_id").cast("string")), "id", "MULTILINESTRING", True),
                                     ("text", i.segments.withColumn("id", F.col("segment_id").cast("string")), "id", "MULTILINESTRING", False)):
        path = _once(spark, sf_dir, f"layer-{name}", lambda p: write_features(df.select(key, "geom"), p, kind, wkb=wkb))  # noqa: B023 (called at once)
        read = read_features(spark, path, SRID_NY_FT, geom_col="geom" if wkb else "wkt")
        v = read.distinct().select(F.lit(name).alias("layer"), key, F.posexplode("geom").alias("part_no", "part"))
        v = v.select("layer", key, F.col("part_no").cast("bigint").alias("part_no"), F.posexplode("part").alias("vertex_no", "p"))
        v = v.select("layer", key, "part_no", F.col("vertex_no").cast("bigint").alias("vertex_no"), F.col("p.x").alias("x"), F.col("p.y").alias("y"))
        out = v if out is None else out.unionByName(v)
    return out


def sorted_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The BBL crosswalk written as a sorted table; each row's place in the files that were written."""
    path = _once(spark, sf_dir, "sorted", lambda p: write_table(crosswalk(spark, sf_dir).bbl_to_physical, p, sort=["bbl_chr", "physical_id", "source"]))
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_f"), F.col("_metadata.row_index").alias("_i"))
    return ranked(rows, (), ("_f", "_i"), "place", lying=True).drop("_f", "_i")


def waves_without_billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of all waves where the optional billing table is missing."""
    i = Inputs(spark, sf_dir)
    return BlockCrosswalk(i.segments, i.parcels, i.pad_addr, None, i.overrides).wave_qa


def _grid_streets(x: BlockCrosswalk) -> DataFrame:
    """City streets drawn as a level and an upright line each, on a small grid, so that those of a block cross and overlap."""
    point = lambda a, b: F.struct(a.cast("double").alias("x"), b.cast("double").alias("y"))
    at = lambda k, n: (F.col("segment_id") * k) % n
    level = F.array(point(at(17, 100), at(31, 12)), point(at(17, 100) + 5 + at(1, 50), at(31, 12)))
    upright = F.array(point(at(13, 20), at(7, 60) + 5 + at(1, 40)), point(at(13, 20), at(7, 60)))
    return x.city_streets.select("physical_id", F.array(level, upright).alias("geom"))


def _no_geom(df: DataFrame) -> DataFrame:
    return df.drop("geom")


def _q(fn: Callable[[BlockCrosswalk], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(crosswalk(spark, sf_dir))
    run.__doc__ = fn.__doc__
    return run


def _parts_as_rows(df: DataFrame) -> DataFrame:
    v = df.select("physical_id", F.posexplode("part").alias("vertex_no", "p"))
    return v.select("physical_id", F.col("vertex_no").cast("bigint").alias("vertex_no"),
                    F.col("p.x").alias("x"), F.col("p.y").alias("y"))


QUERIES: dict[str, Callable[[BlockCrosswalk], DataFrame]] = {
    # streets
    "city_streets": lambda x: _no_geom(x.city_streets),
    "street_filter_qa": lambda x: x.street_filter_qa,
    "segments_per_block": lambda x: x.segments_per_block,
    "id_cardinality": lambda x: x.id_cardinality,
    "zip_pairs": lambda x: x.zip_pairs,
    "zip_edges": lambda x: x.zip_edges,
    "zip_neighbors": lambda x: x.zip_neighbors.select(
        "zip1", F.array_join("neighbors", ";").alias("neighbors"), "degree"),
    "zip_cluster": lambda x: x.zip_cluster,
    "streets_in_zips": lambda x: _no_geom(x.streets_in_zips),
    "generic_multi": lambda x: x.generic_multi,
    "generic_multi_segments": lambda x: _no_geom(x.generic_multi_segments),
    "nypd_streets": lambda x: _no_geom(x.nypd_streets),
    "seg_to_physical": lambda x: x.seg_to_physical,
    "seg_to_physical_qa": lambda x: x.seg_to_physical_qa,
    "map_layer": lambda x: S.map_layer_vertices(x.map_layer("zip")),
    "map_layer_generic": lambda x: S.map_layer_vertices(x.map_layer("generic")),
    "map_layer_nypd": lambda x: S.map_layer_vertices(x.map_layer("nypd")),
    "map_tiles": lambda x: tile_counts(tile_pieces(x.map_layer("nypd"), ("segment_id",))),
    # blocks
    "physical_blocks": lambda x: x.physical_blocks,
    "block_lines": lambda x: noded(_grid_streets(x)),
    "block_nodes": lambda x: nodes(noded(_grid_streets(x))),
    "block_id_chunks": lambda x: B.block_id_chunks(x.block_ids, 4),
    "run_counts": lambda x: x.run_counts,
    "block_parts": lambda x: _parts_as_rows(x.block_parts),
    "street_ranges": lambda x: x.street_ranges,
    "names_auto": lambda x: x.names_auto,
    "names_merged": lambda x: x.block_names,
    "name_coverage": lambda x: x.name_coverage,
    "names_by_source": lambda x: x.names_by_source,
    "name_sample": lambda x: x.name_sample,
    "review": lambda x: x.review,
    "review_counts": lambda x: x.review_counts,
    "id_crosswalk": lambda x: x.id_crosswalk,
    "id_crosswalk_qa": lambda x: x.id_crosswalk_qa,
    "block_ids": lambda x: x.block_ids.select("physical_id", "list", "value"),
    "block_id_summary": lambda x: x.block_id_summary,
    "master": lambda x: x.master,
    "master_totals": lambda x: x.master_totals,
    "master_by_boro": lambda x: x.master_by_boro,
    "master_by_source": lambda x: x.master_by_source,
    # matching
    "segment_lookup": lambda x: x.segment_lookup,
    "match_inputs": lambda x: x.match_inputs,
    "wave1": lambda x: x.wave(M.W1),
    "wave2a": lambda x: x.wave(M.W2A),
    "wave2b": lambda x: x.wave(M.W2B),
    "wave3": lambda x: x.wave(M.W3),
    "wave4": lambda x: x.wave(M.W4),
    "wave_qa": lambda x: x.wave_qa,
    "within_50": lambda x: x.within_buffer.withColumn("dist_ft", F.round("dist_ft", 6)),
    "nearest_150": lambda x: x.nearest.withColumn("dist_ft", F.round("dist_ft", 6)),
    "bbl_segment_physical": lambda x: x.bbl_segment_physical,
    "bbl_to_physical": lambda x: x.bbl_to_physical,
    "bbl_to_segment": lambda x: x.bbl_to_segment,
    "bbl_summary": lambda x: x.bbl_summary,
    "match_rate": lambda x: x.match_rate,
    # derived
    "bin_to_bbl": lambda x: x.bin_to_bbl,
    "bin_to_physical": lambda x: x.bin_to_physical,
    "bin_summary": lambda x: x.bin_summary,
    "address_list": lambda x: x.address_list,
    "address_summary": lambda x: x.address_summary,
    "addr_per_block": lambda x: x.addr_per_block,
    "addr_per_block_summary": lambda x: x.addr_per_block_summary,
    "master_full": lambda x: x.master_full,
    "master_full_summary": lambda x: x.master_full_summary,
    "unmatched": lambda x: x.unmatched,
    "unmatched_by_land_use": lambda x: x.unmatched_by_land_use,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _q(fn) for name, fn in QUERIES.items()} | {"within_50_lonlat": within_50_lonlat, "csv_round_trip": csv_round_trip,
                                                                  "overrides_round_trip": overrides_round_trip, "features_round_trip": features_round_trip,
                                                                  "sorted_table": sorted_table, "waves_without_billing": waves_without_billing}
