"""Sinks: tables, feature layers and map layers.

* ``write_table``: Parquet (default) or CSV.  CSV writes NULL as ``NA`` and
  array columns joined with ``;`` (CSV has no array type).
* ``write_features``: geometry kept as vertex arrays plus a WKT text column (or
  as WKB bytes), so any GIS tool can read it back.
* ``write_map_layer``: one GeoJSON Feature per line (``.write.text``), built
  with ``to_json`` on the executors -- the distributed form of a web-map
  layer; the browser widget itself is not part of this library.
* ``write_all``: the production run -- every output of a ``BlockCrosswalk``
  written as a table.  The cascade already cuts lineage per wave; each
  output is then an independent job that re-reads written tables only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geometry import to_wkt
from ..functions.wkb import to_wkb
from ..operators.ordering import sort_na_last


def _csv_ready(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType) and not isinstance(f.dataType.elementType, (T.ArrayType, T.StructType)):
            cols.append(F.array_join(F.col(f.name).cast("array<string>"), ";").alias(f.name))
        elif isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", sort: list[str] | None = None,
                partitions: int | None = None) -> None:
    """Write a result table (overwrite).  ``sort`` gives a total, NULL-last order
    (a range-partitioned sort); ``partitions`` coalesces small outputs."""
    out = df
    if sort:
        out = sort_na_last(out, *sort)
    if partitions:
        out = out.coalesce(partitions)
    w = out.write.mode("overwrite")
    if fmt == "csv":
        _csv_ready(out).write.mode("overwrite").option("header", True).option("nullValue", "NA") \
            .option("emptyValue", "").csv(path)
        return
    w.format(fmt).save(path)


def write_features(df: DataFrame, path: str, kind: str = "MULTILINESTRING", geom: str = "geom", wkb: bool = False) -> None:
    """Feature layer: attributes, vertex-array geometry and its WKT text; with ``wkb`` the geometry as WKB bytes instead of both."""
    if wkb:
        out = df.withColumn(geom, to_wkb(df[geom], rings=kind == "POLYGON"))
    else:
        out = df.withColumn("wkt", to_wkt(geom, kind))
    out.write.mode("overwrite").parquet(path)


def geojson_lines(df: DataFrame, geom: str = "geom", props: list[str] | None = None,
                  kind: str = "MultiLineString") -> DataFrame:
    """One GeoJSON Feature (text) per row; coordinates from the vertex arrays."""
    props = props or [c for c in df.columns if c != geom]
    coords = F.transform(F.col(geom), lambda part: F.transform(part, lambda v: F.array(v["x"], v["y"])))
    feature = F.struct(F.lit("Feature").alias("type"),
                       F.struct(F.lit(kind).alias("type"), coords.alias("coordinates")).alias("geometry"),
                       F.struct(*[F.col(c) for c in props]).alias("properties"))
    return df.select(F.to_json(feature).alias("value"))


def write_map_layer(layer: DataFrame, path: str, props: list[str] | None = None) -> None:
    geojson_lines(layer, props=props).write.mode("overwrite").text(path)


# Output names.  name -> (attribute of BlockCrosswalk, sort columns); the written outputs of a run
OUTPUTS = {
    "seg_to_physical": ("seg_to_physical", None),
    "block_names": ("block_names", None),
    "blocks_needing_review": ("review", None),
    "id_crosswalk": ("id_crosswalk", None),
    "block_id_summary": ("block_id_summary", None),
    "master_block_list": ("master", None),
    "bbl_to_physical": ("bbl_to_physical", ["bbl_chr", "physical_id"]),
    "bbl_to_segment": ("bbl_to_segment", ["bbl_chr", "segment_id"]),
    "bin_to_physical": ("bin_to_physical", None),
    "block_address_list": ("address_list", ["physical_id", "address"]),
    "master_block_list_full": ("master_full", None),
    "unmatched_bbls": ("unmatched", None),
    "physical_block_lines": ("block_lines", None),
    "block_id_chunks": ("block_id_chunks", None),
    "run_counts": ("run_counts", None),
}


def write_all(x, out_dir: str, fmt: str = "parquet") -> dict[str, str]:
    """Write every output table of a ``BlockCrosswalk`` under ``out_dir``."""
    paths = {}
    x.share()
    for name, (attr, sort) in OUTPUTS.items():
        p = f"{out_dir.rstrip('/')}/{name}"
        write_table(getattr(x, attr), p, fmt=fmt, sort=sort)
        paths[name] = p
    base = out_dir.rstrip("/")
    paths |= {name: f"{base}/{name}" for name in ("physical_blocks", "physical_block_parts")}
    write_table(x.physical_blocks, paths["physical_blocks"])
    # the blocks' geometry as a row for each part: no block's geometry is collected
    write_features(x.block_parts.select("physical_id", F.array("part").alias("geom")), paths["physical_block_parts"])
    return paths
