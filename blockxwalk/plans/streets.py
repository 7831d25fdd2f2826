"""Street-segment stage: drivable city streets, id QA, ZIP graph, crosswalk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import clean_parts, clean_parts_sql, drop_zm_sql, reproject_sql, srid_of, with_srid
from ..functions.text import label, not_blank, not_in_keep_null
from ..operators.aggregates import count_by, n_distinct_na, six_number
from ..operators.joins import restrict
from ..schemas import SRID_WGS84

# The street filter.
DRIVABLE_FEATURE_TYPES = ("0", "6")      # mapped streets
ACTIVE_STATUS = "2"                      # active
UNDIVIDED_SEGMENT_TYPE = "U"             # undivided standard geometry
VEHICULAR_TRAFFIC = ("T", "A", "W")      # vehicular
EXCLUDED_ROADWAY_TYPES = ("2", "3", "4", "9")   # highways, bridges, tunnels, ramps

# Output columns.
SEG_TO_PHYSICAL_COLS = (
    "segment_id", "physical_id", "generic_id", "nypdid", "fdnyid", "street", "saf_street_name",
    "from_left", "to_left", "from_right", "to_right", "l_zip", "r_zip", "l_boro", "r_boro",
    "l_cd", "r_cd", "lct2020", "rct2020", "lcb2020", "rcb2020", "l_block_face_id",
    "r_block_face_id", "shape_length",
)

ID_CROSSWALK_COLS = (
    "segment_id", "physical_id", "generic_id", "fdnyid", "l_block_face_id", "r_block_face_id",
    "lct2020", "rct2020", "lcb2020", "rcb2020",
)


def drivable(segments: DataFrame) -> DataFrame:
    return segments.filter(
        F.col("feature_typ").isin(*DRIVABLE_FEATURE_TYPES)
        & (F.col("status") == ACTIVE_STATUS)
        & (F.col("segment_typ") == UNDIVIDED_SEGMENT_TYPE)
        & F.col("traf_dir").isin(*VEHICULAR_TRAFFIC))


def city_streets(segments: DataFrame) -> DataFrame:
    """Drivable streets minus highways/bridges/tunnels/ramps; NULL roadway type is kept."""
    return drivable(segments).filter(not_in_keep_null("rw_type", EXCLUDED_ROADWAY_TYPES))


def street_filter_qa(segments: DataFrame) -> DataFrame:
    """Distinct blocks after the drivable filter and after the roadway-type filter."""
    d = drivable(segments).withColumn(
        "_city", not_in_keep_null("rw_type", EXCLUDED_ROADWAY_TYPES).cast("int"))
    # one pass: per block, does any drivable row survive the second filter?
    per_block = d.groupBy("physical_id").agg(F.max("_city").alias("_any_city"))
    return per_block.agg(F.count(F.lit(1)).cast("bigint").alias("n_physical_streets"),
                         F.coalesce(F.sum("_any_city"), F.lit(0)).cast("bigint").alias("n_physical_city_streets"))


def segments_per_block(segments: DataFrame) -> DataFrame:
    """Six-number summary of segments per physical block (all segments)."""
    return six_number(count_by(segments, "physical_id", name="n"), "n")


def id_cardinality(streets: DataFrame) -> DataFrame:
    return streets.agg(n_distinct_na("segment_id").alias("n_segment_id"),
                       n_distinct_na("physical_id").alias("n_physical_id"),
                       n_distinct_na("generic_id").alias("n_generic_id"))


def generic_multi(streets: DataFrame) -> DataFrame:
    """Generic ids spanning more than one physical block."""
    return (streets.filter(F.col("generic_id").isNotNull())
            .groupBy("generic_id").agg(n_distinct_na("physical_id").alias("n_physical"))
            .filter(F.col("n_physical") > 1))


def generic_multi_segments(streets: DataFrame, multi: DataFrame) -> DataFrame:
    return restrict(streets, multi.select("generic_id"), "generic_id")


def nypd_streets(streets: DataFrame) -> DataFrame:
    return streets.filter(not_blank("nypdid"))


def seg_to_physical(streets: DataFrame) -> DataFrame:
    return streets.select(*SEG_TO_PHYSICAL_COLS).distinct()


def seg_to_physical_qa(xwalk: DataFrame) -> DataFrame:
    return xwalk.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"),
                     n_distinct_na("physical_id").alias("n_physical_id"),
                     n_distinct_na("generic_id").alias("n_generic_id"),
                     n_distinct_na("nypdid").alias("n_nypdid"))


def id_crosswalk(streets: DataFrame) -> DataFrame:
    return streets.select(*ID_CROSSWALK_COLS).distinct()


def id_crosswalk_qa(xwalk: DataFrame) -> DataFrame:
    """Rows, distinct blocks and distinct generic ids of the id crosswalk."""
    return xwalk.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"), n_distinct_na("physical_id").alias("n_physical_id"),
                     n_distinct_na("segment_id").alias("n_segment_id"), n_distinct_na("generic_id").alias("n_generic_id"))


def lines(streets: DataFrame) -> DataFrame:
    """Segment lines for spatial work: x/y only, repeated vertices and empty parts dropped."""
    out = streets.select("segment_id", "physical_id", clean_parts("geom").alias("geom")).distinct()
    srid = srid_of(streets, "geom")
    return with_srid(out, "geom", srid) if srid is not None else out


# Hover-label templates of the three inspection layers.
LABEL_ZIP_STREETS = "Street: %s<br>Physical ID: %s<br>Segment ID: %s<br>Generic ID: %s"
LABEL_GENERIC = "Street: %s<br>Generic ID: %s<br>Physical ID: %s<br>Segment ID: %s"
LABEL_NYPD = "Street: %s<br>NYPDID: %s<br>Physical ID: %s<br>Segment ID: %s<br>Generic ID: %s"
LABEL_COLUMNS = {
    LABEL_ZIP_STREETS: ("street", "physical_id", "segment_id", "generic_id"),
    LABEL_GENERIC: ("street", "generic_id", "physical_id", "segment_id"),
    LABEL_NYPD: ("street", "nypdid", "physical_id", "segment_id", "generic_id"),
}


def map_layer(streets: DataFrame, template: str = LABEL_ZIP_STREETS) -> DataFrame:
    """Inspection layer: lon/lat line geometry plus a formatted hover label."""
    src = srid_of(streets, "geom")
    geom = clean_parts_sql(drop_zm_sql("geom"))
    if src is not None and src != SRID_WGS84:
        geom = reproject_sql(geom, src, SRID_WGS84)
    out = streets.select("segment_id", "physical_id", F.expr(geom).alias("geom"),
                         label(template, *LABEL_COLUMNS[template]).alias("label_text"))
    return with_srid(out, "geom", SRID_WGS84)


def map_layer_vertices(layer: DataFrame, digits: int = 6) -> DataFrame:
    """One row per vertex of a map layer (rounded lon/lat) -- a checkable flat form."""
    parts = layer.select("segment_id", "label_text", F.posexplode("geom").alias("part_no", "part"))
    v = parts.select("segment_id", "label_text", "part_no", F.posexplode("part").alias("vertex_no", "p"))
    return v.select("segment_id", "label_text", F.col("part_no").cast("bigint").alias("part_no"),
                    F.col("vertex_no").cast("bigint").alias("vertex_no"),
                    F.round(F.col("p.x"), digits).alias("lon"), F.round(F.col("p.y"), digits).alias("lat"))
