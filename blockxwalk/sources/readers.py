"""Readers for the input layers.

* ``read_delimited``: header CSV with a fixed schema (ids keep leading zeros;
  nothing is inferred).  Input column names are cleaned to snake_case.
* ``read_overrides`` / ``ensure_overrides``: the manual block-name file; on
  first use an empty template with the expected header is written.
* ``read_features``: a feature layer stored as Parquet or CSV with a WKT or
  WKB geometry column (or an already decoded vertex-array column), tagged with
  its CRS, transformed to another if asked.  The original geodatabase container format is a single-machine
  format; layers are expected to be exported to a splittable format first.
* ``clean_names``: snake_case column names, de-duplicated with ``_2``, ``_3``.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geometry import from_wkt, to_srid, with_srid
from ..functions.wkb import from_wkb
from ..schemas import MANUAL_OVERRIDES

_SPECIAL = {"%": "_percent_", "#": "_number_"}


def snake_case(name: str) -> str:
    """``BoroCode`` -> ``boro_code``, ``L_ZIP`` -> ``l_zip``, ``Shape_Length`` -> ``shape_length``."""
    s = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode()
    for k, v in _SPECIAL.items():
        s = s.replace(k, v)
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s)
    s = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", s)
    s = re.sub(r"[^A-Za-z0-9]+", "_", s).strip("_").lower()
    if not s:
        s = "x"
    if s[0].isdigit():
        s = "x" + s
    return s


def clean_names(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rename every column to snake_case (columns in ``keep`` stay as they are)."""
    seen: dict[str, int] = {}
    out = []
    for c in df.columns:
        n = c if c in keep else snake_case(c)
        if n in seen:
            seen[n] += 1
            n = f"{n}_{seen[n]}"
        else:
            seen[n] = 1
        out.append(n)
    return df.toDF(*out)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   sep: str = ",", clean: bool = True, null_value: str = "NA") -> DataFrame:
    """Header CSV.  Header names are cleaned first; values are trimmed, and blank
    ones and ``null_value`` are missing.  With ``schema`` each column is typed by
    name (unparsable values become NULL), otherwise all are text."""
    raw = spark.read.option("header", True).option("sep", sep).option("inferSchema", False).csv(path)
    if clean:
        raw = clean_names(raw)
    missing = [f.name for f in schema.fields if f.name not in raw.columns] if schema else []
    if missing:
        raise ValueError(f"missing columns in {path}: {missing}")
    return _trimmed(raw, schema, null_value)


def _trimmed(raw: DataFrame, schema: T.StructType | None, null_value: str) -> DataFrame:
    # fields may be padded inside quotes too, so the CSV reader's own trimming is not enough
    fields = schema.fields if schema else raw.schema.fields
    cols = []
    for f in fields:
        v = F.btrim(F.col(f"`{f.name}`"), F.lit(" \t\r"))
        v = F.nullif(F.nullif(v, F.lit("")), F.lit(null_value))
        cols.append((v.try_cast(f.dataType) if schema else v).alias(f.name))
    return raw.select(*cols)


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_overrides_template(spark: SparkSession, path: str) -> None:
    """Write an empty overrides file (header only); a path that exists is an error."""
    (spark.createDataFrame([], MANUAL_OVERRIDES).coalesce(1).write.mode("errorifexists")
     .option("header", True).csv(path))


def ensure_overrides(spark: SparkSession, path: str) -> bool:
    """Create the empty template when nothing is at the path; True when created."""
    fs, p = _file_system(spark, path)
    if fs.exists(p):
        return False
    write_overrides_template(spark, path)
    return True


#: A survey file that Spark's file sources skip for its name is read by the driver, up to this size.
MAX_HIDDEN_BYTES = 64 << 20


def read_overrides(spark: SparkSession, path: str, create: bool = True) -> DataFrame:
    """Manual block names with their fixed types (template written on first use)."""
    if create:
        ensure_overrides(spark, path)
    fs, p = _file_system(spark, path)
    reader = spark.read.option("header", True)
    names = ", ".join(f"`{f.name}` string" for f in MANUAL_OVERRIDES.fields)
    if p.getName()[:1] in ("_", ".") and fs.exists(p) and fs.getFileStatus(p).isFile():
        if fs.getFileStatus(p).getLen() > MAX_HIDDEN_BYTES:
            raise ValueError(f"{path}: Spark skips files named so; rename it")
        stream = fs.open(p)
        try:
            lines = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").splitlines()
        finally:
            stream.close()
        raw = reader.schema(names).csv(spark.sparkContext.parallelize(lines, 1))
    else:
        raw = reader.schema(names).csv(path)
    return _trimmed(raw, MANUAL_OVERRIDES, "NA")


def read_features(spark: SparkSession, path: str, srid: int, geom_col: str = "geom",
                  fmt: str = "parquet", clean: bool = True, target_srid: int | None = None,
                  schema: T.StructType | None = None) -> DataFrame:
    """Feature layer -> DataFrame with a vertex-array ``geom`` column tagged with ``srid``.

    ``geom_col`` holds (MULTI)LINESTRING / (MULTI)POLYGON text, WKB bytes, or
    already ``array<array<struct<x,y,...>>>``; which, follows from its type.
    ``target_srid``: the CRS to transform to.  ``schema``: columns (by their
    cleaned names) to select and cast; unparsable values become NULL.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    df = reader.load(path)
    if clean:
        df = clean_names(df, keep=(geom_col,))
    kind = df.schema[geom_col].dataType
    if isinstance(kind, T.BinaryType):
        g = from_wkb(df[geom_col])
    else:
        g = from_wkt(geom_col) if isinstance(kind, T.StringType) else df[geom_col]
    df = df.withColumn("geom", g)
    if geom_col != "geom":
        df = df.drop(geom_col)
    if schema is not None:
        df = df.select(*[df["geom"] if f.name == "geom" else df[f.name].try_cast(f.dataType).alias(f.name) for f in schema.fields])
    df = with_srid(df, "geom", srid)
    return df if target_srid is None else to_srid(df, target_srid)
