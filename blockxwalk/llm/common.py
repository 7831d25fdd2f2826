"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

__all__ = ["chunks", "column", "importable", "kept", "let", "materialize", "normal_text", "pick", "place", "placed", "read_table"]

#: Rows that one Python-side step takes up together, and their characters, about:
#: a worker's memory follows these and the longest text, not the Arrow batch.
CHUNK_ROWS, CHUNK_BYTES = 512, 4_000_000


def importable(spark: SparkSession) -> None:
    """Let the Python workers find this package where the driver has found it.

    That serves local sessions and clusters with a shared folder; elsewhere the
    package is shipped with the job (``--py-files``).
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(name: str) -> Column:
    """A top-level column by its exact name (dots and spaces are part of it)."""
    return F.col("`" + name.replace("`", "``") + "`")


def normal_text(name: str = "text") -> Column:
    """The text column with null read as the empty text."""
    return F.coalesce(column(name).cast("string"), F.lit(""))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once: in a lambda, an expression that is named twice runs twice."""
    return F.transform(F.array(value), lambda x: use(x))[0]


def chunks(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of at most CHUNK_ROWS rows and about CHUNK_BYTES bytes, one row at least."""
    rows = max(1, min(CHUNK_ROWS, int(CHUNK_BYTES * b.num_rows / max(1, b.nbytes))))
    for i in range(0, b.num_rows, rows):
        yield b.slice(i, rows)


# --- rows by their places in files ----------------------------------------------

#: Rows whose bits make up a bitmap (4 KB); bitmaps that are broadcast together, at most.
BITMAP_ROWS, BITMAPS = 1 << 15, 8192
#: What may stand over files in a plan whose rows each have a place of their own.
_ONE_TO_ONE = re.compile(r"[\s:+-]*(Project|Filter|SubqueryAlias|Relation|View)\b")


def place(docs: DataFrame) -> tuple[Column, Column]:
    """A row's place, as columns file (a hash of its file's path) and at (its number in the file)."""
    meta = docs.metadataColumn("_metadata")
    return F.xxhash64(meta["file_path"]).alias("file"), meta["row_index"].alias("at")


def placed(docs: DataFrame) -> DataFrame:
    """The rows, so that each has a place of its own: as they are if they come straight from files, else written."""
    plan = docs._jdf.queryExecution().analyzed().toString()
    if all(map(_ONE_TO_ONE.match, plan.strip().splitlines())):
        try:
            docs.select(*place(docs))
            return docs
        except AnalysisException:  # the source has no numbered rows
            pass
    return materialize(docs, "placed")


def pick(docs: DataFrame, places: DataFrame, *wanted: Column) -> DataFrame:
    """The rows (of ``placed``) at some places (file, at): all columns; or the wanted ones, and file and at.

    A bit for each row of the input is broadcast, in portions of BITMAPS bitmaps by
    file; no row of ``docs`` is shuffled.
    """
    position = F.col("at").bitwiseAND(F.lit(BITMAP_ROWS - 1))
    bits = places.select("file", F.shiftright("at", 15).alias("range"), position.alias("p")).groupBy("file", "range").agg(F.bitmap_construct_agg("p").alias("bits"))
    bits = materialize(bits, "places")
    portions = max(1, -(-bits.count() // BITMAPS))
    rows = docs.select(F.struct(*(wanted or [column(c) for c in docs.columns])).alias("d"), *place(docs)).withColumn("range", F.shiftright("at", 15))
    byte = F.conv(F.hex(F.substring("bits", F.shiftright(position, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, position.bitwiseAND(F.lit(7)).cast("int")) == 1
    found = None
    for k in range(portions):
        own = F.pmod(F.col("file"), F.lit(portions)) == k
        part = rows.where(own).join(F.broadcast(bits.where(own)), ["file", "range"]).where(is_set)
        found = part if found is None else found.unionByName(part)
    return found.select("file", "at", "d.*") if wanted else found.select("d.*")


_KEPT: list = []  # of this worker process: the last (value, what was made of it)


def kept(value: object, make: Callable[[object], object]) -> object:
    """``make(value)``, kept for later tasks of this worker until another value comes: a worker holds one such thing."""
    if not _KEPT or _KEPT[0] is not value:
        _KEPT[:] = [value, make(value)]
    return _KEPT[1]
