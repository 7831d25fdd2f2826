"""A training-data pipeline over ``documents``: five stages, each written and read again.

Toxic documents go; of each group of near-duplicates one document stays;
personal data are covered in the texts; sources are repeated to their target
weights in a global random order; the texts are encoded, and decoded again.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``.  All but
the last return the columns of ``docs``; the last returns (doc_id, n_tokens, ids,
ids_sha256, decoded_sha256), one row for each copy.  Nulls, empty texts, ties,
repeated rows, empty tables and further columns are handled as the operators'
docstrings say.

A stage's result reads tables that the stage has written for itself.  They are dropped
by the next stage, unless its ``docs`` reads them still, not having been written.  So
the disk holds the tables of one stage at a time.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockxwalk.llm import bpe, mixing, neardup, pii, toxicity
from blockxwalk.llm.common import importable, read_table
from blockxwalk.session import drop_tables, read_paths, write_table, written_tables

#: By application: the stage that was called last, and the tables that it has written for itself.
_OWN: dict[str, tuple[str, list[str]]] = {}


def _stage(f: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage; if another was called before it, that one's tables are dropped first, but for those that docs reads."""
    @functools.wraps(f)
    def call(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        last, tables = _OWN.get(app, (f.__name__, []))
        if last != f.__name__:
            used = {p.split(":", 1)[-1].lstrip("/") for p in read_paths(docs)}  # with or without the file system's name
            gone = [p for p in tables if p.split(":", 1)[-1].lstrip("/") not in used]
            drop_tables(spark, gone)
            tables = [p for p in tables if p not in set(gone)]
        before = set(written_tables(spark))
        try:
            return f(spark, docs, sf_dir)
        finally:
            _OWN[app] = f.__name__, tables + [p for p in written_tables(spark) if p not in before]

    return call


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the noisy-or model, learned from ``labels``, doesn't reject."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


@_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each near-duplicate class."""
    importable(spark)
    return neardup.keep_one(docs)


@_stage
def cover_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by their kind; ``n_chars`` follows."""
    importable(spark)
    return pii.redact(docs, pii.fit(docs))


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies by Poisson draws to source weights of volume ** 0.5, shuffled globally."""
    copy = "copy"
    while copy in docs.columns:
        copy += "_"
    return mixing.mix(docs, copy_col=copy).drop(copy)


@_stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every copy, and digests of them and of the text decoded from them."""
    importable(spark)
    return bpe.round_trip(docs).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2(bpe.joined(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("pii", cover_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: The trained stages, the estimate of similarity and the token ids have no SQL; tests/llm/test_pipeline.py has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = write_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
        docs = spark.read.parquet(path)
        if before:
            drop_tables(spark, [before])
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
