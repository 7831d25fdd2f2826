"""Registered queries of the corpus operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, ann, bpe, chat, fingerprints, gnat, mixing, neardup, pii, secrets, toxicity, urls, vecdup
from .common import read_table


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document."""
    return bpe.round_trip(read_table(spark, sf_dir, "documents")).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(bpe.joined(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan every document for secrets."""
    base = F.filter("spans", lambda x: x["k"] < 3)
    count = lambda k: F.size(F.filter("spans", lambda x: x["k"] == k)).cast("long")
    return secrets.scan(read_table(spark, sf_dir, "documents")).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secrets.joined(base), 256).alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"))


#: A conversation that looks like another template's control strings (fixed value of the contract).
HARD_CHAT = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format every conversation, and a hard one."""
    hard = spark.createDataFrame(HARD_CHAT, "conv_id long, turn long, role string, text string")
    both = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(hard)
    return chat.digests(chat.encode_pages(both)).drop("n_tokens", "n_loss_tokens")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint every document and its edited text."""
    pairs = fingerprints.edited(read_table(spark, sf_dir, "documents"))
    return fingerprints.compare(pairs).withColumnRenamed("id", "doc_id")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document; learn from the labels that aren't held out."""
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "sentences")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Find personal data in every document."""
    docs = read_table(spark, sf_dir, "documents")
    base = F.filter("spans", lambda x: x["k"] < len(pii.BASE))
    count = lambda k: F.size(F.filter("spans", lambda x: x["k"] == k)).cast("long").alias(f"n_{pii.BASE[k]}")
    return pii.find(docs, pii.fit(docs)).select("doc_id", *map(count, range(len(pii.BASE))), F.sha2(pii.joined(base), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"))


def op6_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    rows, _ = neardup.classes(read_table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "class_id")


#: Fixed values of the contract.
URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge every page's URL."""
    return urls.judge(read_table(spark, sf_dir, "pages"), URL_RULES)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replicate all documents to source weights of volume ** 0.5, in a global random order."""
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every row whose id is divisible by 20, among all rows."""
    return ann.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_vecdup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every vector."""
    return vecdup.classes(read_table(spark, sf_dir, "embeddings"))


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compress every vector to four code bytes."""
    return gnat.compress(read_table(spark, sf_dir, "embeddings"))[0]


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Align the tokens of every document under two tokenizers."""
    return align.scored(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_chat": op2_chat,
    "op3_fingerprints": op3_fingerprints,
    "op4_toxicity": op4_toxicity,
    "op5_pii": op5_pii,
    "op6_neardup": op6_neardup,
    "op7_urls": op7_urls,
    "op8_mixing": op8_mixing,
    "op9_ann": op9_ann,
    "op10_bpe": op10_bpe,
    "op11_vecdup": op11_vecdup,
    "op12_codes": op12_codes,
    "op13_align": op13_align,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {"op1_secrets": secrets.scan_sql(), "op2_chat": chat.CHAT_SQL, "op8_mixing": mixing.MIX_SQL, "op11_vecdup": vecdup.CLASSES_SQL, "op12_codes": gnat.compress_sql()}
