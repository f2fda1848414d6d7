"""From raw documents to token sequences: five stages, each over all that the one before kept.

Language identification rejects what is in no language; SimHash keeps one document of each group of near copies; passages of 20 words and more
that came earlier are cut out; documents that hold benchmark passages go; what is left is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm import bpe, decontam, langid, rlz, simhash
from recordloom.operators.durable import drop_since, mark, new_folder
from recordloom.operators.spread import dealt

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Rows of an Arrow batch: of texts, the usual 10,000 are tens of megabytes in the JVM and in Python at once.
BATCH, ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000


def small_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches for the session that a stage runs in, unless the session has a setting of its own. ``run`` uses a session apart, so that its caller's stays as it is."""
    if spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, ROWS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; those without letters, or with hardly any score, go."""
    small_batches(docs.sparkSession)
    return langid.accepted(docs, langid.fit(docs)).select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles have a similarity of 0.8 or more."""
    small_batches(docs.sparkSession)
    return simhash.without_near_copies(docs).select(COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of windows of 20 words that start earlier too."""
    small_batches(docs.sparkSession)
    return rlz.stripped(docs).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaked."""
    small_batches(docs.sparkSession)
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and ids of each document."""
    small_batches(docs.sparkSession)
    import public_tokenizers

    coded = bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"), more=("ids",), most_known=40_000)
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids")


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("bpe", tokens),
]

#: SQL can't express the network or the similarity search; tests hold the rows against brute force.
ORACLE_SQL = None


def apart(spark: SparkSession) -> SparkSession:
    """A session of its own on the same cluster, with the settings of ``spark``."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if own.conf.isModifiable(name):
            own.conf.set(name, value)
    return own


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written to the shared folder and read again, and what it kept on the way there is deleted."""
    own = apart(spark)
    folder = new_folder(own, "pipeline")
    docs = dealt(own.read.parquet(f"{sf_dir}/documents.parquet"))
    for k, (name, stage) in enumerate(STAGES):
        since = mark(own)
        docs = stage(own, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = own.read.parquet(f"{folder}/{k}-{name}")
            drop_since(own, since)
    return docs
