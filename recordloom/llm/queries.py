"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.spread import dealt


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return dealt(spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def _vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    return near_duplicates(_read(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard

    return shard(_read(spark, sf_dir, "documents"), 24)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import read, write

    return read(write(_read(spark, sf_dir, "pages"))).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .rlz import deduplicate

    return deduplicate(_read(spark, sf_dir, "documents"), full=False)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import encode_decode

    return encode_decode(_read(spark, sf_dir, "documents"), _vocabulary(), more=())


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import count_tokens

    return count_tokens(_read(spark, sf_dir, "documents"), _vocabulary())


def op7_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .flac import probe, store

    return probe(store(_read(spark, sf_dir, "documents")))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import contaminated

    return contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import fit, identify

    docs = _read(spark, sf_dir, "documents")
    return identify(docs, fit(docs))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix import deduplicate

    return deduplicate(_read(spark, sf_dir, "documents"), full=False)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    from . import oracles

    return {"op1_simhash": oracles.SIMHASH, "op8_decontamination": oracles.LEAKS, "op2_sharding": oracles.SHARDING, "op3_warc": oracles.WARC, "op4_substring_dedup": oracles.SUBSTRINGS, "op10_suffix_dedup": oracles.SUFFIXES}
