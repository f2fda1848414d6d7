"""Incremental reading as a stream that stops: only files not seen before are processed, state is kept in a checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import content_hash


def new_files(spark: SparkSession, path: str, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    """Calls ``each`` with (path, value) of the text files that came since the last call, and returns when all there are have been handled."""
    stream = spark.readStream.format("text").option("wholetext", True).load(path).select(F.col("_metadata.file_path").alias("path"), "value")
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def pending(now: DataFrame, stored: DataFrame, key: str, text: str, limit: int | None = None, first: Callable | None = None) -> DataFrame:
    """Rows whose text is new or edited since ``stored`` (key, mark) was made. ``limit`` is a feature of a run: so many at once, the row ``first`` selects before all."""
    marked = now.withColumn("mark", content_hash(text))
    open_ = marked.join(stored.select(key, "mark"), [key, "mark"], "left_anti")
    if limit is None:
        return open_
    order = ([F.desc(first(open_).cast("int"))] if first else []) + [F.col(key)]
    return open_.orderBy(*order).limit(limit)


def readable_again(rows: DataFrame, texts: DataFrame, key: str, field: str, limit: int) -> DataFrame:
    """Keys whose stored rows lack ``field`` and whose text is still the one they were parsed from, ``limit`` at most; others would mix two versions."""
    lacking = rows.where(F.col(field).isNull()).select(key, "mark").distinct()
    return lacking.join(texts.select(key, content_hash("text").alias("mark")), [key, "mark"], "left_semi").select(key).orderBy(key).limit(limit)


def unfiled(found: DataFrame, filed: DataFrame, source: str, key: str) -> DataFrame:
    """Rows of ``found`` to be filed: of sources of which fewer are filed than were found, and under keys that are free. What is filed is never written over, so filing again does nothing."""
    done = filed.groupBy(source).agg(F.count(F.lit(1)).alias("_filed"))
    many = found.groupBy(source).agg(F.count(F.lit(1)).alias("_found"))
    open_ = many.join(done, source, "left").where(F.col("_found") > F.coalesce("_filed", F.lit(0))).select(source)
    return found.join(open_, source, "left_semi").join(filed.select(key).distinct(), key, "left_anti")


def remembered(known: DataFrame, wanted: DataFrame, key: str, find: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Answers to all of ``wanted``'s keys: those of ``known`` (key, …) as they are, and those that ``find`` gives for the others, asked once each."""
    asked = wanted.select(key).distinct()
    new = find(asked.join(known.select(key), key, "left_anti"))
    return known.join(asked, key, "left_semi").unionByName(new.select(known.columns))
