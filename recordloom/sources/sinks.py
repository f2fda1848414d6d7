"""Writers: nested JSON, partitions in place, playlists, CSV, reports and review queues."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nested(tracks: DataFrame, by: list[str], order: str, name: str = "tracks") -> DataFrame:
    """Rows gathered into one array of structs for each key, in order."""
    fields = [c for c in tracks.columns if c not in by and c != order]
    return tracks.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, *fields))), lambda x: F.struct(*(x[f].alias(f) for f in fields))).alias(name))


def write_json(rows: DataFrame, path: str) -> None:
    """One JSON object a line. Written whole beside ``path`` and then renamed into its place, so a run that is killed leaves the files of before, under their name or, between the
    two renames, under it with ``.old`` behind. Where the store renames by copying (object stores), the second rename is not one step."""
    spark, aside = rows.sparkSession, f"{path.rstrip('/')}.{uuid.uuid4().hex}.tmp"
    rows.write.json(aside)
    at = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    store, old = at(path).getFileSystem(spark._jsc.hadoopConfiguration()), f"{path.rstrip('/')}.old"
    store.delete(at(old), True)
    if store.exists(at(path)) and not store.rename(at(path), at(old)):
        raise OSError(f"{path} could not be moved aside")
    if not store.rename(at(aside), at(path)):
        store.rename(at(old), at(path))
        raise OSError(f"{aside} could not be renamed to {path}")
    store.delete(at(old), True)


def write_partitions(rows: DataFrame, path: str, by: str) -> None:
    """Only the partitions that ``rows`` holds are replaced."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def playlist_text(url: Column, date: Column, title: Column, note: Column, entries: Column) -> Column:
    """A playlist file: the header lines there are, an empty line, the entries."""
    line = lambda name, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"{name}: "), c))
    head = F.concat_ws("\n", line("url", url), line("date", date), line("title", title), line("note", note))
    return F.concat(head, F.lit("\n\n"), F.array_join(entries, "\n"), F.lit("\n"))


def csv_ready(rows: DataFrame) -> DataFrame:
    """Array columns joined by "; "."""
    kinds = dict(rows.dtypes)
    return rows.select(*(F.array_join(c, "; ").alias(c) if kinds[c].startswith("array<string") else c for c in rows.columns))


def write_csv(rows: DataFrame, path: str) -> None:
    csv_ready(rows).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def review_queue(rows: DataFrame, doubt: Column, order: list[Column]) -> DataFrame:
    """The doubtful rows with why, sorted for a person to go through."""
    return rows.withColumn("doubt", doubt).where("doubt is not null").orderBy(*order)


def named_list(values: Column, most: int = 3) -> Column:
    """«a», «b», «c» and 2 more."""
    shown = F.array_join(F.transform(F.slice(values, 1, most), lambda v: F.concat(F.lit("«"), v, F.lit("»"))), ", ")
    return F.when(F.size(values) > most, F.concat(shown, F.format_string(" and %d more", F.size(values) - most))).otherwise(shown)
