"""Survivorship: which of several candidate rows, or of several sources' values, wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best(rows: DataFrame, key: str | list[str], rank: list[Column], keep: list[str]) -> DataFrame:
    """For each key the row that is least by ``rank``, as one aggregate (no sort, combined before the shuffle).

    ``rank`` must end in a unique column, or ties are settled by the kept values.
    """
    keys = [key] if isinstance(key, str) else key
    # parts of the rank are named apart from the kept columns
    parts = [c.alias(f"_r{i}") for i, c in enumerate(rank)]
    won = rows.groupBy(*keys).agg(F.min(F.struct(*parts, *keep)).alias("_won"))
    return won.select(*keys, *(F.col(f"_won.{c}").alias(c) for c in keep))


def first_rows(rows: DataFrame, by: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each group; Spark prunes each task's rows before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def precedence(value: Column, source: Column, order: list[str]) -> Column:
    """As an aggregate: the value of the source that comes first in ``order``; null values and other sources don't count. The least of equals wins."""
    rank = F.array_position(F.array(*(F.lit(s) for s in order)), source)
    return F.min(F.when(value.isNotNull() & (rank > 0), F.struct(rank.alias("rank"), value.alias("value"), source.alias("source"))))


def not_after(year: Column, limit: Column) -> Column:
    """The year, or null if it is later than the limit."""
    return F.when(year <= limit, year)


def guarded_list(lists: DataFrame, key: str, kind: str, size: str, order: list[str], databases: list[str], slack: int = 1) -> DataFrame:
    """For each key the first kind in ``order`` whose list is no more than ``slack`` shorter than the longest.

    Lists of ``databases`` always qualify and never count as the longest. If none qualifies the first kind is taken.
    """
    known = lists.withColumn("_rank", F.array_position(F.array(*(F.lit(k) for k in order)), F.col(kind)))
    base = F.col(kind).isin(databases)
    longest = F.coalesce(F.max(F.when(~base, F.col(size))).over(Window.partitionBy(key)), F.lit(0))
    fits = base | (F.col(size) >= longest - slack)
    ranked = known.withColumn("_misses", F.when(fits, 0).otherwise(1))
    return first_rows(ranked, [key], [F.col("_misses"), F.col("_rank"), F.col(kind)]).drop("_rank", "_misses")


def fullest(rows: DataFrame, by: list[str], size: str, label: str) -> DataFrame:
    """Of several lists of one kind the longest, the first label of equals."""
    return first_rows(rows, by, [F.desc(size), F.asc(label)])


def release_rank(r: Column) -> list[Column]:
    """The order in which catalogue releases are preferred: official, no compilation or reissue, with a master, early, low id."""
    return [
        F.coalesce(r["unofficial"], F.lit(False)).cast("int"), (F.coalesce(r["compilation"], F.lit(False)) | F.coalesce(r["reissue"], F.lit(False))).cast("int"),
        r["master"].isNull().cast("int"), F.coalesce(r["year"], F.lit(9999)), r["id"],
    ]


def release_year(r: Column, master_year: Column) -> Column:
    """The year a release vouches for: its own, a reissue's by its master, none of a compilation or an unofficial one."""
    none = F.coalesce(r["compilation"], F.lit(False)) | F.coalesce(r["unofficial"], F.lit(False))
    year = F.when(none, F.lit(None)).when(F.coalesce(r["reissue"], F.lit(False)), master_year).otherwise(r["year"])
    return F.when(year > 1800, year)
