"""Counts, votes and agreement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .pick import first_rows


def mode_or_null(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """Each group's commonest value and its count; the value is null if another is as common. Null values don't count."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    # the two largest counts of a group decide; both are plain aggregates
    top = counts.groupBy(*by).agg(F.max(F.struct("n", value)).alias("_top"), F.max("n").alias("n"))
    tied = counts.join(top.select(*by, "n"), [*by, "n"], "left_semi").groupBy(*by).agg(F.count(F.lit(1)).alias("_ties"))
    return top.join(tied, by).select(*by, F.when(F.col("_ties") == 1, F.col(f"_top.{value}")).alias(value), "n")


def commonest(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """Each group's commonest value, the first in order of equals, with its count."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*by).agg(F.min(F.struct((-F.col("n")).alias("m"), F.col(value))).alias("_top")).select(*by, F.col(f"_top.{value}").alias(value), (-F.col("_top.m")).alias("n"))


def votes(rows: DataFrame, by: list[str], value: str, voter: str) -> DataFrame:
    """How many different voters name each value, with its place in the group."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count_distinct(voter).alias("votes"))
    return counts.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("votes"), F.asc(value))))


def bucket(value: Column, bounds: list[tuple[str, int]]) -> Column:
    """The label of the first bound that the value doesn't exceed; the last label is for all beyond."""
    out = None
    for label, most in bounds[:-1]:
        out = F.when(value <= most, label) if out is None else out.when(value <= most, label)
    return out.otherwise(bounds[-1][0])


def histogram(rows: DataFrame, label: Column, labels: list[str]) -> DataFrame:
    """(place, label, n) for every label, those without rows too."""
    all_ = F.explode(F.array(*(F.struct(F.lit(i).cast("long").alias("place"), F.lit(x).alias("label")) for i, x in enumerate(labels))))
    dimension = rows.sparkSession.range(1).select(all_.alias("x")).select("x.*")
    counts = rows.select(label.alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return dimension.join(counts, "label", "left").select("place", "label", F.coalesce("n", F.lit(0)).alias("n"))


def class_counts(rows: DataFrame, by: str, tests: dict[str, Column], total: str = "all") -> DataFrame:
    """Counts of rows and of those that pass each test, per group and in total."""
    counts = [F.count(F.lit(1)).alias("n"), *(F.count_if(t).alias(name) for name, t in tests.items())]
    rolled = rows.rollup(by).agg(F.grouping(by).alias("_all"), *counts)
    return rolled.select(F.when(F.col("_all") == 1, total).otherwise(F.col(by)).alias(by), "n", *tests)


def dominant(rows: DataFrame, by: list[str], value: str, least: int = 3, times: int = 3) -> DataFrame:
    """The value of each group that has ``least`` rows and ``times`` as many as all others together, if any has."""
    counts = rows.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    others = F.sum("n").over(Window.partitionBy(*by)) - F.col("n")
    return counts.withColumn("others", others).where((F.col("n") >= least) & (F.col("n") >= times * F.col("others")))


def agreement(lists: DataFrame, key: str, kind: str, items: str, pairs: list[tuple[str, str]]) -> DataFrame:
    """For each listed pair of kinds: keys that have both, and how many agree, differ in count, in order only, or in items.

    ``items``: an array column. Lists are joined by key with the pairs, so nothing but same-key lists ever meets.
    """
    wanted = F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs)))
    one = lists.select(key, F.col(kind).alias("a"), F.col(items).alias("x"))
    two = lists.select(key, F.col(kind).alias("b"), F.col(items).alias("y"))
    both = one.select("*", wanted.alias("pair")).where("a = pair.a").select(key, "a", F.col("pair.b").alias("b"), "x").join(two, [key, "b"])
    x, y = F.col("x"), F.col("y")
    found = (
        F.when(F.size(x) != F.size(y), "count").when(x == y, "agree").when(F.array_sort(x) == F.array_sort(y), "order").otherwise("items")
    )
    kinds = ("agree", "count", "order", "items")
    counted = both.select("a", "b", found.alias("kind")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("compared"), *(F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in kinds))
    return counted.withColumn("percent", F.floor(100 * F.col("n_agree") / F.col("compared") + 0.5))


def accuracy(rows: DataFrame, by: list[str], found: str, known: str, same_group: Column) -> DataFrame:
    """Of rows with a known answer: how many were found the same, the same group, another, or none."""
    f, k = F.col(found), F.col(known)
    kind = F.when(f.isNull(), "none").when(f == k, "same").when(same_group, "same_group").otherwise("other")
    return rows.where(k.isNotNull()).groupBy(*by).agg(*(F.count_if(kind == name).alias(name) for name in ("same", "same_group", "other", "none")))


def top(rows: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    return first_rows(rows, by, order, n)
