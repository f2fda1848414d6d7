"""Joins and numberings that stay spread out when a key is very common."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .durable import keep

#: Bytes that a core should have to read: what Spark itself reckons a file to cost besides its bytes.
LEAST = 4 << 20


def dealt(rows: DataFrame) -> DataFrame:
    """The rows of an input that is too small to occupy all cores, dealt out over them; those of any other as they are.

    A row group of Parquet is one task, so a file of a few megabytes would leave all cores but one idle; moving so little costs less than that.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return rows.repartition(cores) if size < cores * LEAST else rows


#: Characters, as JSON, up to which ``few`` broadcasts a table.
FEW = 4 << 20


def few(rows: DataFrame) -> DataFrame:
    """``rows`` written down, and broadcast if they turn out small. Spark's own estimate of distinct values is the size of the table they come from."""
    kept = keep(rows)
    size = kept.agg(F.sum(F.length(F.to_json(F.struct(*kept.columns))))).first()[0]
    return F.broadcast(kept) if (size or 0) <= FEW else kept


def apart(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` on ``keys`` (never null), both sides shuffled anew by a hash of the keys.

    Where one side comes from an aggregate by the same keys, Spark keeps that partitioning, and then it can't split a partition in which
    a key has very many rows. With a shuffle of its own on each side it can. The keys themselves are compared as a residual condition, so
    a collision of hashes joins nothing.
    """
    one = left.withColumn("_hash", F.xxhash64(*keys))
    two = right.select(F.xxhash64(*keys).alias("_hash2"), *(F.col(k).alias(f"_same_{k}") for k in keys), *(c for c in right.columns if c not in keys))
    condition = F.col("_hash") == F.col("_hash2")
    for k in keys:
        condition &= (F.col(k) >= F.col(f"_same_{k}")) & (F.col(k) <= F.col(f"_same_{k}"))
    return one.join(two, condition, how).drop("_hash", "_hash2", *(f"_same_{k}" for k in keys))


def numbered(rows: DataFrame, by: list[str], order: list[Column], out: str) -> DataFrame:
    """Adds gapless numbers from 0 in ``order`` within each group, and ``<out>_of``, the group's size, however few and large the groups are.

    Rows are partitioned by ranges of (group, order), which is written down; they are numbered within each range, and the counts of the
    ranges before give the offset. No task sorts a whole group. ``order`` must be unique within a group.
    """
    placed = keep(rows.repartitionByRange(*by, *order).withColumn("_range", F.spark_partition_id()))
    counts = placed.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumns({"_before": F.coalesce(F.sum("_n").over(before), F.lit(0)), f"{out}_of": F.sum("_n").over(Window.partitionBy(*by))}).drop("_n")
    inside = Window.partitionBy(*by, "_range").orderBy(*order)
    renamed = offsets.withColumnsRenamed({c: f"_by_{c}" for c in [*by, "_range"]})
    same = None
    for c in [*by, "_range"]:
        equal = F.col(c).eqNullSafe(F.col(f"_by_{c}"))
        same = equal if same is None else same & equal
    joined = placed.withColumn("_nth", F.row_number().over(inside) - 1).join(renamed, same)
    return joined.withColumn(out, (F.col("_before") + F.col("_nth")).cast("long")).drop("_range", "_nth", "_before", *(f"_by_{c}" for c in [*by, "_range"]))
