"""Incremental merging: what changed, what is carried over, what must be asked again.

"Never asked" and "asked, not found" are two things. A value column has a flag column ``asked_<value>``: false and null, true and
null, true and a value are the three states.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def content_hash(*columns: str) -> Column:
    """The first 16 hexadecimal digits of SHA-256 of the columns, parted by line feeds; null is like ''."""
    return F.substring(F.sha2(F.concat_ws("\n", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)), 256), 1, 16)


def changes(stored: DataFrame, now: DataFrame, key: str, mark: str) -> DataFrame:
    """(key, change): rows that are ``new``, ``edited`` or ``gone``; unchanged ones are left out. Only keys and hashes move."""
    a, b = stored.select(key, F.col(mark).alias("_old")), now.select(key, F.col(mark).alias("_new"))
    kind = F.when(F.col("_old").isNull(), "new").when(F.col("_new").isNull(), "gone").when(F.col("_old") != F.col("_new"), "edited")
    return a.join(b, key, "full").select(key, kind.alias("change")).where("change is not null")


def merged(stored: DataFrame, now: DataFrame, key: str, carried: list[str]) -> DataFrame:
    """``now`` drives: its rows, with the ``carried`` columns of the stored row of that key. Stored rows without a new one drop out."""
    return now.drop(*carried).join(stored.select(key, *carried), key, "left")


def keep_answers(now: DataFrame, before: DataFrame, keys: list[str], answers: list[str], order: str) -> DataFrame:
    """Answers found under the same names, null names alike, go on; of several old rows the last in ``order`` counts. Else nothing was asked yet."""
    last = before.groupBy(*keys).agg(F.max_by(F.struct(*answers, *(f"asked_{a}" for a in answers)), order).alias("_last"))
    condition = None
    renamed = last
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"_{k}")
        equal = now[k].eqNullSafe(F.col(f"_{k}"))
        condition = equal if condition is None else condition & equal
    joined = now.join(renamed, condition, "left")
    for a in answers:
        joined = joined.withColumn(a, F.col(f"_last.{a}")).withColumn(f"asked_{a}", F.coalesce(F.col(f"_last.asked_{a}"), F.lit(False)))
    return joined.drop("_last", *(f"_{k}" for k in keys))


def forgotten(rows: DataFrame, answer: str, when: Column) -> DataFrame:
    """The answer is asked for again where the condition holds."""
    return rows.withColumn(answer, F.when(~F.coalesce(when, F.lit(False)), F.col(answer))).withColumn(f"asked_{answer}", F.col(f"asked_{answer}") & ~F.coalesce(when, F.lit(False)))


def missed(answer: str) -> Column:
    return F.col(f"asked_{answer}") & F.col(answer).isNull()


def needs(answer: str, after: list[str] | None = None) -> Column:
    """Not asked yet, and all that must come first has been asked."""
    out = ~F.col(f"asked_{answer}")
    for other in after or []:
        out &= F.col(f"asked_{other}")
    return out


def shaped(rows: DataFrame, columns: list[str], anchors: dict[str, str]) -> DataFrame:
    """The columns in order; a dependent one is null where its anchor is."""
    return rows.select(*(F.when(F.col(anchors[c]).isNotNull(), F.col(c)).alias(c) if c in anchors else c for c in columns))


def matching(rows: DataFrame, pattern: str, columns: list[str]) -> DataFrame:
    """Rows whose columns, parted by line feeds and null as '', hold the pattern."""
    return rows.where(F.concat_ws("\n", *(F.coalesce(F.col(c), F.lit("")) for c in columns)).rlike(pattern))
