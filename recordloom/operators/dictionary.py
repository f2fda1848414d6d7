"""Spelling dictionaries and rule lists. These are small dimension tables kept by hand; Spark broadcasts them when they are below its threshold."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def restored(rows: DataFrame, column: str, table: DataFrame) -> DataFrame:
    """``column`` by an exact spelling table (spelling, name), else as it is; ``was_restored`` tells which."""
    names = table.select(F.col("spelling").alias(column), F.col("name").alias("_name"))
    joined = rows.join(names, column, "left")
    return joined.withColumn("was_restored", F.col("_name").isNotNull() & (F.col("_name") != F.col(column))).withColumn(column, F.coalesce("_name", column)).drop("_name")


def whole_or_parts(values: DataFrame, key: str, table: DataFrame, separators: str) -> DataFrame:
    """(key, codes, status) of each distinct key: the codes of the whole key, else of all its parts in order, each once.

    ``table``: (spelling, codes array or null). status is ``whole``, ``parts``, ``unmapped`` (a part is unknown; no codes) or ``placeholder`` (all is known
    and none has a code).
    """
    keys = values.select(key).where(F.col(key).isNotNull()).distinct()
    whole = keys.join(table.select(F.col("spelling").alias(key), F.col("codes"), F.lit(True).alias("_hit")), key, "left")
    parts = whole.where("_hit is null").select(key, F.posexplode(F.filter(F.split(key, separators), lambda x: F.trim(x) != "")).alias("_pos", "_part"))
    looked = parts.select(key, "_pos", F.trim("_part").alias("spelling")).join(table.withColumn("_hit", F.lit(True)), "spelling", "left")
    ordered = F.array_sort(F.collect_list(F.struct("_pos", F.coalesce("codes", F.array().cast("array<string>")).alias("codes"))))
    joined = looked.groupBy(key).agg(F.bool_and(F.col("_hit").isNotNull()).alias("_every"), F.flatten(F.transform(ordered, lambda x: x["codes"])).alias("codes"))
    found = whole.drop("codes").join(joined, key, "left").join(table.select(F.col("spelling").alias(key), F.col("codes").alias("_whole")), key, "left")
    codes = F.array_distinct(F.when(F.col("_hit"), F.coalesce("_whole", F.array().cast("array<string>"))).when(F.col("_every"), F.col("codes")))
    status = F.when(F.coalesce(F.size(codes), F.lit(-1)) == 0, "placeholder").when(F.col("_hit"), "whole").when(F.col("_every"), "parts").otherwise("unmapped")
    return found.select(key, F.when(F.size(codes) > 0, codes).alias("codes"), status.alias("status"))


def vague(codes: Column, status: Column, wide: str = "EU") -> Column:
    """Says too little: only placeholders, or nothing but the wide code."""
    return (status == "placeholder") | F.coalesce(F.forall(codes, lambda c: c == wide), F.lit(False))


def closure(table: DataFrame, most: int = 8) -> DataFrame:
    """(spelling, name): every spelling of (spelling, name or null) followed to the names it ends at.

    A name that maps to itself, to a spelling on its own path, or on nothing ends; one that maps to null gives no row. Paths of more than ``most`` steps are an error.
    """
    edges = table.select(F.col("spelling").alias("_from"), F.col("name").alias("_to"), F.lit(True).alias("_known"))
    at = table.select("spelling", F.col("name").alias("at"), F.array("spelling").alias("path"))
    ended = []
    for _ in range(most):
        step = at.where("at is not null").join(edges, F.col("at") == F.col("_from"), "left")
        done = F.col("_known").isNull() | F.array_contains("path", F.col("at"))
        ended.append(step.where(done).select("spelling", F.col("at").alias("name")))
        at = step.where(~done).select("spelling", F.col("_to").alias("at"), F.array_append("path", F.col("at")).alias("path"))
    left = at.where("at is not null").select("spelling", F.raise_error(F.lit("a dictionary path is too long")).cast("string").alias("name"))
    return reduce(DataFrame.unionByName, [*ended, left]).distinct()


def same(a: Column, b: Column) -> Column:
    """Equal but for case and spaces around; null is like ''."""
    return F.lower(F.trim(F.coalesce(a, F.lit("")))) == F.lower(F.trim(F.coalesce(b, F.lit(""))))


def rules_last_wins(rows: DataFrame, rules: DataFrame, row_id: str, keys: list[str], required: str, fields: list[str]) -> DataFrame:
    """Every rule that fits a row as it came sets the fields that it has; of several the last in ``pos`` wins, field by field.

    A rule fits if ``required`` is equal and each other key is equal or not given. ``rules``: pos, the keys, and set_<field> columns, null where not set.
    """
    low = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    left = rows.select(row_id, *(F.col(k).alias(f"_{k}") for k in keys), low(F.col(required)).alias("_block"))
    right = rules.withColumn("_block", low(F.col(required)))
    hits = left.join(right, "_block")
    for k in keys:
        if k != required:
            hits = hits.where(F.col(k).isNull() | same(F.col(k), F.col(f"_{k}")))
    last = [F.max_by(f"set_{f}", F.when(F.col(f"set_{f}").isNotNull(), F.col("pos"))).alias(f"_new_{f}") for f in fields]
    won = hits.groupBy(row_id).agg(*last, F.count(F.lit(1)).alias("rules_applied"))
    out = rows.join(won, row_id, "left")
    for f in fields:
        out = out.withColumn(f, F.coalesce(f"_new_{f}", f)).drop(f"_new_{f}")
    return out.withColumn("rules_applied", F.coalesce("rules_applied", F.lit(0)))


def rules_first_match(rows: DataFrame, rules: DataFrame, row_id: str, keys: list[str]) -> DataFrame:
    """The first rule in ``pos`` that names a row by all keys it gives, as printed or as restored, and at least one as printed; its restored values are set.

    ``rules``: pos, the keys as printed and to_<key> columns, null where nothing is restored. A rule meets a row by one key at a time, so each
    meeting is an equality join; ``match_pos`` is the rule that won.
    """
    low = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    left = rows.select(row_id, *(low(F.col(k)).alias(f"_{k}") for k in keys))
    right = rules.select("pos", *(F.when(F.col(k).isNotNull(), low(F.col(k))).alias(f"p_{k}") for k in keys), *(F.when(F.col(f"to_{k}").isNotNull(), low(F.col(f"to_{k}"))).alias(f"r_{k}") for k in keys))
    met = reduce(DataFrame.unionByName, [left.join(right, F.col(f"_{k}") == F.col(f"p_{k}")) for k in keys])
    for k in keys:
        met = met.where(F.col(f"p_{k}").isNull() | (F.col(f"_{k}") == F.col(f"p_{k}")) | F.coalesce(F.col(f"_{k}") == F.col(f"r_{k}"), F.lit(False)))
    won = met.groupBy(row_id).agg(F.min("pos").alias("match_pos"))
    out = rows.join(won, row_id, "left").join(rules.select(F.col("pos").alias("match_pos"), *(f"to_{k}" for k in keys)), "match_pos", "left")
    for k in keys:
        out = out.withColumn(k, F.coalesce(f"to_{k}", k)).drop(f"to_{k}")
    return out


def grown(table: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The dictionary with the entries of ``new`` whose key it lacks; no entry is ever changed."""
    return table.unionByName(new.join(table, key, "left_anti").select(table.columns)).orderBy(key)
