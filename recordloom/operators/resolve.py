"""Entity resolution against a catalogue: block by equal keys, verify the candidates, decide by what is left."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .durable import keep


def blocked(left: DataFrame, right: DataFrame, left_keys: str, right_keys: str, left_id: str, right_id: str) -> DataFrame:
    """Candidates: pairs of rows that share a key of their array columns, each pair once. An inverted index as an equality join.

    Spark's partition of a very common key can be split; drop keys that say nothing (stop words, empty ones) before.
    """
    a = left.select("*", F.explode(F.array_distinct(left_keys)).alias("_key"))
    b = right.select("*", F.explode(F.array_distinct(right_keys)).alias("_key"))
    return a.join(b, "_key").drop("_key").dropDuplicates([left_id, right_id])


def classes(rows: DataFrame, matches: DataFrame, key: str, ready: Column, compilation: Column, same_group: str) -> DataFrame:
    """(key, class, match): one verdict a row.

    ``matches``: (key, match, <same_group>). Not ready: ``none_to_match``; no match: ``compilation`` if it looks like one, else ``unmatched``; matches of one group
    are duplicates, the lowest id wins; of several groups: ``ambiguous``.
    """
    found = matches.groupBy(key).agg(F.count_distinct(same_group).alias("_groups"), F.min("match").alias("match"))
    judged = rows.join(found, key, "left")
    kind = (
        F.when(~ready, "none_to_match").when(F.col("_groups") == 1, "matched").when(F.col("_groups") > 1, "ambiguous").when(compilation, "compilation").otherwise("unmatched")
    )
    return judged.select(key, kind.alias("class"), F.when(kind == "matched", F.col("match")).alias("match"))


def unique_parts(rows: DataFrame, key: str, parts: str) -> DataFrame:
    """(part, key): the parts that one row alone has; a part of two rows tells nothing."""
    each = rows.select(key, F.explode(F.array_distinct(parts)).alias("part"))
    return each.groupBy("part").agg(F.count(F.lit(1)).alias("_n"), F.min(key).alias(key)).where("_n = 1").select("part", key)


def staged(rows: DataFrame, key: str, stages: list[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Fallbacks: each stage, a function of the rows no earlier one answered, gives (key, …); its name goes with it as ``stage``."""
    left, out = rows, None
    for number, stage in enumerate(stages, 1):
        found = stage(left).withColumn("stage", F.lit(number))
        out = found if out is None else out.unionByName(found)
        left = left.join(found.select(key), key, "left_anti")
    return out


#: Rounds after which ``settled`` ends, a fixed value of the procedure.
ROUNDS = 5


def settled(candidates: DataFrame, key: str, name: str, owner: str, rounds: int = ROUNDS, whole: bool = False) -> DataFrame:
    """(key, owner, round): namesakes told apart by what is known already, round by round.

    ``candidates``: (key, name, owner): the owners that a key could belong to under a name. A key with one candidate is settled. Then, of a key's
    candidates, those count that some settled key of that name has; if exactly one does, the key is settled too. It ends when a round settles
    nothing, or after ``rounds``, as the procedure has it; with ``whole`` that is an error unless nothing more could be settled. Each round is written to the shared folder.
    """
    only = Window.partitionBy(key)
    pairs = keep(candidates.select(key, name, owner).distinct())
    done = keep(pairs.withColumn("_n", F.count(F.lit(1)).over(only)).where("_n = 1").select(key, name, owner, F.lit(0).alias("round")))
    for number in range(1, rounds + 1 + whole):
        known = done.select(name, owner).distinct()
        open_ = pairs.join(done.select(key), key, "left_anti").join(known, [name, owner])
        new = keep(open_.withColumn("_n", F.count(F.lit(1)).over(only)).where("_n = 1").select(key, name, owner, F.lit(number).alias("round")))
        if new.isEmpty():
            return done
        if number > rounds:
            raise RuntimeError(f"namesakes are not settled after {rounds} rounds")
        done = keep(done.unionByName(new))
    return done


def resolved_year(current: Column, found: Column, aired: Column, near: int = 1, far: int = 10) -> Column:
    """What to do about a year found elsewhere: ``take`` it if there is none or it is a little earlier, ``ask`` about large gaps, ``nothing`` else."""
    gap = current - found
    return F.when(found.isNull() | (found > aired), "nothing").when(current.isNull(), "take").when(gap.between(1, near), "nothing").when(gap > far, "ask").when(gap > near, "take").otherwise("nothing")
