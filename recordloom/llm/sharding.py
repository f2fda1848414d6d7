"""Sharding by jump consistent hashing, in DataFrame functions only.

Jump consistent hashing (Lamping and Veach, 2014) walks the jumps of a key: a key sits in the last jump
target below the number of shards, so a shard added at the end takes keys only into itself. No ring or
table is kept. One walk serves several shard counts.

The generator of the paper multiplies modulo 2**64; under ANSI arithmetic that would overflow, so the state is
held as two halves of 32 bits and multiplied in pieces that stay below 2**53.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the published algorithm: the multiplier of its linear congruential generator.
MULTIPLIER = 2862933555777941757
_LOW, _HIGH, _MASK = MULTIPLIER & 0xFFFFFFFF, MULTIPLIER >> 32, 0xFFFFFFFF
#: Jumps walked at most. A key makes about ln(shards) jumps; more than this many of them has no measurable chance
#: for any shard count that fits an int, and is an error, never a wrong shard.
MOST_JUMPS = 160


def _times(low: Column, high: Column) -> tuple[Column, Column]:
    """(high, low) * MULTIPLIER + 1 modulo 2**64, as halves."""
    p, q = low.bitwiseAND(0xFFFF) * _LOW, F.shiftright(low, 16) * _LOW
    t = p + F.shiftleft(q.bitwiseAND(0xFFFF), 16) + 1
    carry = F.shiftright(t, 32) + F.shiftright(q, 16)
    across = high.bitwiseAND(0xFFFF) * _LOW + F.shiftleft((F.shiftright(high, 16) * _LOW).bitwiseAND(0xFFFF), 16)
    over = low.bitwiseAND(0xFFFF) * _HIGH + F.shiftleft((F.shiftright(low, 16) * _HIGH).bitwiseAND(0xFFFF), 16)
    return t.bitwiseAND(_MASK), (carry + across.bitwiseAND(_MASK) + over.bitwiseAND(_MASK)).bitwiseAND(_MASK)


def jump_hash(key: Column, *shards: int) -> Column:
    """A struct s0, s1 … of the shard (int) of a long key for each of the shard counts. A null key counts as 0."""
    if not shards or min(shards) < 1:
        raise ValueError("shard counts must be positive")
    most = max(shards)
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    start = F.struct(
        key.bitwiseAND(_MASK).alias("low"), F.shiftrightunsigned(key, 32).alias("high"), F.lit(0).cast("long").alias("j"),
        *(F.lit(-1).cast("long").alias(f"s{i}") for i in range(len(shards))),
    )

    def walk(at: Column, _: Column) -> Column:
        low, high = _times(at["low"], at["high"])
        j = at["j"]
        landed = [F.when(j < n, j).otherwise(at[f"s{i}"]).alias(f"s{i}") for i, n in enumerate(shards)]
        step = F.floor((j + 1).cast("double") * (F.lit(2147483648.0) / (F.shiftright(high, 1) + 1).cast("double")))
        moved = F.struct(low.alias("low"), high.alias("high"), step.alias("j"), *landed)
        return F.when(j < most, moved).otherwise(at)

    jumps = min(most, MOST_JUMPS)
    end = F.aggregate(F.sequence(F.lit(1), F.lit(jumps)), start, walk)
    landed = [end[f"s{i}"].cast("int").alias(f"s{i}") for i in range(len(shards))]
    sure = F.when(end["j"] >= most, F.struct(*landed)) if most > MOST_JUMPS else F.struct(*landed)
    return F.coalesce(sure, F.raise_error(F.lit("more jumps than MOST_JUMPS")).cast(f"struct<{','.join(f's{i}:int' for i in range(len(shards)))}>")) if most > MOST_JUMPS else sure


#: Parts of a shard, by which its rows are numbered.
PARTS = 4096


def part_of(key: Column, more: Column) -> Column:
    """A number below PARTS: the first step of a key's walk, its upper bits, and some number besides, so that one key's rows are not all in one part."""
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    _, high = _times(key.bitwiseAND(_MASK), F.shiftrightunsigned(key, 32))
    return F.pmod(F.shiftright(high, 20) + more, F.lit(PARTS)).cast("int")


def slots(rows: DataFrame, group: str, part: str, order: list[str], out: str = "slot") -> DataFrame:
    """Gapless numbers from 0 within each ``group``, in order of (part, order), without sorting a group in one task.

    Rows are numbered within (group, part), and the counts of the parts before give the offset: a table of at most groups times parts rows, whatever the
    number of rows. Rows come out partitioned by (group, part), so the offsets join without moving them again. Rows equal in all
    order columns share a part and get consecutive numbers.
    """
    sizes = rows.groupBy(group, part).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(group, part, F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long")).alias("_before"))
    inside = Window.partitionBy(group, part).orderBy(*order)
    numbered = rows.withColumn("_nth", F.row_number().over(inside).cast("long") - 1)
    return numbered.join(offsets, [group, part]).withColumn(out, F.col("_before") + F.col("_nth")).drop("_nth", "_before")


def shard(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``key``: the shard depends on the key and the number of shards alone, and with one more shard a row
    stays or goes to the new one. The slot numbers a shard's rows by (part, key, size, checksum); see ``part_of``. size: UTF-8 bytes of the text (null: none) plus 8. A null text has the checksum of the empty
    text. A null key is hashed as 0 and kept. Repeated rows share a shard and get slots of their own. Extra columns are not read. An empty
    table gives no rows.
    """
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(key).alias("key"), (F.octet_length(raw).cast("long") + 8).alias("size"), F.crc32(raw).cast("long").alias("text_crc32"),
        jump_hash(F.col(key), shards, shards + 1).alias("to"),
    )
    rows = rows.select("key", "size", "text_crc32", F.lit("key").alias("law"), F.col("to.s0").alias("shard"), F.col("to.s1").alias("grown_shard"), part_of(F.col("key"), F.col("text_crc32")).alias("part"))
    placed = slots(rows, "shard", "part", ["key", "size", "text_crc32"])
    return placed.select(F.col("key").alias(key), "size", "text_crc32", "law", "shard", "slot", "grown_shard")
