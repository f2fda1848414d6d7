"""Anchored segments: the part of finding repeated windows that both substring operators share.

Every window of ``width`` units (words or bytes) has an anchor, the leftmost of its grams of ``gram`` units with the least
hash. The choice depends on the window alone, so equal windows have equal anchors at equal places, wherever they stand.
Consecutive windows with one anchor form a *segment*, the units they cover. Two facts make the work sparse and exact:

* a window has equals elsewhere only if its anchor's hash has, and anchors are few (about 2 per width - gram + 2 units);
* segments of equal content have all windows in common, so only segments that share an anchor and differ need a closer look.

A segment row is (anchor, content, did, tag, place): two hashes, the document and ``place``, a long that packs the first
window's index (48 bits) and the number of windows (15 bits). A row is told apart by (did, tag): the tag is 0, but for rows that share
an id (or have none) and differ in their texts, which ``texts`` numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.durable import keep
from ..operators.spread import apart, numbered
from .textscan import SLICE_BYTES, by_bytes, leftmost_minima, mix, packed, released, spans

#: A null document id counts as this one, before all others.
NO_ID = -(2**63)
#: Bits of ``place`` that hold the number of windows.
MANY_BITS = 15
_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n, kept by the process."""
    if "up" not in _powers or len(_powers["up"]) < n:
        m = max(n, 1 << 16)
        for name, base in (("up", int(_BASE)), ("down", pow(int(_BASE), -1, 1 << 64))):
            p = np.full(m, base, np.uint64)
            p[0] = 1
            _powers[name] = np.cumprod(p, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


class Rolling:
    """Hashes of any run of units from prefix sums modulo 2**64."""

    def __init__(self, units: np.ndarray) -> None:
        up, self.down = powers(len(units) + 1)
        self.sums = np.zeros(len(units) + 1, np.uint64)
        np.cumsum(units * up[:-1], dtype=np.uint64, out=self.sums[1:])

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        size = (ends - starts).astype(np.uint64)
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + size)

    def grams(self, width: int) -> np.ndarray:
        """The hash of every run of ``width`` units."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[width:] - self.sums[:n]) * self.down[:n] + np.uint64(width))


def segments(units: np.ndarray, first: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """(document, first window, windows, anchor hash, content hash) of each segment; windows count from the document's start."""
    rolling = Rolling(units)
    n = len(units) - width + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    grams = rolling.grams(gram)
    least = leftmost_minima(grams, width - gram + 1)
    size = np.diff(first)
    ends = np.repeat(first[1:], size)  # of the document of each unit
    whole = np.arange(n) + width <= ends[:n]
    at = np.flatnonzero(whole)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    new = np.ones(len(at), bool)
    new[1:] = (least[at[1:]] != least[at[:-1]]) | (at[1:] != at[:-1] + 1)
    head = np.flatnonzero(new)
    start, many = at[head], np.diff(np.append(head, len(at)))
    doc = np.searchsorted(first, start, "right") - 1
    return doc, start - first[doc], many, grams[least[start]], rolling.runs(start, start + many - 1 + width)


def pack(start: np.ndarray, many: np.ndarray) -> np.ndarray:
    return (start.astype(np.int64) << MANY_BITS) | many.astype(np.int64)


def start_of(place: Column) -> Column:
    return F.shiftright(place, MANY_BITS)


def windows_of(place: Column) -> Column:
    return place.bitwiseAND((1 << MANY_BITS) - 1)


Units = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def scanner(units: Units, width: int, gram: int, limit: int = SLICE_BYTES):
    """A mapInArrow function: (did, tag, raw binary) to segment rows. ``units``: bytes and offsets to unit hashes and first-unit indexes."""
    if width - gram + 1 >= 1 << MANY_BITS:
        raise ValueError(f"a window of {width} is too wide: a segment's windows are counted in {MANY_BITS} bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "raw", limit):
            hashes, first = units(*spans(batch.column("raw")))
            doc, start, many, anchor, content = segments(hashes, first, width, gram)
            ids, tags = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("did", "tag"))
            yield pa.record_batch([anchor.view(np.int64), content.view(np.int64), ids[doc], tags[doc], pack(start, many)], ["anchor", "content", "did", "tag", "place"])

    return released(run)


SEGMENT = "anchor long, content long, did long, tag long, place long"


def integer_key(docs: DataFrame, key: str) -> None:
    """Other keys than integers are an error, told before anything runs."""
    kind = docs.schema[key].dataType.typeName()
    if kind not in ("byte", "short", "integer", "long"):
        raise TypeError(f"{key} is {kind}; the order of documents needs an integer key")


def texts(docs: DataFrame, key: str, text: str, *others: Column) -> tuple[DataFrame, bool]:
    """(did, tag, raw, others): an id that is never null, a number that tells the texts of one id apart, and the text's bytes (null: none). Also, whether there are ids with several texts.

    Ids with one text each, the usual case, have the tag 0; whether there are others is told by one aggregate over digests of 128 bits. The texts of a repeated
    or null id are numbered in order of their digests, without a task for an id; rows that repeat id and text share a tag.
    """
    integer_key(docs, key)
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("did"), raw.alias("raw"), *others)
    named = [c for c in rows.columns if c not in ("did", "raw")]
    digests = rows.select("did", F.struct(F.xxhash64("raw").alias("one"), F.xxhash64(F.lit(1), "raw").alias("two")).alias("digest"))
    several = keep(digests.groupBy("did").agg(F.min("digest").alias("least"), F.max("digest").alias("most")).where("least <> most").select("did"))
    if several.isEmpty():
        return rows.select("did", F.lit(0).cast("long").alias("tag"), "raw", *named), False
    distinct = apart(digests, several, ["did"]).distinct().select("did", "digest.one", "digest.two")
    tags = numbered(distinct, ["did"], [F.col("one"), F.col("two")], "tag").select("did", "one", "two", "tag")
    joined = rows.withColumns({"one": F.xxhash64("raw"), "two": F.xxhash64(F.lit(1), "raw")}).join(tags, ["did", "one", "two"], "left")
    return keep(joined.select("did", F.coalesce("tag", F.lit(0)).cast("long").alias("tag"), "raw", *named)), True


def compact(rows: DataFrame) -> DataFrame:
    """With the texts compressed for the shuffle, as packed in place of raw."""
    return rows.select("did", "tag", F.arrow_udf(packed, "binary")("raw").alias("packed"), *rows.columns[3:])


def shared(found: DataFrame) -> DataFrame:
    """The segment rows whose anchor occurs more than once, written to the shared folder."""
    # written on its own, so that the join has two plain shuffles and Spark can split an anchor that very many rows share
    many = keep(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"))
    return keep(found.join(many, "anchor", "left_semi"))


def per_document(rows: DataFrame, *fields: str) -> DataFrame:
    """(did, tag, spans) from (did, tag, fields): the spans of one text; no more of them than it has units."""
    return rows.groupBy("did", "tag").agg(F.collect_list(F.struct(*fields)).alias("spans"))
