"""Substring deduplication by relative Lempel-Ziv parsing, in words.

The reference of a document is all text that starts earlier: that of smaller document ids, and the document's own earlier words. The corpus is cut at
content-defined places into blocks (see ``anchors``), and of equal blocks the earliest is indexed under its anchor. Nothing but a block with one of a document's
anchors can share a window of ``width`` words with it, so looking up its anchors factors a document against every indexed block:

* a block of the document that equals an indexed one refers to it as a whole;
* where the two differ behind one anchor, which is where factors end, each window of the block is looked up among the
  windows of all blocks with that anchor, and refers to the earliest equal one.

A document is then parsed greedily (``parse``): references that advance in step are one match, and at the first word that any match covers the
parse takes the match that reaches farthest. A factor is (first window, windows, document and place referred to). The parse goes on behind the last window of a
factor, not behind its last word, so windows that lie across the boundary of two factors are tried as well. The words of all factors are the duplicate spans.

So a word is in a span exactly if some window that covers it also starts earlier. Windows are judged on the input. Hashes of 64 bits for the anchor and 64 for content are compared together.

Sizes: one row per segment is shuffled, and only repeated segments and the texts move again. A passage that a third of all documents
hold is combined before the shuffle; nothing is paired within a group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.spread import apart
from .anchors import NO_ID, SEGMENT, Rolling, compact, per_document, scanner, shared, start_of, texts, windows_of
from .textscan import give_back, opened, released, spans, word_hashes, words

WIDTH, GRAM = 20, 6
#: What the index says of a text: ``many`` windows from ``start`` on equal those from ``at`` on of the text (ref, which).
HIT = ("start", "many", "ref", "which", "at")


def word_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = words(data, offsets)
    return word_hashes(data, starts, ends), first


def boundary_windows(width: int):
    """A mapInArrow function: (did, tag, packed, blocks) to the windows (anchor, window, did, tag, start) of the blocks of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in opened(batches):
            hashes, first = word_units(*spans(batch.column("raw")))
            grams = Rolling(hashes).grams(width)
            blocks = batch.column("blocks")
            owner = np.repeat(np.arange(batch.num_rows), blocks.value_lengths().to_numpy(zero_copy_only=False))
            flat = blocks.flatten()
            anchor, start, many = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            row = np.repeat(np.arange(len(start)), many)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            at, doc = start[row] + nth, owner[row]
            ids, tags = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("did", "tag"))
            yield pa.record_batch([anchor[row], grams[first[doc] + at].view(np.int64), ids[doc], tags[doc], at], ["anchor", "window", "did", "tag", "start"])

    return released(run)


def referred(found: DataFrame, firsts: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``found`` (did, tag, start, many and the keys) with the ``first`` of their keys."""
    return apart(found, firsts.select(*keys, "first"), keys)


def behind(pairs: DataFrame) -> DataFrame:
    """Hits: rows that start behind their first."""
    later = F.struct("did", "start") > F.struct("first.did", "first.start")
    return pairs.where(later).select("did", "tag", "start", "many", F.col("first.did").alias("ref"), F.col("first.tag").alias("which"), F.col("first.start").alias("at"))


def hits(rows: DataFrame, plain: DataFrame, several: bool, width: int) -> DataFrame:
    """(did, tag and the fields of HIT) of the texts of ``rows``; ``plain`` has them compressed; ``several``: are there ids with several texts?"""
    found = shared(rows.select("did", "tag", "raw").mapInArrow(scanner(word_units, width, min(GRAM, width)), SEGMENT))
    start, many = start_of(F.col("place")).alias("start"), windows_of(F.col("place")).alias("many")
    blocks = found.groupBy("anchor", "content").agg(F.min(F.struct("did", start, "tag", many)).alias("first"), F.count(F.lit(1)).alias("n"))
    # blocks that equal an indexed one
    copies = referred(found.select("anchor", "content", "did", "tag", start, many), blocks.where("n > 1"), ["anchor", "content"])
    # factor boundaries: blocks that differ behind one anchor
    differ = blocks.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    edges = apart(blocks, differ, ["anchor"]).select("anchor", "first.did", "first.tag", "first.start", "first.many")
    if several:
        # texts of one id that hold a block at one place: each is a first
        level = (F.struct("did", "start") == F.struct("first.did", "first.start")) & (F.col("tag") != F.col("first.tag"))
        edges = edges.unionByName(apart(copies.where(level).select("anchor", "did", "tag", "start", "many").distinct(), differ, ["anchor"]))
    asked = edges.groupBy("did", "tag").agg(F.collect_list(F.struct("anchor", "start", "many")).alias("blocks"))
    seen = plain.select("did", "tag", "packed").join(asked, ["did", "tag"]).select("did", "tag", "packed", "blocks").mapInArrow(boundary_windows(width), "anchor long, window long, did long, tag long, start long")
    earliest = seen.groupBy("anchor", "window").agg(F.min(F.struct("did", "start", "tag")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return behind(copies).unionByName(behind(referred(seen.withColumn("many", F.lit(1).cast("long")), earliest, ["anchor", "window"])))


def matches(doc: np.ndarray, start: np.ndarray, many: np.ndarray, ref: np.ndarray, which: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """(doc, first window, end, ref, at): hits in step, each beginning where the ones before end at the latest, are one match. In order of document and place."""
    order = np.lexsort((start, at - start, which, ref, doc))
    doc, start, end, ref, which, at = (x[order] for x in (doc, start, start + many, ref, which, at))
    other = np.ones(len(doc), bool)
    for x in (doc, ref, which, at - start):
        other[1:] &= x[1:] == x[:-1]
    line = np.cumsum(~other | (np.arange(len(doc)) == 0)) if len(doc) else np.zeros(0, np.int64)
    # the farthest end so far on a line: lines are kept apart by an offset that no place reaches
    far = int(end.max()) + 1 if len(doc) else 1
    reach = np.maximum.accumulate(end + line * far) - line * far
    head = np.ones(len(doc), bool)
    head[1:] = (line[1:] != line[:-1]) | (start[1:] > reach[:-1])
    heads = np.flatnonzero(head)
    ends = reach[np.append(heads[1:], len(doc)) - 1] if len(heads) else reach[:0]
    back = np.lexsort((start[heads], doc[heads]))
    return tuple(x[back] for x in (doc[heads], start[heads], ends, ref[heads], at[heads]))


def parse(doc: np.ndarray, start: np.ndarray, many: np.ndarray, ref: np.ndarray, which: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """The factors (doc, first window, windows, ref, at) of a batch of documents from their hits, greedily and in order."""
    out: list[tuple[int, int, int, int, int]] = []
    found = list(zip(*(x.tolist() for x in matches(doc, start, many, ref, which, at)), strict=True))
    best, done, k, now = (0, 0, 0, 0), 0, 0, -1
    while True:
        while k < len(found) and found[k][0] == now and found[k][1] <= done:
            if found[k][2] > best[1]:
                best = found[k][1:]
            k += 1
        if best[1] > done:
            out.append((now, done, best[1] - done, best[2], best[3] + done - best[0]))
            done = best[1]
        elif k == len(found):
            return out
        else:
            # no match covers the next window: on to the next one that begins, here or in another document
            best = best if found[k][0] == now else (0, 0, 0, 0)
            now, done = found[k][:2]


def factors_of(found: pa.ListArray) -> list[tuple[int, int, int, int, int]]:
    """The factors of a batch of documents, from their lists of hits."""
    doc = np.repeat(np.arange(len(found)), found.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    flat = found.flatten()
    return parse(doc, *(flat.field(k).to_numpy(zero_copy_only=False) for k in range(len(HIT))))


def kept_words(data: np.ndarray, offsets: np.ndarray, factors: list[tuple[int, int, int, int, int]], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[memoryview]]:
    """(first-word indexes, words removed of each text, whether each word goes, the kept words of each text joined by a space)."""
    starts, ends, first = words(data, offsets)
    step = np.zeros(len(starts) + 1, np.int32)
    if factors:
        doc, start, many = np.array(factors, np.int64).T[:3]
        np.add.at(step, first[doc] + start, 1)
        np.add.at(step, first[doc] + start + many - 1 + width, -1)
    gone = np.cumsum(step[:-1]) > 0
    stays = ~gone
    removed = np.concatenate([[0], np.cumsum(gone)])[first]
    # the bytes of kept words, in order, go to all places of the result but those of the spaces
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts[stays]] += 1
    edge[ends[stays]] -= 1
    source = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    size = np.where(stays, ends - starts + 1, 0)
    at = np.concatenate([[0], np.cumsum(size)])
    result = np.full(at[-1], 0x20, np.uint8)
    letters = np.ones(at[-1], bool)
    letters[at[1:][stays] - 1] = False
    result[letters] = data[source]
    view = memoryview(result.tobytes())
    begin, end = at[first[:-1]], at[first[1:]]
    kept = [view[a : max(a, b - 1)] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
    return first, np.diff(removed), gone, kept


def remover(width: int, full: bool):
    """A mapInArrow function: (did, packed, spans) to (id, n_words, n_removed, kept_sha256[, kept, spans, factors])."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in opened(batches):
            factors = factors_of(batch.column("spans"))
            first, removed, gone, kept = kept_words(*spans(batch.column("raw")), factors, width)
            ids = batch.column("did").to_pylist()
            out = {
                "id": pa.array([None if i == NO_ID else i for i in ids], pa.int64()), "n_words": pa.array(np.diff(first)), "n_removed": pa.array(removed),
                "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            }
            if full:
                runs = []
                for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone[a:b].astype(np.int8), [0]])))
                    runs.append([{"start": int(x), "words": int(y - x)} for x, y in zip(edge[::2], edge[1::2], strict=True)])
                referred: list[list[dict]] = [[] for _ in ids]
                for d, s, n, r, p in factors:
                    referred[d].append({"start": s, "words": n - 1 + width, "document": None if r == NO_ID else r, "at": p})
                run_kind, factor_kind = (pa.list_(pa.struct([(c, pa.int64()) for c in names])) for names in (("start", "words"), ("start", "words", "document", "at")))
                out |= {"kept": pa.array([bytes(k).decode("utf-8", "replace") for k in kept], pa.string()), "spans": pa.array(runs, run_kind), "factors": pa.array(referred, factor_kind)}
            yield pa.RecordBatch.from_pydict(out)

    return released(run)


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, full: bool = True) -> DataFrame:
    """key (long), n_words, n_removed, kept_sha256 and, with ``full``, kept (words joined by one space), spans and factors of every row.

    The key is an integer, else a TypeError is raised. A factor says which words equal which of an earlier document (or of the same one): start, words, document, at.
    A null text has no words; its digest is that of the empty string. A null key counts as before all others. Rows that
    repeat a key and text get the same result each: neither is earlier than the other. Of rows with one key (or none) and different texts the start alone
    decides. Texts with fewer words than ``width`` lose nothing. Extra columns are not read, whatever their names. An empty table gives no rows.
    """
    if width < 2:
        raise ValueError("a window has two words at least")
    rows, several = texts(docs, key, text)
    plain = compact(rows)
    found = per_document(hits(rows, plain, several, width), *HIT)
    joined = plain.join(found, ["did", "tag"], "left").select("did", "packed", "spans")
    schema = "id long, n_words long, n_removed long, kept_sha256 string"
    if full:
        schema += ", kept string, spans array<struct<start: long, words: long>>, factors array<struct<start: long, words: long, document: long, at: long>>"
    return joined.mapInArrow(remover(width, full), schema).withColumnRenamed("id", key)


def stripped(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """The rows of ``docs``, all columns, with texts rid of duplicate spans: the kept words joined by one space.

    A text without such spans stays as it is, null or not, and a row whose words all go is left out. The columns of ``docs`` travel in one struct, so their
    names can't clash with those used here. Else as ``deduplicate``.
    """

    @F.arrow_udf("binary")
    def kept(texts_: pa.Array, found: pa.Array) -> pa.Array:
        out: list[bytes] = []
        for batch in opened(iter([pa.record_batch([texts_, found], ["packed", "spans"])])):
            factors = factors_of(batch.column("spans"))
            cut = {f[0] for f in factors}
            for d, (whole, rest) in enumerate(zip(batch.column("raw"), kept_words(*spans(batch.column("raw")), factors, width)[-1], strict=True)):
                out.append(bytes(rest) if d in cut else whole.as_py())
        done = pa.array(out, pa.binary())
        give_back()
        return done

    others = [c for c in docs.columns if c != text]
    rest = F.struct(F.col(text).isNull().alias("none"), *(F.col(c).alias(f"c{k}") for k, c in enumerate(others))).alias("rest")
    rows, several = texts(docs, key, text, rest)
    plain = compact(rows)
    found = per_document(hits(rows, plain, several, width), *HIT)
    # not to be worked out twice, for the condition and for the result
    once = kept.asNondeterministic()
    cut = plain.join(found, ["did", "tag"], "left").select("rest", F.col("spans").isNotNull().alias("changed"), once("packed", "spans").alias("text"))
    back = {text: F.when(F.col("rest.none"), F.lit(None)).otherwise(F.col("text").cast("string"))} | {c: F.col(f"rest.c{k}") for k, c in enumerate(others)}
    return cut.where("not changed or octet_length(text) > 0").select(*(back[c].alias(c) for c in docs.columns))
