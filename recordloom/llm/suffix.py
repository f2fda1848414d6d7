"""Suffix-array deduplication in bytes, by bucket-pointer refinement.

A byte goes if a string of ``width`` bytes that covers it also starts anywhere else. In suffix-array terms: suffixes that agree on their
first ``width`` bytes share a bucket. Buckets begin as those of q-grams, q a quarter of the width, and are
refined by sorting on the bucket pointers of later offsets: after one round a pointer stands for twice as many bytes, and the next
round reads these updated pointers, so two rounds reach the width. Suffixes alone in a bucket leave at once.

To spread this, only suffixes that can have a partner are sorted. Content-defined anchors (see ``anchors``) bring together the segments that
can hold equal strings; segments with equal content need no sorting at all, and those that differ behind
one anchor are refined, anchor by anchor, in bounded batches. A group of more than GROUP different segments is too large for a batch. It goes through the same two rounds as
shuffles: the pointers of the first round are made where the text is, from the q-gram buckets of two offsets each, and the second round is a grouping
by the pointers of two offsets, combined before the shuffle and spread over all tasks. Both ways are exact but for collisions of 64-bit hashes within one anchor.
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
from .textscan import by_bytes, mix, opened, released, spans

WIDTH, GRAM = 400, 32
#: Bytes of segments that are refined together, and different segments of an anchor that are (a segment has under twice the width).
BATCH_BYTES = 2 << 20
GROUP = 4096

_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def byte_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _BYTES[data], offsets


def _point(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pointer (index of its bucket's last place in order) of each key, and whether the bucket holds others."""
    order = np.argsort(key)
    ranked = key[order]
    last = np.append(ranked[1:] != ranked[:-1], True)
    ends = np.flatnonzero(last)
    size = np.diff(ends, prepend=-1)
    pointer, more = np.empty(len(key), np.int64), np.empty(len(key), bool)
    pointer[order] = np.repeat(ends, size)
    more[order] = np.repeat(size > 1, size)
    return pointer, more


def offsets_of(width: int) -> tuple[int, int]:
    """(half, q): a window is two halves, a half two q-grams; they overlap where the width is no multiple."""
    half = -(-width // 2)
    return half, -(-half // 2)


def halves(grams: np.ndarray, places: np.ndarray, half: int, q: int) -> np.ndarray:
    """What the first round sorts by: the q-gram buckets of two offsets that make up half a window."""
    return mix(grams[places] * np.uint64(3) + mix(grams[places + half - q]))


def refine(data: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Which of ``starts`` (distinct places of ``data``, ``width`` bytes from the end at least) share their next ``width`` bytes with another."""
    half, q = offsets_of(width)
    out = np.zeros(len(starts), bool)
    if len(starts) < 2:
        return out
    step = 1 << 20  # the prefix sums of a part at a time
    grams = np.concatenate([Rolling(_BYTES[data[k : k + step + q - 1]]).grams(q) for k in range(0, len(data) - q + 1, step)])
    live = np.flatnonzero(_point(grams[starts])[1])  # q-gram buckets
    if not len(live):
        return out
    at = starts[live]
    far = width - half
    wanted = np.zeros(len(data), bool)
    wanted[at] = True
    wanted[at + far] = True
    places = np.flatnonzero(wanted)
    pointers, more = np.full(len(data), -1, np.int64), np.zeros(len(data), bool)
    # first round: q-gram buckets of two offsets name buckets of half the width
    pointers[places], more[places] = _point(halves(grams, places, half, q))
    keep = more[at] & more[at + far]
    live, at = live[keep], at[keep]
    # second round: the updated pointers of two offsets name buckets of the whole width
    if len(live):
        out[live[_point(pointers[at] * np.int64(len(data)) + pointers[at + far])[1]]] = True
    return out


def pieces(width: int):
    """A mapInArrow function: (did, tag, packed, asked) to the segments' bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in opened(batches):
            rows = []
            for did, tag, raw, asked in zip(*(batch.column(c) for c in ("did", "tag", "raw", "asked")), strict=True):
                text = raw.as_py()
                for x in asked.as_py():
                    rows.append((x["anchor"], did.as_py(), tag.as_py(), x["start"], x["many"], text[x["start"] : x["start"] + x["many"] - 1 + width]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["anchor", "did", "tag", "start", "many", "piece"])

    return released(run)


def refiner(width: int):
    """A mapInArrow function over rows sorted by anchor: segments with their bytes to runs (did, tag, start, many)."""

    def work(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        piece = table.column("piece").chunk(0) if table.num_rows else pa.array([], pa.binary())
        data, offsets = spans(piece)
        did, tag, start, many = (table.column(c).to_numpy() for c in ("did", "tag", "start", "many"))
        row = np.repeat(np.arange(len(many)), many)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        twin = refine(data, offsets[:-1][row] + nth, width)
        # consecutive windows of one segment become one run
        head = twin.copy()
        head[1:] &= ~twin[:-1] | (row[1:] != row[:-1])
        tail = twin.copy()
        tail[:-1] &= ~twin[1:] | (row[1:] != row[:-1])
        a, b = np.flatnonzero(head), np.flatnonzero(tail)
        return pa.record_batch([did[row[a]], tag[row[a]], start[row[a]] + nth[a], b - a + 1], ["did", "tag", "start", "many"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in by_bytes(batches, "piece", BATCH_BYTES // 2):
            held.append(batch)
            size += int(spans(batch.column("piece"))[1][-1])
            if size >= BATCH_BYTES:
                # all but the last anchor's segments, which may go on in the next batch
                table = pa.Table.from_batches(held)
                anchors = table.column("anchor").to_numpy()
                cut = int(np.flatnonzero(anchors != anchors[-1])[-1]) + 1 if (anchors != anchors[-1]).any() else 0
                if cut:
                    yield work(table.slice(0, cut))
                    held = table.slice(cut).to_batches()
                    size = int(sum(spans(b.column("piece"))[1][-1] for b in held if b.num_rows))
        if held:
            yield work(pa.Table.from_batches(held))

    return released(run)


def pointed_windows(width: int):
    """A mapInArrow function: (did, tag, packed, asked) to (anchor, near, far, did, tag, start): the first round's pointers of each window of the segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half, q = offsets_of(width)
        for batch in opened(batches):
            data, offsets = spans(batch.column("raw"))
            grams = Rolling(_BYTES[data]).grams(q)
            asked = batch.column("asked")
            owner = np.repeat(np.arange(batch.num_rows), asked.value_lengths().to_numpy(zero_copy_only=False))
            flat = asked.flatten()
            anchor, start, many = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            row = np.repeat(np.arange(len(start)), many)
            at = start[row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            doc = owner[row]
            near, far = (halves(grams, offsets[doc] + at + x, half, q).view(np.int64) for x in (0, width - half))
            ids, tags = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("did", "tag"))
            yield pa.record_batch([anchor[row], near, far, ids[doc], tags[doc], at], ["anchor", "near", "far", "did", "tag", "start"])

    return released(run)


RUN = "did long, tag long, start long, many long"


def repeated(rows: DataFrame, plain: DataFrame, width: int = WIDTH, group: int = GROUP) -> DataFrame:
    """(did, tag, start, many): runs of ``many`` windows, from the byte ``start`` on, that all start elsewhere too; ``plain`` has the texts of ``rows`` compressed."""
    found = shared(rows.select("did", "tag", "raw").mapInArrow(scanner(byte_units, width, min(GRAM, -(-width // 4)), 1 << 20), SEGMENT))
    blocks = found.groupBy("anchor", "content").agg(F.min(F.struct("did", "tag", "place")).alias("first"), F.count(F.lit(1)).alias("n"))
    twice = blocks.where("n > 1").select("anchor", "content")
    whole = apart(found, twice, ["anchor", "content"]).select("did", "tag", start_of(F.col("place")).alias("start"), windows_of(F.col("place")).alias("many"))
    differ = blocks.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    place = F.col("first.place")
    edges = apart(blocks, differ, ["anchor"]).select("anchor", "m", "first.did", "first.tag", start_of(place).alias("start"), windows_of(place).alias("many"))

    def asked(part: DataFrame) -> DataFrame:
        each = part.groupBy("did", "tag").agg(F.collect_list(F.struct("anchor", "start", "many")).alias("asked"))
        return plain.join(each, ["did", "tag"]).select("did", "tag", "packed", "asked")

    bytes_ = asked(edges.where(F.col("m") <= group)).mapInArrow(pieces(width), "anchor long, did long, tag long, start long, many long, piece binary")
    refined = bytes_.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(refiner(width), RUN)
    seen = asked(edges.where(F.col("m") > group)).mapInArrow(pointed_windows(width), "anchor long, near long, far long, did long, tag long, start long")
    again = seen.groupBy("anchor", "near", "far").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor", "near", "far")
    single = apart(seen, again, ["anchor", "near", "far"]).select("did", "tag", "start", F.lit(1).cast("long").alias("many"))
    return whole.unionByName(refined).unionByName(single)


def remover(width: int, full: bool):
    """A mapInArrow function: (did, packed, spans) to (id, n_bytes, n_removed, n_spans, kept_sha256[, kept, removed])."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in opened(batches):
            n, gone, many, sha, kept_all, runs_all = [], [], [], [], [], []
            for raw, found in zip(batch.column("raw"), batch.column("spans"), strict=True):
                text = raw.as_py()
                runs: list[list[int]] = []
                if found.is_valid:
                    flat = found.values
                    a, k = flat.field(0).to_numpy(zero_copy_only=False), flat.field(1).to_numpy(zero_copy_only=False)
                    b = a + k - 1 + width
                    good = b <= len(text)
                    for x, y in sorted(zip(a[good].tolist(), b[good].tolist(), strict=True)):
                        if runs and x <= runs[-1][1]:
                            runs[-1][1] = max(runs[-1][1], y)
                        else:
                            runs.append([x, y])
                at, parts = 0, []
                for x, y in runs:
                    parts.append(text[at:x])
                    at = y
                kept = b"".join([*parts, text[at:]])
                n.append(len(text))
                gone.append(len(text) - len(kept))
                many.append(len(runs))
                sha.append(hashlib.sha256(kept).hexdigest())
                kept_all.append(kept)
                runs_all.append([{"start": x, "bytes": y - x} for x, y in runs])
            ids = [None if i == NO_ID else i for i in batch.column("did").to_pylist()]
            out = {"id": pa.array(ids, pa.int64())} | {c: pa.array(v, pa.int64()) for c, v in (("n_bytes", n), ("n_removed", gone), ("n_spans", many))} | {"kept_sha256": pa.array(sha, pa.string())}
            if full:
                out |= {"kept": pa.array(kept_all, pa.binary()), "spans": pa.array(runs_all, pa.list_(pa.struct([("start", pa.int64()), ("bytes", pa.int64())])))}
            yield pa.RecordBatch.from_pydict(out)

    return released(run)


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, full: bool = True, group: int = GROUP) -> DataFrame:
    """key (long), n_bytes, n_removed, n_spans, kept_sha256 and, with ``full``, kept (bytes) and spans of every row.

    The key is an integer, else a TypeError is raised. Every copy goes, the first too. Matches never cross documents. A null text has no bytes; its digest is that of the
    empty string. Rows that repeat a key and text are two documents, and so each other's partners; so are rows with one key (or none) and different texts. Texts of fewer than
    ``width`` bytes lose nothing. A null key is kept. Extra columns are not read, whatever their names. An empty table gives no rows.
    """
    if width < 8:
        raise ValueError("a width of 8 bytes at least")
    rows, _ = texts(docs, key, text)
    plain = compact(rows)
    found = per_document(repeated(rows, plain, width, group), "start", "many")
    joined = plain.join(found, ["did", "tag"], "left").select("did", "packed", "spans")
    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary, spans array<struct<start: long, bytes: long>>" * full
    return joined.mapInArrow(remover(width, full), schema).withColumnRenamed("id", key)
