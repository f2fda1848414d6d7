"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over consecutive tokens; positions with 0 are ignored. Equal hashes under a mask bring a place of a
document and a place of a benchmark item together although tokens at the ignored positions differ. The masks meet every run of 13 tokens or more with
80 % equal, and the short ones every whole item of four to twelve tokens as similar; shorter items are sought as a whole. Around each hit the two
are compared along that diagonal. Any run of tokens there is a leak if it is long enough and similar enough; sums of equal tokens less SIMILARITY find whether
there is one, exactly.

The benchmark is the stated query set: it is read in blocks of bounded size, each block is indexed and sent to the tasks, and all documents pass by.
So nothing of the corpus is shuffled, whatever its size or skew.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textscan import by_bytes, mix, odd_powers, spans, word_hashes, words

#: The masks, each of five positions.
MASKS = ("11111", "1101011", "11010011", "101000111")
#: Of four positions, for items with fewer tokens than OVERLAP: with the masks above, no such item with SIMILARITY equal is without a hit.
SHORT_MASKS = ("1111", "11011", "10111", "11101")
#: A leak has so many tokens at least (or the whole item, if that is shorter), of which so many are equal.
OVERLAP, PART, WHOLE = 13, 4, 5
SIMILARITY = PART / WHOLE
#: Of a substituted token in the best-scoring run, which a test still looks for; the search doesn't use it.
PENALTY = -2
#: Bytes of benchmark text indexed at a time. The index of a block has 104 bytes a token: some 70 MB.
BLOCK_BYTES = 4 << 20
#: Hits that are expanded at a time.
MOST_HITS = 1 << 20

SEPARATOR = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


@dataclass
class Index:
    """One block of the benchmark: its tokens, and by mask the sorted seed hashes with their places."""

    ids: list
    tokens: np.ndarray
    first: np.ndarray
    masks: list[str]
    hashes: list[np.ndarray]
    places: list[np.ndarray]
    present: list[np.ndarray]

    @staticmethod
    def of(ids: list, texts: list[bytes]) -> "Index":
        raw = pa.array(texts, pa.binary())
        tokens, first = tokenize(raw)
        size = np.diff(first)
        span = min(map(len, SHORT_MASKS))
        # an item with fewer tokens than the shortest mask is sought as a whole
        masks = [*MASKS, *(SHORT_MASKS if ((span <= size) & (size < OVERLAP)).any() else ()), *sorted({"1" * int(n) for n in size if 0 < n < span})]
        hashes, places, present = [], [], []
        for m in masks:
            h = seed_hashes(tokens, m)
            item = np.repeat(np.arange(len(size)), size)[: len(h)]
            fits = np.arange(len(h)) + len(m) <= first[1:][item]
            if m in SHORT_MASKS:
                fits &= size[item] < OVERLAP
            elif m not in MASKS:
                fits &= size[item] == len(m)
            at = np.flatnonzero(fits)
            order = np.argsort(h[at], kind="stable")
            hashes.append(h[at][order])
            places.append(at[order].astype(np.int32))
            bits = np.zeros(1 << 18, bool)
            bits[(hashes[-1] >> np.uint64(46)).astype(np.int64)] = True
            present.append(bits)
        return Index(ids, tokens, first, masks, hashes, places, present)

    def hits(self, tokens: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(token of the documents, token of the benchmark), MOST_HITS at a time or those of one place; ``ends``: of the document of each token."""
        for m, hashes, places, present in zip(self.masks, self.hashes, self.places, self.present, strict=True):
            h = seed_hashes(tokens, m)
            if not len(h) or not len(hashes):
                continue
            at = np.flatnonzero(present[(h >> np.uint64(46)).astype(np.int64)])
            at = at[at + len(m) <= ends[at]]
            low, high = np.searchsorted(hashes, h[at], "left"), np.searchsorted(hashes, h[at], "right")
            each = high - low
            at, low, each = at[each > 0], low[each > 0], each[each > 0]
            upto, k = np.cumsum(each), 0
            while k < len(at):
                end = max(k + 1, int(np.searchsorted(upto, (upto[k - 1] if k else 0) + MOST_HITS, "right")))
                n = each[k:end]
                row = np.repeat(np.arange(k, end), n)
                yield at[row], places[low[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)].astype(np.int64)
                k = end

    def diagonals(self, tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Rows (document, item, shift) along which there is any hit, each once. A very common seed has many hits, but no more diagonals than the two texts have tokens."""
        ends = np.repeat(first[1:], np.diff(first))
        found = np.zeros((0, 3), np.int64)
        held: list[np.ndarray] = []
        for at, place in self.hits(tokens, ends):
            doc, item = np.searchsorted(first, at, "right") - 1, np.searchsorted(self.first, place, "right") - 1
            held.append(np.unique(np.stack([doc, item, at - place], axis=1), axis=0))
            if sum(map(len, held)) > max(MOST_HITS, len(found)):
                found, held = np.unique(np.concatenate([found, *held]), axis=0), []
        return np.unique(np.concatenate([found, *held]), axis=0) if held else found

    def leaks(self, raw: pa.Array) -> dict[tuple[int, int], tuple[int, int, int]]:
        """(document, item) to (equal tokens, tokens of the run, first token in the document) of the best run."""
        tokens, first = tokenize(raw)
        if not len(tokens) or not len(self.tokens):
            return {}
        found: dict[tuple[int, int], tuple[int, int, int]] = {}
        for d, i, shift in self.diagonals(tokens, first).tolist():
            low = max(int(self.first[i]), int(first[d]) - shift)
            high = min(int(self.first[i + 1]), int(first[d + 1]) - shift)
            same = tokens[low + shift : high + shift] == self.tokens[low:high]
            run = fullest_run(same, min(OVERLAP, int(self.first[i + 1] - self.first[i])))
            if run:
                a, b = run
                found[d, i] = max(found.get((d, i), (0, 0, 0)), (int(same[a:b].sum()), b - a, low + shift + a - int(first[d])))
        return found


def fullest_run(same: np.ndarray, least: int) -> tuple[int, int] | None:
    """Of the runs of ``least`` tokens or more with SIMILARITY equal, the one with most equal tokens, the earliest of those; without other tokens at its ends, as far as ``least`` allows."""
    if len(same) < least:
        return None
    equal = np.concatenate([[0], np.cumsum(same)])
    over = WHOLE * equal - PART * np.arange(len(equal))
    # for each end the earliest start from which enough are equal: no later one has more of them
    start = np.searchsorted(-np.minimum.accumulate(over), -over, "left")
    found = np.where(np.arange(len(equal)) - start >= least, equal - equal[start], -1)
    b = int(np.argmax(found))
    if found[b] < 0:
        return None
    a = int(start[b])
    while b - a > least and not same[a]:
        a += 1
    while b - a > least and not same[b - 1]:
        b -= 1
    return a, b


def tokenize(raw: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes and first-token indexes. Tokens are runs of ASCII letters and digits and of all other characters beyond ASCII."""
    data, offsets = spans(raw)
    starts, ends, first = words(data, offsets, SEPARATOR)
    return word_hashes(data, starts, ends), first


def seed_hashes(tokens: np.ndarray, mask: str) -> np.ndarray:
    n = len(tokens) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k, factor in enumerate(odd_powers(len(mask), len(mask))):
        if mask[k] == "1":
            out += tokens[k : k + n] * factor
    return mix(out)


def blocks(benchmark: DataFrame, key: str, text: str, limit: int) -> Iterator[Index]:
    """Indexes of at most ``limit`` bytes of text each (one item at least); the driver holds one block at a time."""
    ids: list = []
    texts: list[bytes] = []
    size = 0
    for row in benchmark.select(F.col(key), F.lower(F.col(text)).cast("binary").alias("raw")).where("raw is not null").toLocalIterator():
        raw = bytes(row["raw"])
        if ids and size + len(raw) > limit:
            yield Index.of(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(row[0])
        texts.append(raw)
        size += len(raw)
    if ids:
        yield Index.of(ids, texts)


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", limit: int = BLOCK_BYTES) -> DataFrame:
    """(key, item, matched_tokens, overlap_tokens, start_token): a row for each document and each benchmark item that leaked into it.

    Tokens are compared in lower case. A leak is a run (see above) of OVERLAP tokens at least, or of the whole item if that is shorter, of which SIMILARITY are equal at
    their places; of several runs the one with most equal tokens is told, without other tokens at its ends unless it would be too short. A null or empty text, in either table, has no leak. Repeated rows are told each.
    Null keys are kept. Extra columns are not read. If a table is empty there are no rows.
    """
    spark = docs.sparkSession
    kind, item_kind = docs.schema[key].dataType, benchmark.schema[item].dataType
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.lower(F.col(text)), F.lit("")).cast("binary").alias("raw"))
    schema = f"{key} {kind.simpleString()}, {item} {item_kind.simpleString()}, matched_tokens long, overlap_tokens long, start_token long"
    out = spark.createDataFrame([], schema)
    for index in blocks(benchmark, item, item_text, limit):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            from pyspark.sql.pandas.types import to_arrow_type

            index = shared.value
            for batch in by_bytes(batches, "raw"):
                found = sorted(index.leaks(batch.column("raw")).items())
                ids = batch.column(0).take(pa.array([d for (d, _), _ in found], pa.int64()))
                items = pa.array([index.ids[i] for (_, i), _ in found], to_arrow_type(item_kind))
                yield pa.record_batch([ids, items, *(pa.array([v[k] for _, v in found], pa.int64()) for k in range(3))], [key, item, "matched_tokens", "overlap_tokens", "start_token"])

        out = out.unionByName(rows.mapInArrow(run, schema))
    return out


def _leaked(shared):
    @F.arrow_udf("boolean")
    def leaked(raw: pa.Array) -> pa.Array:
        out = np.zeros(len(raw), bool)
        at = 0
        for part in by_bytes(iter([pa.record_batch([raw], ["raw"])]), "raw"):
            for d, _ in shared.value.leaks(part.column("raw")):
                out[at + d] = True
            at += part.num_rows
        return pa.array(out)

    return leaked


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", limit: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, without those that hold a leak."""
    item = benchmark.columns[0]
    for index in blocks(benchmark, item, item_text, limit):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        docs = docs.where(~_leaked(shared)(F.coalesce(F.lower(F.col(text)), F.lit("")).cast("binary")))
    return docs
