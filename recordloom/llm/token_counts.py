"""Token counts: lengths only, in Arrow batches balanced by bytes.

A task cuts its rows into batches of about equal bytes. Within a batch, texts of any length are split at ASCII white
space, a safe boundary for a tokenizer that drops white space and never forms a token across it (the word tokenizers
with word ends do so; ``safe`` checks the tokenizer's own settings). The distinct pieces of a batch that are not known yet go to the
library's batch encoder together, and only their lengths are kept. A piece of more than LONG bytes is split further, where a letter is followed by a mark that
begins a token of its own, if the tokenizer is of the kind whose splitting is known (``bpe.supported``).
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import supported
from .textscan import by_bytes, released, spans, words

#: Known lengths kept by a task; the table is emptied when it is full.
MOST_KNOWN = 400_000
BATCH_BYTES = 4 << 20
LONG = 1 << 14
#: A mark behind an ASCII letter begins a token, and no special token holds one.
MARKS = np.isin(np.arange(256), [ord(c) for c in ".,;:!?"])
LETTERS = np.isin(np.arange(256), [ord(c) for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"])


def safe(path: str) -> None:
    """Raises unless white space is dropped before the model and no special token holds any."""
    spec = json.load(open(path, encoding="utf-8"))
    split = json.dumps(spec.get("pre_tokenizer") or {})
    if '"Removed"' not in split or r"[^\\s" not in split or any(c.isspace() for t in spec.get("added_tokens", []) for c in t["content"]) or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec.get("added_tokens", [])):
        raise ValueError("this tokenizer has tokens that hold white space; texts can't be split there")


def splits_as_known(path: str) -> bool:
    try:
        supported(json.load(open(path, encoding="utf-8")))
    except ValueError:
        return False
    return True


def shorter(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, long: int = LONG) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of pieces, those of more than ``long`` bytes cut at safe places, ``long`` bytes apart at least."""
    cuts: list[int] = []
    for a, b in zip(starts[ends - starts > long].tolist(), ends[ends - starts > long].tolist(), strict=True):
        at = a
        for p in (np.flatnonzero(MARKS[data[a + 1 : b]] & LETTERS[data[a : b - 1]]) + a + 1).tolist():
            if p - at >= long:
                cuts.append(p)
                at = p
    return (np.union1d(starts, cuts).astype(np.int64), np.union1d(ends, cuts).astype(np.int64)) if cuts else (starts, ends)


def counter(path: str):
    """A mapInArrow function: (id, raw binary) to (id, n_bytes, n_tokens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a task has one core: the library's own pool of threads would run beside it
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        safe(path)
        known_splitting = splits_as_known(path)
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        known: dict[bytes, int] = {}
        for batch in by_bytes(batches, "raw", BATCH_BYTES):
            data, offsets = spans(batch.column("raw"))
            starts, ends, first = words(data, offsets)
            if known_splitting:
                starts, ends = shorter(data, starts, ends)
                first = np.searchsorted(starts, offsets, "left")
            total = np.zeros(len(offsets) - 1, np.int64)
            if len(starts):
                keep = np.zeros(len(data), bool)
                step = np.zeros(len(data) + 1, np.int8)
                step[starts] += 1
                step[ends] -= 1
                keep = np.cumsum(step[:-1], dtype=np.int8).astype(bool)
                at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
                # adjoining words of two documents stay apart: their offsets are exact
                pieces = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(data[keep].tobytes())])
                coded = pc.dictionary_encode(pieces)
                distinct = coded.dictionary.to_pylist()
                new = [p for p in distinct if p not in known]
                if len(known) + len(new) > MOST_KNOWN:
                    known.clear()
                    new = distinct
                for k in range(0, len(new), 20_000):
                    part = new[k : k + 20_000]
                    known.update(zip(part, (len(e) for e in tokenizer.encode_batch_fast([p.decode("utf-8", "replace") for p in part], add_special_tokens=False)), strict=True))
                lengths = np.fromiter((known[p] for p in distinct), np.int64, len(distinct))
                running = np.concatenate([[0], np.cumsum(lengths[coded.indices.to_numpy()])])
                total = running[first[1:]] - running[first[:-1]]
            yield pa.record_batch([batch.column(0), pa.array(np.diff(offsets)), pa.array(total)], ["id", "n_bytes", "n_tokens"])

    return released(run)


def count_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = 2048) -> DataFrame:
    """key, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) for every row.

    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows are counted each. A null key is kept. Extra columns are not
    read. An empty table gives no rows.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("raw"))
    counted = rows.mapInArrow(counter(path), f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
