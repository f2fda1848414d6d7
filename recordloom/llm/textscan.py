"""Vectorised scanning of Arrow byte columns: sub-batches, word spans, word hashes.

Everything here works on the raw UTF-8 bytes of an Arrow ``binary`` array, so no text is decoded and no
Python object is made per word.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard

#: Bytes of text handled at a time; bounds the numpy temporaries of a task.
SLICE_BYTES = 2 << 20
#: Longer words are hashed one by one.
LONG_WORD = 256

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

_K1, _K2, _K3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53))
_S33, _S29, _S32 = (np.uint64(x) for x in (33, 29, 32))


def give_back() -> None:
    """Returns freed memory to the system: Spark keeps a worker process for later tasks, and with it what its allocators hold on to."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, a mapInArrow function, with memory handed back when it has ended and holds nothing any more."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return whole


def packed(values: pa.Array) -> pa.Array:
    """Each value's bytes compressed, null for null: texts take half the shuffle that Spark's own compression of blocks leaves."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    return _mapped(values, squeeze)


def unpacked(values: pa.Array) -> pa.Array:
    return _mapped(values, zstandard.ZstdDecompressor().decompress)


def _mapped(values: pa.Array, f) -> pa.Array:
    out = pa.array([f(v.as_buffer()) if v.is_valid else None for v in values], pa.binary())
    give_back()
    return out


def opened(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES // 4) -> Iterator[pa.RecordBatch]:
    """Slices of about ``limit`` bytes of compressed texts, their column packed (never null) replaced by raw."""
    expand = zstandard.ZstdDecompressor().decompress
    for batch in by_bytes(batches, "packed", limit):
        raw = pa.array([expand(v.as_buffer()) for v in batch.column("packed")], pa.binary())
        yield batch.set_column(batch.schema.get_field_index("packed"), "raw", raw)


_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def parts(raw: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """A text in parts of about ``step`` bytes, cut at white space, so that the words of a very long one needn't be held at once."""
    at = 0
    while at < len(raw):
        found = _SPACE.search(raw, at + step)
        end = found.start() if found else len(raw)
        yield raw[at:end] if at or end < len(raw) else raw
        at = end


def by_bytes(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Zero-copy slices of about ``limit`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = spans(batch.column(column))[1]
        at = 0
        while at < batch.num_rows:
            upto = int(np.searchsorted(ends[1:], ends[at] + limit, "right"))
            upto = min(max(upto, at + 1), batch.num_rows)
            yield batch.slice(at, upto - at)
            at = upto
    give_back()


def spans(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and the n + 1 offsets of a binary array; the bytes start at the first offset."""
    wide = pa.types.is_large_binary(array.type)
    offsets = np.frombuffer(array.buffers()[1], np.int64 if wide else np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = array.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray, white: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and first-word indexes: document d has the words first[d]:first[d + 1]."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    blank = white[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = ~blank
    starts[1:] &= blank[:-1] | edge[1:-1]
    ends = ~blank
    ends[:-1] &= blank[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets, "left")


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3."""
    h = (h ^ (h >> _S33)) * _K2
    h = (h ^ (h >> _S33)) * _K3
    return h ^ (h >> _S33)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, eight bytes a step."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), "<u8", padded.data, 0, (1,))
    size = ends - starts
    h = (size.astype(np.uint64) + np.uint64(1)) * _K1
    live = np.arange(len(starts))
    at = 0
    while len(live):
        left = size[live] - at
        value = eight[starts[live] + at]
        short = left < 8
        if short.any():
            value[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        h[live] = mix(h[live] ^ (value * _K1))
        at += 8
        live = live[(left > 8) & (size[live] <= LONG_WORD)]
    raw = None
    for i in np.flatnonzero(size > LONG_WORD):
        raw = data.tobytes() if raw is None else raw
        h[i] = xxhash.xxh64_intdigest(raw[starts[i] : ends[i]], 1)
    return h


def odd_powers(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random odd 64-bit factors."""
    return mix((np.arange(n, dtype=np.uint64) + np.uint64(seed + 1)) * _K1) | np.uint64(1)


def window_hashes(h: np.ndarray, width: int, seed: int) -> np.ndarray:
    """The hash of every ``width`` consecutive items of ``h`` (across documents: the caller drops those)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k, factor in enumerate(odd_powers(width, seed)):
        out += h[k : k + n] * factor
    return mix(out)


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` values the index of its smallest one, the leftmost of equals."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, index, span = values.copy(), np.arange(len(values)), 1
    while span * 2 <= width:  # doubling: best[i] covers span values from i on
        later = best[span:] < best[:-span]
        best, index = np.where(later, best[span:], best[:-span]), np.where(later, index[span:], index[:-span])
        span *= 2
    rest = width - span
    if rest:
        later = best[rest : rest + n] < best[:n]
        return np.where(later, index[rest : rest + n], index[:n])
    return index[:n]
