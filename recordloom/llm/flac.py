"""Media columns: lossless FLAC streams, written and read a whole batch of frames at a time.

A frame's samples follow one another bit by bit, but frames are independent, and a seek table tells where each begins. So the decoder runs
over all frames of a batch in step: one numpy operation reads the next Rice code of every frame. It checks the header checksum (CRC-8) and the
frame checksum (CRC-16) of each frame and the MD5 of each stream, knows constant, verbatim, fixed and linear-prediction
subframes with partitioned Rice residuals and escapes, and puts out PCM blocks with their first sample's offset. The
encoder writes constant, verbatim, fixed (order 0 to 2) and linear-prediction subframes (order LINEAR, coefficients by Levinson's recursion), whichever
is smallest, with the residuals in one Rice partition or in four.

Both work through FRAMES frames at a time, so the tables of a long text are no larger than those of a short one. Streams have one channel. Format: RFC 9639.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textscan import by_bytes

#: Samples of a frame, payload bytes coded together, and frames that are.
FRAME, BATCH_BYTES, FRAMES = 512, 1 << 19, 1024
#: Order of linear predictors, bits of a coefficient with its sign, and the shift of all coefficients; Rice partitions of a frame that has more than one.
LINEAR, PRECISION, SHIFT, PARTITIONS = 4, 12, 9, 4
RATE = 8000
#: Fixed values of the format: generator polynomials of the two checksums.
CRC8, CRC16 = 0x07, 0x8005


@cache
def crc_table(bits: int, polynomial: int) -> np.ndarray:
    table = np.arange(256, dtype=np.int64) << (bits - 8)
    for _ in range(8):
        table = np.where(table >> (bits - 1) & 1, table << 1 ^ polynomial, table << 1) & ((1 << bits) - 1)
    return table


def checksums(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, bits: int, polynomial: int) -> np.ndarray:
    """The checksum of each run of bytes, all runs in step."""
    table, crc = crc_table(bits, polynomial), np.zeros(len(starts), np.int64)
    order = np.argsort(-sizes, kind="stable")
    at, left = starts[order], sizes[order]
    value = crc[order]
    live = np.searchsorted(-left, -np.arange(1, int(left[0]) + 1), "right") if len(left) else []
    mask = (1 << bits) - 1
    for i, n in enumerate(live):
        value[:n] = (value[:n] << 8 & mask) ^ table[value[:n] >> (bits - 8) ^ data[at[:n] + i]]
    crc[order] = value
    return crc


def _number(n: int) -> bytes:
    """A frame number, coded like a code point but up to 36 bits."""
    if n < 128:
        return bytes([n])
    tail = []
    more = 1
    while n >= 1 << (6 - more):
        tail.append(0x80 | n & 63)
        n >>= 6
        more += 1
    return bytes([(0xFF00 >> more) & 0xFF | n, *tail[::-1]])


@cache
def _header(number: int, size: int) -> bytes:
    known = 8 + (size // 256).bit_length() - 1 if size in (256, 512, 1024, 2048, 4096) else 0
    head = bytes([0xFF, 0xF8, (known or 7) << 4, 0x02]) + _number(number) + (b"" if known else struct.pack(">H", size - 1))
    raw = np.frombuffer(head, np.uint8)
    return head + bytes([int(checksums(raw, np.array([0]), np.array([len(raw)]), 8, CRC8)[0])])


def _rice(left: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Zigzag codes, the Rice parameters of the partitions, how many there are (1 or PARTITIONS), and the bits of each row of residuals with the parameters."""
    n, long = inside.shape
    code = np.where(inside, left << 1 ^ left >> 31, 0)

    def parameters(codes: np.ndarray, counted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        many = counted.sum(axis=-1)
        mean = codes.sum(axis=-1) / np.maximum(many, 1)
        k = np.clip(np.log2(np.maximum(mean * 0.7, 1)).astype(np.int64), 0, 14)
        return k, (codes >> k[..., None]).sum(axis=-1, dtype=np.int64) + many * (1 + k) + 4

    whole, bits = parameters(code, inside)
    cut = (n, PARTITIONS, long // PARTITIONS)
    parts, each = parameters(code.reshape(cut), inside.reshape(cut))
    # partitions of a size of their own are for full frames
    split = (each.sum(axis=1) < bits) & inside[:, -1]
    return code, np.where(split[:, None], parts, whole[:, None]), np.where(split, PARTITIONS, 1), np.where(split, each.sum(axis=1), bits)


def _predictors(samples: np.ndarray) -> np.ndarray:
    """The coefficients, times 1 << SHIFT, of a linear predictor of order LINEAR for each row: Levinson's recursion on the row's autocorrelation."""
    x = samples.astype(np.float64)
    lags = np.stack([(x[:, : x.shape[1] - j] * x[:, j:]).sum(axis=1) for j in range(LINEAR + 1)], axis=1)
    error, factors = np.maximum(lags[:, 0] * (1 + 1e-9), 1e-9), np.zeros((len(x), LINEAR))
    for i in range(LINEAR):
        reflection = (lags[:, i + 1] - (factors[:, :i] * lags[:, i:0:-1]).sum(axis=1)) / error
        factors[:, :i] -= reflection[:, None] * factors[:, :i][:, ::-1]
        factors[:, i] = reflection
        error = np.maximum(error * (1 - reflection * reflection), 1e-9)
    most = (1 << (PRECISION - 1)) - 1
    return np.clip(np.rint(factors * (1 << SHIFT)), -most - 1, most).astype(np.int32)


def _frames(samples: np.ndarray, number: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, sizes) of frames of ``many`` samples each; rows of ``samples`` are as long as a frame, zeros behind."""
    n = len(samples)
    lay = np.arange(FRAME)
    inside = lay < many[:, None]
    # the smallest of: verbatim (-1), fixed predictors of order 0 to 2, a linear one (LINE)
    best, kind, line = many * 8, np.full(n, -1), 3
    codes, ks, parts = np.zeros((n, FRAME), np.int32), np.zeros((n, PARTITIONS), np.int64), np.ones(n, np.int64)
    left, factors = samples, _predictors(samples)
    for order in range(line + 1):
        if order == line:
            guess = np.zeros((n, FRAME), np.int32)
            for j in range(LINEAR):
                guess[:, LINEAR:] += factors[:, j : j + 1] * samples[:, LINEAR - 1 - j : FRAME - 1 - j]
            left, warm, own = samples - (guess >> SHIFT), LINEAR, 9 + LINEAR * PRECISION
        else:
            left = np.concatenate([np.zeros((n, 1), np.int32), np.diff(left, axis=1)], axis=1) if order else left
            warm, own = order, 0
        code, k, part, bits = _rice(left, inside & (lay >= warm))
        bits = bits + 8 * warm + own + 6
        better = (bits < best) & (many > warm)
        best = np.where(better, bits, best)
        kind[better], ks[better], parts[better], codes[better] = order, k[better], part[better], code[better]
    constant = np.all((samples == samples[:, :1]) | ~inside, axis=1)
    kind[constant], best[constant] = -2, 8
    warm = np.where(kind == line, LINEAR, np.maximum(kind, 0))
    heads = [_header(a, b) for a, b in zip(number.tolist(), many.tolist(), strict=True)]
    head = np.array([len(h) for h in heads], np.int64)
    total = head + 1 + -(-best // 8) + 2
    start = np.cumsum(total) - total
    bits = np.zeros(int(total.sum()) * 8, np.uint8)

    def put(at: np.ndarray, value: np.ndarray, width: int) -> None:
        for b in range(width):
            bits[at + b] = value >> (width - 1 - b) & 1

    linear, coded = np.flatnonzero(kind == line), np.flatnonzero(kind >= 0)
    base = (start + head + 1 + warm) * 8  # behind the warm-up samples
    put(base[linear], np.full(len(linear), PRECISION - 1), 4)
    put(base[linear] + 4, np.full(len(linear), SHIFT), 5)
    for j in range(LINEAR):
        put(base[linear] + 9 + PRECISION * j, factors[linear, j], PRECISION)
    base[linear] += 9 + PRECISION * LINEAR
    put(base[coded] + 2, np.where(parts[coded] > 1, PARTITIONS.bit_length() - 1, 0), 4)
    # Rice codes, the first of a partition behind its parameter
    use = inside & (lay >= warm[:, None]) & (kind >= 0)[:, None]
    row, column = np.nonzero(use)
    part = np.where(parts[row] > 1, column * PARTITIONS // FRAME, 0)
    code, k = codes[use].astype(np.int64), ks[row, part]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (part[1:] != part[:-1])
    zeros = code >> k
    length = zeros + 1 + k + 4 * first
    run = np.cumsum(length) - length
    firsts = np.searchsorted(row, np.arange(n), "left")
    at = base[row] + 6 + run - np.append(run, 0)[firsts][row]
    put(at[first], k[first], 4)
    at += 4 * first + zeros
    bits[at] = 1
    for b in range(int(k.max(initial=0))):
        some = k > b
        bits[at[some] + 1 + b] = code[some] >> (k[some] - 1 - b) & 1
    out = np.packbits(bits)
    # headers, subframe types, warm-up and verbatim samples are whole bytes
    joined = np.frombuffer(b"".join(heads), np.uint8)
    within = np.arange(len(joined)) - np.repeat(np.cumsum(head) - head, head)
    out[np.repeat(start, head) + within] = joined
    out[start + head] = np.select([kind == line, kind >= 0, kind == -1], [31 + LINEAR, 8 + kind, 1], 0) << 1
    plain = np.where(kind == -1, many, np.where(kind == -2, 1, warm))
    raw = lay < plain[:, None]
    out[(start + head + 1)[:, None].repeat(FRAME, 1)[raw] + np.broadcast_to(lay, raw.shape)[raw]] = samples[raw].astype(np.int8).view(np.uint8)
    crc = checksums(out, start, total - 2, 16, CRC16)
    out[start + total - 2], out[start + total - 1] = crc >> 8, crc & 255
    return out, total


def encode(payloads: list[bytes]) -> list[bytes]:
    """A FLAC stream of 8-bit samples, byte - 128 each, for every non-empty payload."""
    size = np.array([len(p) for p in payloads], np.int64)
    each = -(-size // FRAME)
    owner = np.repeat(np.arange(len(size)), each)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each)
    many = np.minimum(FRAME, size[owner] - number * FRAME)
    whole = np.frombuffer(b"".join(payloads), np.uint8)
    upto = np.concatenate([[0], np.cumsum(many)])
    coded, totals = [], []
    for k in range(0, len(owner), FRAMES):
        part = many[k : k + FRAMES]
        samples = np.zeros((len(part), FRAME), np.int32)
        samples[np.arange(FRAME) < part[:, None]] = whole[upto[k] : upto[min(k + FRAMES, len(owner))]].astype(np.int32) - 128
        out, total = _frames(samples, number[k : k + FRAMES], part)
        coded.append(out.tobytes())
        totals.append(total)
    audio, total = b"".join(coded), np.concatenate(totals) if totals else np.zeros(0, np.int64)
    start = np.cumsum(total) - total
    streams = []
    first = np.cumsum(each) - each
    for i, p in enumerate(payloads):
        a, b = int(first[i]), int(first[i] + each[i])
        begin, end = int(start[a]), int(start[b - 1] + total[b - 1])
        points = np.zeros(b - a, [("sample", ">u8"), ("byte", ">u8"), ("size", ">u2")])
        points["sample"], points["byte"], points["size"] = number[a:b] * FRAME, start[a:b] - begin, many[a:b]
        signed = (np.frombuffer(p, np.uint8) ^ 128).tobytes()  # byte - 128 in two's complement
        least = int(many[a:b].min()) if b - a == 1 else FRAME
        packed = RATE << 44 | 0 << 41 | 7 << 36 | len(p)
        info = struct.pack(">HH", least, max(least, int(many[a:b].max()))) + int(total[a:b].min()).to_bytes(3, "big") + int(total[a:b].max()).to_bytes(3, "big") + packed.to_bytes(8, "big") + hashlib.md5(signed).digest()
        table = points.tobytes()
        if len(table) >= 1 << 24:
            raise ValueError("a text is too long for one stream's seek table: 16 MB of points are some 470 MB of text")
        streams.append(b"fLaC" + bytes([0]) + len(info).to_bytes(3, "big") + info + bytes([0x83]) + len(table).to_bytes(3, "big") + table + audio[begin:end])
    return streams


class Stream:
    """What a stream's metadata say: sample count, bits, MD5, where the audio begins, and the seek points (first sample, byte from there, samples)."""

    def __init__(self, raw: bytes) -> None:
        if raw[:4] != b"fLaC":
            raise ValueError("not a FLAC stream")
        at, last = 4, False
        self.points = np.zeros((0, 3), np.int64)
        while not last:
            last, kind, size = raw[at] >> 7 == 1, raw[at] & 127, int.from_bytes(raw[at + 1 : at + 4], "big")
            body = raw[at + 4 : at + 4 + size]
            if kind == 0:
                packed = int.from_bytes(body[10:18], "big")
                self.bits, self.samples, self.md5 = (packed >> 36 & 31) + 1, packed & (1 << 36) - 1, body[18:34]
                if packed >> 41 & 7:
                    raise ValueError("more than one channel")
            elif kind == 3:
                p = np.frombuffer(body, [("sample", ">u8"), ("byte", ">u8"), ("size", ">u2")])
                p = p[p["sample"] != np.uint64(2**64 - 1)]
                self.points = np.stack([p[c].astype(np.int64) for c in ("sample", "byte", "size")], axis=1)
            at += 4 + size
        self.audio = at


class Bits:
    """A reading place in each of many frames."""

    def __init__(self, data: np.ndarray, at: np.ndarray) -> None:
        self.data = np.concatenate([data, np.zeros(16, np.uint8)])
        self.eight = np.ndarray((len(self.data) - 7,), ">u8", self.data.data, 0, (1,))
        self.most = len(data) * 8
        self.at = at

    def window(self, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        """At least 57 bits from each place on, left-aligned."""
        at = np.minimum(self.at[rows], self.most)
        return self.eight[at >> 3].astype(np.uint64) << (at & 7).astype(np.uint64)

    def take(self, n: np.ndarray, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        value = (self.window(rows) >> (np.uint64(64) - n.astype(np.uint64))).astype(np.int64)
        value = np.where(n > 0, value, 0)
        self.at[rows] += n
        return value

    def signed(self, n: np.ndarray, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        value = self.take(n, rows)
        return value - np.where((n > 0) & (value >> np.maximum(n - 1, 0) & 1 == 1), np.int64(1) << n, 0)

    def zeros(self, rows: np.ndarray) -> np.ndarray:
        """The length of a run of zeros, which is read with the one behind it."""
        count = LEADING[(self.window(rows) >> np.uint64(48)).astype(np.int64)].astype(np.int64)
        more = np.flatnonzero(count == 16)
        while len(more):
            place = self.at[rows[more]] + count[more]
            if (place >= self.most).any():
                raise ValueError("a frame ends within a code")
            w = self.eight[place >> 3].astype(np.uint64) << (place & 7).astype(np.uint64)
            extra = LEADING[(w >> np.uint64(48)).astype(np.int64)].astype(np.int64)
            count[more] += extra
            more = more[extra == 16]
        self.at[rows] += count + 1
        return count


LEADING = np.full(1 << 16, 16, np.uint8)
for _k in range(15, -1, -1):
    LEADING[1 << (15 - _k) : 1 << (16 - _k)] = _k


def decode_frames(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Samples (frames, longest), sizes and frame numbers of frames that fill starts:ends; raises if a checksum is wrong."""
    n = len(starts)
    crc = checksums(data, starts, ends - starts - 2, 16, CRC16)
    if (crc != (data[ends - 2].astype(np.int64) << 8 | data[ends - 1])).any():
        raise ValueError("a frame's checksum is wrong")
    if (data[starts] != 0xFF).any() or (data[starts + 1] != 0xF8).any() or (data[starts + 3] >> 4).any():
        raise ValueError("not a frame of one channel and fixed size")
    code = (data[starts + 2] >> 4).astype(np.int64)
    lead = data[starts + 4].astype(np.int64)
    tail = np.zeros(n, np.int64)
    for k in range(5):
        tail = np.where(lead >> (5 - k) == (1 << (k + 3)) - 2, k + 1, tail)
    number = np.where(tail == 0, lead, lead & ((1 << np.maximum(6 - tail, 0)) - 1))
    for k in range(int(tail.max(initial=0))):
        number = np.where(tail > k, number << 6 | data[np.minimum(starts + 5 + k, len(data) - 1)] & 63, number)
    at = starts + 5 + tail
    size = np.select([code == 1, (code >= 2) & (code <= 5), code == 6, code == 7], [192, 576 << np.maximum(code - 2, 0), data[at].astype(np.int64) + 1, (data[at].astype(np.int64) << 8 | data[at + 1]) + 1], 256 << np.maximum(code - 8, 0))
    at = at + np.select([code == 6, code == 7], [1, 2], 0)
    rate = data[starts + 2] & 15
    at = at + np.select([rate == 12, rate >= 13], [1, 2], 0)
    if (checksums(data, starts, at - starts, 8, CRC8) != data[at]).any():
        raise ValueError("a header's checksum is wrong")
    kind, flag = (data[at + 1] >> 1 & 63).astype(np.int64), data[at + 1] & 1
    if flag.any():
        raise ValueError("wasted bits are not written by this encoder")
    read = Bits(data, (at + 2) * 8)
    longest = int(size.max(initial=0))
    out = np.zeros((n, longest), np.int64)
    constant, verbatim = np.flatnonzero(kind == 0), np.flatnonzero(kind == 1)
    out[constant] = read.signed(bits[constant], constant)[:, None]
    for t in range(int(size[verbatim].max(initial=0))):
        rows = verbatim[size[verbatim] > t]
        out[rows, t] = read.signed(bits[rows], rows)
    order = np.where(kind >= 32, kind - 31, np.where((kind >= 8) & (kind <= 12), kind - 8, -1))
    coded = np.flatnonzero(order >= 0)
    if len(coded) + len(constant) + len(verbatim) != n:
        raise ValueError("an unknown kind of subframe")
    for t in range(int(order.max(initial=0))):
        rows = coded[order[coded] > t]
        out[rows, t] = read.signed(bits[rows], rows)
    linear = coded[kind[coded] >= 32]
    factor, shift = np.zeros((n, 32), np.int64), np.zeros(n, np.int64)
    if len(linear):
        four, five = np.full(len(linear), 4), np.full(len(linear), 5)
        width = np.zeros(n, np.int64)
        width[linear] = read.take(four, linear) + 1
        shift[linear] = read.signed(five, linear)
        for t in range(int(order[linear].max())):
            rows = linear[order[linear] > t]
            factor[rows, t] = read.signed(width[rows], rows)
    residuals(read, out, coded, order, size)
    restore(out, coded, kind, order, size, factor, shift)
    if (-(-read.at // 8) != ends - 2).any():
        raise ValueError("a frame has a wrong length")
    return out, size, number


def residuals(read: Bits, out: np.ndarray, coded: np.ndarray, order: np.ndarray, size: np.ndarray) -> None:
    """Rice-coded residuals into ``out``, behind the warm-up samples."""
    if not len(coded):
        return
    n = len(order)
    two, four = np.full(n, 2), np.full(n, 4)
    wide = np.zeros(n, np.int64)
    wide[coded] = 4 + read.take(two[coded], coded)
    if (wide[coded] > 5).any():
        raise ValueError("an unknown residual code")
    parts = np.zeros(n, np.int64)
    parts[coded] = read.take(four[coded], coded)
    part = size >> parts
    k, raw = np.zeros(n, np.int64), np.full(n, -1)
    coded = coded[np.argsort(-(size - order)[coded], kind="stable")]
    left = (size - order)[coded]
    single = not parts[coded].any()
    escapes = False
    for t in range(int(left[0])):
        rows = coded[: int(np.searchsorted(-left, -t, "left"))]  # those with more than t residuals
        if t == 0 or not single:
            new = rows if t == 0 else rows[(order[rows] + t) % part[rows] == 0]
            if len(new):
                k[new] = read.take(wide[new], new)
                raw[new] = -1
                escaped = new[k[new] == (1 << wide[new]) - 1]
                if len(escaped):
                    escapes = True
                    raw[escaped] = read.take(np.full(len(escaped), 5), escaped)
        if escapes and (raw[rows] >= 0).any():
            plain = rows[raw[rows] >= 0]
            out[plain, order[plain] + t] = read.signed(raw[plain], plain)
            rows = rows[raw[rows] < 0]
            if not len(rows):
                continue
        high = read.zeros(rows)
        code = high << k[rows] | read.take(k[rows], rows)
        out[rows, order[rows] + t] = code >> 1 ^ -(code & 1)


def restore(out: np.ndarray, coded: np.ndarray, kind: np.ndarray, order: np.ndarray, size: np.ndarray, factor: np.ndarray, shift: np.ndarray) -> None:
    """Residuals to samples, in place: repeated sums for fixed predictors, a step per sample for linear ones."""
    for o in range(1, 5):
        rows = coded[kind[coded] == 8 + o]
        if len(rows):
            ends = [np.diff(out[rows, :o], n=j, axis=1)[:, -1:] for j in range(o)]  # last warm-up difference of each degree
            run = out[rows, o:]
            for j in range(o - 1, -1, -1):
                run = ends[j] + np.cumsum(run, axis=1)
            out[rows, o:] = run
    linear = coded[kind[coded] >= 32]
    for o in np.unique(order[linear]).tolist():
        rows = linear[order[linear] == o]
        # sample by sample, each a row of its own; what is worked out behind a shorter frame's end is not read
        own, by, down = np.ascontiguousarray(out[rows].T), np.ascontiguousarray(factor[rows, :o].T), shift[rows]
        for t in range(o, int(size[rows].max())):
            past = by[0] * own[t - 1]
            for j in range(1, o):
                past += by[j] * own[t - 1 - j]
            own[t] += past >> down
        out[rows] = own.T


def decode(streams: list[bytes]) -> list[tuple[Stream, np.ndarray, np.ndarray]]:
    """(stream, samples, first sample of each frame) of every stream; MD5 sums are checked. Streams have a seek point for each frame."""
    infos = [Stream(s) for s in streams]
    data = np.frombuffer(b"".join(streams), np.uint8)
    base = np.cumsum([0, *(len(s) for s in streams)])
    starts = [base[i] + x.audio + x.points[:, 1] for i, x in enumerate(infos)]
    ends = [np.append(s[1:], base[i + 1]) for i, s in enumerate(starts)]
    many = np.array([len(s) for s in starts])
    flat, stop = np.concatenate(starts), np.concatenate(ends)
    bits = np.repeat([x.bits for x in infos], many).astype(np.int64)
    # the samples of one stream after the other, in two bytes or four
    wide = np.repeat([-(-x.bits // 8) for x in infos], many)
    parts, size, number = [], [], []
    for k in range(0, len(flat), FRAMES):
        lot = slice(k, k + FRAMES)
        samples, each, nth = decode_frames(data, flat[lot], stop[lot], bits[lot])
        kind = np.int16 if wide[lot].max(initial=1) == 1 else np.int32
        parts.append(samples[np.arange(samples.shape[1]) < each[:, None]].astype(kind))
        size.append(each)
        number.append(nth)
    joined, size, number = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (parts, size, number))
    upto = np.concatenate([[0], np.cumsum(size)])
    out, at = [], 0
    for x, m in zip(infos, many.tolist(), strict=True):
        own, each = joined[upto[at] : upto[at + m]], size[at : at + m]
        first = np.cumsum(each) - each
        if (number[at : at + m] != np.arange(m)).any() or (x.points[:, 0] != first).any() or len(own) != x.samples:
            raise ValueError("frames or seek points are out of place")
        if hashlib.md5(own.astype(f"<i{-(-x.bits // 8)}").tobytes()).digest() != x.md5:
            raise ValueError("a stream's MD5 is wrong")
        out.append((x, own, first))
        at += m
    return out


def blocks_of(samples: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(first sample, PCM bytes) of each frame of a stream of 8-bit samples."""
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(samples)], strict=True):
        yield a, samples[a:b].astype(np.int8).tobytes()


def payload(raw: bytes) -> bytes:
    """The bytes, with bytes 0 up to a positive multiple of 64."""
    return raw + bytes(-len(raw) % 64 if raw else 64)


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_bytes(batches, "raw", BATCH_BYTES):
        raw = batch.column("raw").to_pylist()
        yield pa.record_batch([batch.column(0), pa.array([len(r) for r in raw], pa.int64()), pa.array(encode([payload(r) for r in raw]), pa.binary())], ["id", "n_bytes", "media"])


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zlib

    for batch in by_bytes(batches, "media", BATCH_BYTES):
        media = batch.column("media").to_pylist()
        rows = []
        for raw, (_, samples, first) in zip(media, decode(media), strict=True):
            # the payload from the PCM blocks, each at its offset
            body = bytearray(len(samples))
            for at, pcm in blocks_of(samples, first):
                body[at : at + len(pcm)] = (np.frombuffer(pcm, np.uint8) ^ 128).tobytes()
            body, samples = bytes(body), samples.astype(np.int32)
            change = np.abs(np.diff(samples))
            feature = f"frames={len(first)};peak={int(np.abs(samples).max())};energy={int((samples * samples).sum() // len(samples))};change={int(change.sum() // max(1, len(change)))};crossings={int(((samples[1:] < 0) != (samples[:-1] < 0)).sum())}"
            rows.append((len(body), hashlib.sha256(body).hexdigest(), zlib.crc32(body[-64:]), len(raw), hashlib.sha256(raw).hexdigest(), feature))
        columns = list(zip(*rows, strict=True))
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
        yield pa.record_batch([batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_bytes(batches, "media", BATCH_BYTES):
        rows = []
        for i, (_, samples, first) in zip(batch.column(0).to_pylist(), decode(batch.column("media").to_pylist()), strict=True):
            rows += ((i, k, a, len(pcm), pcm) for k, (a, pcm) in enumerate(blocks_of(samples, first)))
        columns = list(zip(*rows, strict=True))
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, (batch.schema.field(0).type, pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["id", "block", "first_sample", "samples", "pcm"])


def store(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, media): each text's UTF-8 bytes as a FLAC stream of 8-bit samples.

    The payload is the bytes and zeros up to a positive multiple of 64, so a null or empty text is one short frame of zeros. Equal texts give equal
    streams. Repeated rows are stored each, a null key is kept, extra columns are not read, and an empty table gives no rows.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("raw"))
    return rows.mapInArrow(_store, f"id {kind}, n_bytes long, media binary").withColumnRenamed("id", key)


def pcm_blocks(media: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, block, first_sample, samples, pcm) of 8-bit streams: one row a frame, seekable by first_sample. A null stream has no blocks."""
    kind = media.schema[key].dataType.simpleString()
    rows = media.where("media is not null").select(F.col(key).alias("id"), "media")
    return rows.mapInArrow(_blocks, f"id {kind}, block long, first_sample long, samples long, pcm binary").withColumnRenamed("id", key)


def probe(media: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, n_bytes, payload_bytes, payload_sha256, tail_crc32 (of the last 64 bytes), media_bytes, media_sha256 and feature of each stored stream, decoded."""
    kind = media.schema[key].dataType.simpleString()
    rows = media.where("media is not null").select(F.col(key).alias("id"), "n_bytes", "media")
    schema = f"id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return rows.mapInArrow(_probe, schema).withColumnRenamed("id", key)
