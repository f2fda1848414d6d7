import hashlib
import random
import struct
import zlib

import numpy as np
import pytest

from recordloom.llm import flac


def crc(raw, bits, polynomial):
    value = 0
    for byte in raw:
        value ^= byte << (bits - 8)
        for _ in range(8):
            value = (value << 1 ^ polynomial if value >> (bits - 1) else value << 1) & ((1 << bits) - 1)
    return value


class Writer:
    def __init__(self):
        self.bits = []

    def put(self, value, n):
        self.bits += [value >> (n - 1 - k) & 1 for k in range(n)]

    def rice(self, r, k):
        u = r << 1 if r >= 0 else (-r << 1) - 1
        self.bits += [0] * (u >> k) + [1]
        self.put(u & ((1 << k) - 1), k)

    def bytes(self):
        self.bits += [0] * (-len(self.bits) % 8)
        return np.packbits(np.array(self.bits, np.uint8)).tobytes()


def frame(number, size, body):
    head = bytes([0xFF, 0xF8, 0x70, 0x02]) + flac._number(number) + struct.pack(">H", size - 1)
    head += bytes([crc(head, 8, 0x07)])
    raw = head + body
    return raw + struct.pack(">H", crc(raw, 16, 0x8005))


def test_checksums_and_numbers():
    raw = bytes(range(256)) * 2
    data = np.frombuffer(raw, np.uint8)
    for bits, poly in ((8, 0x07), (16, 0x8005)):
        got = flac.checksums(data, np.array([0, 3, 100]), np.array([512, 1, 77]), bits, poly)
        assert got.tolist() == [crc(raw, bits, poly), crc(raw[3:4], bits, poly), crc(raw[100:177], bits, poly)]
    assert [flac._number(n) for n in (5, 300, 70000)] == [chr(n).encode() for n in (5, 300, 70000)]


@pytest.mark.parametrize("order,factors,shift", [(1, [1], 0), (2, [7, -3], 2), (5, [4, -3, 2, -1, 1], 1)])
def test_linear_prediction_partitions_and_escapes(order, factors, shift):
    r = random.Random(order)
    samples = [max(-128, min(127, int(60 * np.sin(k / 5)) + r.randrange(-9, 9))) for k in range(64)]
    w = Writer()
    w.put((31 + order) << 1, 8)
    for s in samples[:order]:
        w.put(s & 255, 8)
    w.put(5, 4)  # precision 6
    w.put(shift, 5)
    for f in factors:
        w.put(f & 63, 6)
    w.put(0, 2)
    w.put(2, 4)  # four partitions
    for p in range(4):
        part = [k for k in range(p * 16, p * 16 + 16) if k >= order]
        left = [samples[k] - (sum(f * samples[k - 1 - i] for i, f in enumerate(factors)) >> shift) for k in part]
        if p == 2:
            w.put(15, 4)
            w.put(12, 5)
            for x in left:
                w.put(x & 4095, 12)
        else:
            w.put(p, 4)
            for x in left:
                w.rice(x, p)
    raw = frame(0, 64, w.bytes())
    got, size, number = flac.decode_frames(np.frombuffer(raw, np.uint8), np.array([0]), np.array([len(raw)]), np.array([8]))
    assert got[0].tolist() == samples and size.tolist() == [64] and number.tolist() == [0]


@pytest.mark.parametrize("order", range(5))
def test_fixed_orders(order):
    r = random.Random(order)
    samples = [r.randrange(-100, 100) for _ in range(40)]
    left = np.diff(np.array(samples), n=order).tolist()
    w = Writer()
    w.put((8 + order) << 1, 8)
    for s in samples[:order]:
        w.put(s & 255, 8)
    w.put(1, 2)  # parameters of five bits
    w.put(0, 4)
    w.put(6, 5)
    for x in left:
        w.rice(x, 6)
    raw = frame(200, 40, w.bytes())
    got, _, number = flac.decode_frames(np.frombuffer(raw, np.uint8), np.array([0]), np.array([len(raw)]), np.array([8]))
    assert got[0].tolist() == samples and number.tolist() == [200]


def payloads():
    r = random.Random(7)
    out = [b"", b"a", b"x" * 64, b"x" * 5000, bytes(r.randrange(256) for _ in range(3000)), bytes([0, 255] * 700), "naïve text, ".encode() * 90, b"q" * 511 + b"z" * 2]
    return out + [" ".join(r.choice(["the", "ém", "of", "word"]) for _ in range(n)).encode() for n in (1, 20, 400, 40_000)]


def test_round_trip_and_damage():
    want = [flac.payload(p) for p in payloads()]
    media = flac.encode(want)
    for (_, samples, first), p in zip(flac.decode(media), want):
        assert (samples + 128).astype(np.uint8).tobytes() == p and first.tolist() == list(range(0, len(p), flac.FRAME))
    for at in (-1, -20, 8):
        bad = bytearray(media[6])
        bad[at if at < 0 else flac.Stream(media[6]).audio + at] ^= 4
        with pytest.raises(ValueError):
            flac.decode([bytes(bad)])


def test_queries(spark):
    texts = [p.decode("latin-1") for p in payloads()] + [None]
    docs = spark.createDataFrame([(i, t, b"") for i, t in enumerate(texts)] + [(None, "x", b"")], "doc_id long, text string, media binary")
    media = flac.store(docs).cache()
    got = {x.doc_id: x for x in flac.probe(media).collect()}
    assert len(got) == len(texts) + 1
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        p = flac.payload(raw)
        x = got[i]
        assert (x.n_bytes, x.payload_bytes, x.payload_sha256, x.tail_crc32) == (len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
    blocks = sorted(flac.pcm_blocks(media.where("doc_id = 9")).collect(), key=lambda b: b.block)
    assert b"".join(bytes(c ^ 128 for c in b.pcm) for b in blocks) == flac.payload(texts[9].encode())
    assert flac.probe(flac.store(docs.limit(0))).collect() == [] and flac.pcm_blocks(media.limit(0)).collect() == []


def test_what_the_encoder_writes(monkeypatch):
    """Prose is written with linear prediction, loud and quiet parts in Rice partitions of their own, whatever the number of frames coded together."""
    r = random.Random(6)
    prose = " ".join(r.choice(["die", "the", "und", "of", "ación", "schön"]) + r.choice(["", "en", "ing"]) for _ in range(3000)).encode()
    uneven = b"".join(bytes(r.randrange(60, 68) for _ in range(384)) + bytes(r.randrange(256) for _ in range(128)) for _ in range(9))
    want = [flac.payload(p) for p in (prose, uneven, b"ab" * 5000, b"x" * 9, b"")]
    whole = flac.encode(want)
    kinds, parts = set(), 0
    for stream in whole:
        x = flac.Stream(stream)
        for _, at, size in x.points.tolist():
            head = 6 + (2 if stream[x.audio + at + 2] >> 4 == 7 else 0)
            kind = stream[x.audio + at + head] >> 1
            kinds.add(kind)
            if kind == 9:  # one warm-up sample, then the residuals' header
                parts += stream[x.audio + at + head + 2] >> 2 & 15 == 2
    assert 31 + flac.LINEAR in kinds and 0 in kinds and parts
    for frames in (1, 7):
        monkeypatch.setattr(flac, "FRAMES", frames)
        assert flac.encode(want) == whole
        assert [(s + 128).astype(np.uint8).tobytes() for _, s, _ in flac.decode(whole)] == want
