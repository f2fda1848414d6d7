import base64
import hashlib
import io
import random

import pytest

from recordloom.llm import warc


def brute(pages, least=0):
    low = {}
    for i, h in pages:
        if i is not None:
            low[h or ""] = min(i, low.get(h or "", i))
    out = []
    for i, h in pages:
        raw = (h or "").encode()
        first = low.get(h or "") if len(raw) >= least else None
        again = i is not None and first is not None and first < i
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least,chunk", [(0, 64 << 10), (5, 3)])
def test_round_trip(spark, tmp_path, least, chunk):
    r = random.Random(least)
    texts = ["", None, "a", "né\r\n\r\nWARC/1.1\r\n", "x" * (300_000 if chunk > 3 else 50), "<html>" * 9]
    pages = [(k, r.choice(texts)) for k in range(5, 90)] + [(k, f"page {k}") for k in range(100, 130)] + [(7, "again"), (7, "again"), (None, "null")]
    r.shuffle(pages)
    table = spark.createDataFrame([(i, None if i == 6 else f"http://x/{i} y\r\nz", h, "d") for i, h in pages], "page_id long, url string, html string, digest string")
    manifest = warc.write(table, f"file://{tmp_path}/out", least_bytes=least, chunk=chunk)
    got = sorted(((x.page_id, x.payload_bytes, x.payload_digest, x.record_type, x.refers_to) for x in warc.read(manifest).collect()), key=str)
    assert got == brute(pages, least)
    assert not list(tmp_path.rglob("*.tmp")) and manifest.agg({"records": "sum"}).first()[0] == len(pages)
    bodies = {}
    for x in sorted(warc.read_chunks(manifest, 1000).where("record_type = 'response' and page_id >= 100").collect(), key=lambda x: x.chunk):
        bodies[x.page_id] = bodies.get(x.page_id, b"") + bytes(x.data)
        assert x.digest == base64.b32encode(hashlib.sha1(bodies[x.page_id]).digest()).decode()
    assert bodies == {k: f"page {k}".encode() for k in range(100, 130)}
    assert warc.read(warc.write(table.limit(0))).collect() == []


def test_damage_is_told():
    out = io.BytesIO()
    member = warc.Member(out, 1, "u", 3, hashlib.sha1(b"abc").digest(), None)
    member.chunk(b"abd")
    with pytest.raises(ValueError):
        member.close()
    good = warc.VERSION + b"WARC-Type: response\r\nWARC-Payload-Digest: sha1:X\r\nContent-Length: 41\r\n\r\nHTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(good)))
