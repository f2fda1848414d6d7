import zlib

from recordloom.llm.sharding import MULTIPLIER, shard


def jump(key, n):
    key, b, j = key & (1 << 64) - 1, -1, 0
    while j < n:
        b = j
        key = (key * MULTIPLIER + 1) & (1 << 64) - 1
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_matches_the_published_walk(spark):
    docs = spark.createDataFrame([(k * 7919 - 3_000_000, "é" * (k % 5)) for k in range(2000)] + [(2**63 - 1, "x"), (-(2**63), None)], "doc_id long, text string")
    for n in (1, 2, 24, 1000):
        out = rows(shard(docs, n))
        assert len(out) == 2002
        for r in out:
            assert r["shard"] == jump(r["doc_id"], n) and r["grown_shard"] == jump(r["doc_id"], n + 1)
            assert r["grown_shard"] in (r["shard"], n)
        for s in {r["shard"] for r in out}:
            mine = sorted(r["slot"] for r in out if r["shard"] == s)
            assert mine == list(range(len(mine)))


def test_sizes_nulls_repeats_and_extra_columns(spark):
    docs = spark.createDataFrame([(1, "aé", 5), (1, "aé", 6), (2, None, 7), (None, "", 8), (3, "x" * 300_000, 9)], "doc_id long, text string, shard int")
    out = sorted(rows(shard(docs, 3)), key=lambda r: (r["doc_id"] or 0, r["slot"]))
    assert [r["size"] for r in out] == [8, 11, 11, 8, 300_008]
    assert [r["text_crc32"] for r in out] == [0, zlib.crc32("aé".encode()), zlib.crc32("aé".encode()), 0, zlib.crc32(b"x" * 300_000)]
    assert out[1]["shard"] == out[2]["shard"] and out[1]["slot"] != out[2]["slot"]
    assert out[0]["shard"] == jump(0, 3) and out[0]["doc_id"] is None
    assert shard(docs.limit(0), 3).collect() == []
