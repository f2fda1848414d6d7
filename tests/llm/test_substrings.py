import hashlib
import random
import re

import numpy as np
import pytest

from recordloom.llm import suffix
from recordloom.llm.anchors import scanner
from recordloom.llm.rlz import deduplicate, parse, stripped

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, width=20):
    """docs: (doc_id, text) in any order, ids distinct or null."""
    low = lambda i: -(2**63) if i is None else i
    seen, out = {}, {}
    for i, t in sorted(docs, key=lambda d: low(d[0])):
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            s = tuple(w[k : k + width])
            if seen.setdefault(s, (low(i), k)) < (low(i), k):
                gone[k : k + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    return out


def corpus(seed, n=120):
    r = random.Random(seed)
    vocab = [f"w{k}é" if k % 7 == 0 else f"w{k}" for k in range(60)]
    prose = lambda m: [r.choice(vocab) for _ in range(m)]
    passage, docs = prose(45), []
    for i in range(n):
        kind = r.randrange(8)
        w = prose(r.choice([0, 3, 19, 20, 21, 60, 150]))
        if kind < 3 and docs:  # a near copy
            w = WORD.findall(r.choice(docs)[1] or "")
            for _ in range(r.randrange(3)):
                if w:
                    w[r.randrange(len(w))] = r.choice(vocab)
        elif kind == 3:
            at = r.randrange(len(w) + 1)
            w = w[:at] + passage[r.randrange(6) : len(passage) - r.randrange(6)] + w[at:]
        elif kind == 4:
            w = w + w + ["x"] * r.choice([0, 50])
        docs.append((i * 3 + 1, "".join(x + r.choice([" ", "\n", "  ", "\t"]) for x in w)))
    docs += [(None, docs[3][1]), (0, None), (2, ""), (5, "  \n")]
    r.shuffle(docs)
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_as_brute_force(spark, seed):
    docs = corpus(seed)
    want = brute(docs)
    got = deduplicate(spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, spans string, place int")).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_words, r.n_removed, r.kept_sha256, r.kept) == want[r.doc_id]
        assert sum(s.words for s in r.spans) == r.n_removed


def test_repeats_and_empty_tables(spark):
    text = " ".join(f"a{k}" for k in range(30))
    other = " ".join(f"b{k}" for k in range(5)) + " " + text
    docs = spark.createDataFrame([(1, text), (1, text), (1, other), (2, text)], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in deduplicate(docs).collect())
    assert got == [(1, 30, 0), (1, 30, 0), (1, 35, 30), (2, 30, 30)]
    assert deduplicate(docs.limit(0)).collect() == []


def brute_bytes(docs, width):
    """docs: (key, bytes); a list of (n_removed, n_spans, kept)."""
    count, out = {}, []
    for _, t in docs:
        for k in range(len(t) - width + 1):
            count[t[k : k + width]] = count.get(t[k : k + width], 0) + 1
    for _, t in docs:
        gone = [False] * len(t)
        for k in range(len(t) - width + 1):
            if count[t[k : k + width]] > 1:
                gone[k : k + width] = [True] * width
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((sum(gone), runs, bytes(c for c, g in zip(t, gone) if not g)))
    return out


@pytest.mark.parametrize("width,group", [(400, 1000), (400, 1), (37, 1000), (37, 3)])
def test_bytes_as_brute_force(spark, width, group):
    docs = [(k, (t or "").encode()) for k, (_, t) in enumerate(corpus(5, 60))]
    docs += [(1000, b"a" * 1500), (1001, b"a" * (width - 1)), (1002, "né".encode() * 300)]
    want = {k: w for (k, _), w in zip(docs, brute_bytes(docs, width))}
    table = spark.createDataFrame([(k, t.decode(), "x") for k, t in docs] + [(None, None, "y")], "doc_id long, text string, did string")
    got = suffix.deduplicate(table, width=width, group=group).collect()
    assert len(got) == len(docs) + 1
    for r in got:
        if r.doc_id is not None:
            assert (r.n_removed, r.n_spans, bytes(r.kept)) == want[r.doc_id], r.doc_id
            assert r.kept_sha256 == hashlib.sha256(want[r.doc_id][2]).hexdigest()
    assert suffix.deduplicate(table.limit(0)).collect() == []


def test_repeated_rows_are_partners(spark):
    docs = spark.createDataFrame([(1, "xy" * 300), (1, "ab%d" % 1 + "".join(chr(97 + k * k % 26) + str(k) for k in range(300)))] * 2, "doc_id long, text string")
    assert {r.n_removed - r.n_bytes for r in suffix.deduplicate(docs).collect()} == {0}


def shared_ids(seed, n=2000):
    """Rows without an id, and rows that repeat one with other texts."""
    r = random.Random(seed)
    passage = [f"p{k}" for k in range(80)]
    out = []
    for k in range(n):
        w = [f"v{r.randrange(10**6)}" for _ in range(r.randrange(30, 60))]
        if k % 9 == 0:
            at = r.randrange(len(w))
            w = w[:at] + passage[r.randrange(30) : 50 + r.randrange(30)] + w[at:]
        out.append((None if k % 4 else r.randrange(40), " ".join(w)))
    return out + out[:5]


def test_ids_that_are_null_or_repeated(spark):
    docs = shared_ids(3)
    low = lambda i: -(2**63) if i is None else i
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    first, want = {}, []
    for i, t in docs:
        w = t.split()
        for k in range(len(w) - 19):
            s = tuple(w[k : k + 20])
            first[s] = min(first.get(s, (low(i), k)), (low(i), k))
    for i, t in docs:
        w = t.split()
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            if first[tuple(w[k : k + 20])] < (low(i), k):
                gone[k : k + 20] = [True] * 20
        want.append((i, " ".join(x for x, g in zip(w, gone) if not g)))
    assert sorted(((r.doc_id, r.kept) for r in deduplicate(table).collect()), key=str) == sorted(want, key=str)
    assert sorted(((r.doc_id, r.text) for r in stripped(table).collect()), key=str) == sorted((x for x in want if x[1]), key=str)
    bytes_ = [(i, t.encode()) for i, t in docs]
    want = [(i, kept) for (i, _), (_, _, kept) in zip(bytes_, brute_bytes(bytes_, 60))]
    assert sorted(((r.doc_id, bytes(r.kept)) for r in suffix.deduplicate(table, width=60).collect()), key=str) == sorted(want, key=str)


def naive_parse(w, seen, mine, width=20):
    """Greedy factors of the words w: the longest match with anything that starts earlier, and on behind its last window."""
    out, k = [], 0
    while k + width <= len(w):
        best = 0
        for ref, other, at in seen.get(tuple(w[k : k + width]), ()):
            if (ref, at) < (mine, k):
                n = width
                while k + n < len(w) and at + n < len(other) and w[k + n] == other[at + n]:
                    n += 1
                best = max(best, n)
        if best:
            out.append((k, best))
            k += best - width + 1
        else:
            k += 1
    return out


def test_factors(spark):
    docs = [(i, t) for i, t in corpus(4) if i is not None]
    words = {i: WORD.findall(t or "") for i, t in docs}
    seen = {}
    for i, w in words.items():
        for k in range(len(w) - 19):
            seen.setdefault(tuple(w[k : k + 20]), []).append((i, w, k))
    got = {r.doc_id: r for r in deduplicate(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    many = 0
    for i, w in words.items():
        covered = set()
        for f in got[i].factors:
            assert f.words >= 20 and (f.document, f.at) < (i, f.start)
            assert w[f.start : f.start + f.words] == words[f.document][f.at : f.at + f.words]
            covered |= set(range(f.start, f.start + f.words))
        naive = naive_parse(w, seen, i)
        assert covered == {x for a, n in naive for x in range(a, a + n)}
        assert [f.start for f in got[i].factors] == sorted(f.start for f in got[i].factors)
        # a parse that refers to one place of each block has no shorter first factor than a window, and begins where the naive one does
        assert [f.start for f in got[i].factors][:1] == [a for a, _ in naive][:1]
        many += len(naive)
    assert many > 50


def test_the_parse_is_greedy():
    array = lambda *x: np.array(x, np.int64)
    # document 1 matches windows 0 to 4, document 2 windows 3 to 9, document 3 window 4 alone and 20; another text begins anew
    found = parse(array(0, 0, 0, 0, 0, 1), array(3, 0, 3, 4, 20, 2), array(7, 3, 2, 1, 1, 4), array(2, 1, 1, 3, 3, 2), array(0, 0, 0, 0, 0, 0), array(13, 100, 103, 0, 7, 12))
    assert found == [(0, 0, 5, 1, 100), (0, 5, 5, 2, 15), (0, 20, 1, 3, 7), (1, 2, 4, 2, 12)]
    assert parse(*[array()] * 6) == []
    # hits on one line with a gap are two matches, and lines of several texts don't run together
    assert parse(array(0, 0, 1), array(0, 5, 6), array(2, 1, 1), array(7, 7, 7), array(0, 0, 0), array(0, 5, 6)) == [(0, 0, 2, 7, 0), (0, 5, 1, 7, 5), (1, 6, 1, 7, 6)]


def test_clashing_names_and_other_keys(spark):
    text = " ".join(f"a{k}" for k in range(30))
    names = ["_did", "_tag", "_spans", "_kept", "did", "tag", "raw", "packed", "spans", "rest", "changed", "place", "anchor", "one"]
    docs = spark.createDataFrame([(1, *[77] * len(names), text), (2, *[78] * len(names), text + " tail"), (3, *[79] * len(names), None)], ", ".join(f"{c} long" for c in ["doc_id", *names]) + ", text string")
    got = sorted(stripped(docs).collect(), key=lambda r: r.doc_id)
    assert stripped(docs).columns == docs.columns
    assert [(r.doc_id, r.text, *r[1:-1]) for r in got] == [(1, text, *[77] * len(names)), (2, "tail", *[78] * len(names)), (3, None, *[79] * len(names))]
    assert {(r.doc_id, r.n_removed) for r in deduplicate(docs).collect()} == {(1, 0), (2, 30), (3, 0)}
    assert {(r.doc_id, r.n_removed) for r in suffix.deduplicate(docs, width=40).collect()} == {(1, 109), (2, 109), (3, 0)}
    with pytest.raises(TypeError):
        deduplicate(docs.withColumn("doc_id", docs["doc_id"].cast("string")))
    with pytest.raises(ValueError):
        scanner(None, 40_000, 10)


def test_very_long_texts(spark):
    r = random.Random(8)
    long = " ".join(f"w{r.randrange(5000)}" for _ in range(250_000))
    docs = spark.createDataFrame([(1, long), (2, "x " * 10 + long), (3, long[500_000:600_000])], "doc_id long, text string")
    got = {x.doc_id: x for x in deduplicate(docs).collect()}
    n = len(long.split())
    assert (got[1].n_removed, got[2].n_words, got[2].n_removed) == (0, n + 10, n) and got[3].n_words - got[3].n_removed <= 2
    assert [(f.start, f.words, f.document, f.at) for f in got[2].factors] == [(10, n, 1, 0)]
    got = {x.doc_id: x for x in suffix.deduplicate(docs).collect()}
    assert got[1].n_removed == got[1].n_bytes and got[2].n_removed == len(long) and got[3].n_removed == 100_000
