import random
import re
from itertools import combinations

from recordloom.llm import decontam as D

TOKEN = re.compile(r"(?:[^\W_]|[^\x00-\x7F])+")


def tokens(text):
    return [t for t in re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").lower()) if t]


def brute(docs, items):
    """All diagonals, with the rule as it is told: pairs with a best-scoring run that is long and similar enough."""
    out = set()
    for d, text in docs:
        a = tokens(text)
        for i, item in items:
            b = tokens(item)
            for shift in range(-len(b) + 1, len(a)):
                low, high = max(0, -shift), min(len(b), len(a) - shift)
                same = [a[k + shift] == b[k] for k in range(low, high)]
                best, size, equal = 0, 0, 0
                for x in range(len(same)):
                    score = 0
                    for y in range(x, len(same)):
                        score += 1 if same[y] else D.PENALTY
                        if score > best:
                            best, size, equal = score, y - x + 1, sum(same[x : y + 1])
                for m, e in ((size, equal), (len(same), sum(same))):
                    # a hit needs equal tokens under a mask somewhere; a run as similar as this has one
                    if m and m >= min(D.OVERLAP, len(b)) and e >= D.SIMILARITY * m:
                        out.add((d, i))
    return out


def test_as_brute_force(spark):
    r = random.Random(4)
    vocab = [f"wo{k}é" if k % 5 == 0 else f"wo{k}" for k in range(80)]
    prose = lambda n: [r.choice(vocab) for _ in range(n)]
    items = [(k, " ".join(prose(r.choice([2, 4, 8, 15, 30])))) for k in range(12)] + [(50, None), (51, ""), (52, "¡!? ...")]
    docs = [(1, None), (2, ""), (3, "wo1"), (None, items[3][1])]
    for k in range(60):
        w = prose(r.choice([5, 30, 60]))
        if k % 2:
            leak = tokens(r.choice(items[:12])[1])
            for _ in range(r.choice([0, 0, 1, 2, 4, 9])):
                leak[r.randrange(len(leak))] = "zz"
            if k % 3 == 0:
                leak = leak[r.randrange(5) :]
            at = r.randrange(len(w))
            w[at:at] = [x.upper() + r.choice(["", "!!", ","]) for x in leak]
        docs.append((10 + k, " ".join(w)))
    table = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    for limit in (1 << 20, 100):
        got = D.contaminated(table, bench, limit=limit).collect()
        assert len(got) == len({(x.doc_id, x.item_id) for x in got})
        want = brute(docs, items)
        assert {(x.doc_id, x.item_id) for x in got} == want and len(want) >= 10
        kept = {x.doc_id for x in D.clean(table, bench, limit=limit).collect()}
        assert kept == {d for d, _ in docs} - {d for d, _ in want}
    assert D.contaminated(table.limit(0), bench).collect() == [] and D.contaminated(table, bench.limit(0)).collect() == []
    assert D.clean(table, bench.limit(0)).count() == len(docs)


def test_substitutions_are_found():
    """Of passages of 15 to 60 tokens with every sixth token substituted at most, none is missed."""
    r = random.Random(5)
    for _ in range(300):
        item = [f"t{r.randrange(10**6)}" for _ in range(r.randrange(15, 60))]
        index = D.Index.of([7], [" ".join(item).encode()])
        leak = list(item)
        for k in range(r.randrange(6), len(leak), 6):
            leak[k] = "other"
        import pyarrow as pa

        assert index.leaks(pa.array([b"x y", ("z " * r.randrange(4) + " ".join(leak) + " z").encode()], pa.binary())).keys() == {(1, 0)}


def any_run(a, b):
    """Is there a diagonal with any run that is long and similar enough?"""
    for shift in range(-len(b) + 1, len(a)):
        low, high = max(0, -shift), min(len(b), len(a) - shift)
        same = [a[k + shift] == b[k] for k in range(low, high)]
        for x in range(len(same)):
            for y in range(x + 1, len(same) + 1):
                if y - x >= min(D.OVERLAP, len(b)) and 5 * sum(same[x:y]) >= 4 * (y - x):
                    return True
    return False


def leaked(document, item):
    import pyarrow as pa

    return D.Index.of([7], [" ".join(item).encode()]).leaks(pa.array([" ".join(document).encode()], pa.binary())).get((0, 0))


def test_any_run_is_a_leak():
    """Also one that doesn't score best: ten equal tokens, two substituted, three equal."""
    item = [f"t{k}" for k in range(38)]
    leak = item[10:20] + ["x", "y"] + item[22:25]
    assert leaked(["a", "b", *leak, "c"], item) == (13, 15, 2)
    # a shorter run without a substituted token scores more than the longer one
    assert leaked(item[:10] + ["x"] * 11 + item[21:25] + ["x"] + item[26:30] + ["x"] + item[31:35], item) == (12, 14, 21)
    # runs that nearly are: 13 tokens with ten equal, twelve in all
    assert leaked(item[:5] + ["x"] * 3 + item[8:13], item) is None and leaked(item[:10], item[:38]) is None
    r = random.Random(8)
    found = 0
    for _ in range(400):
        item = [f"t{r.randrange(10**6)}" for _ in range(r.randrange(13, 40))]
        low = r.randrange(len(item) - 12)
        leak = item[low : low + r.randrange(10, 40)]
        share = r.choice([0.1, 0.2, 0.25, 0.3])
        document = ["z"] * r.randrange(4) + [w if r.random() > share else "other" for w in leak] + ["z"] * r.randrange(4)
        got = leaked(document, item)
        assert bool(got) == any_run(document, item)
        found += bool(got)
    assert 100 < found < 350


def test_no_similar_item_is_without_a_hit():
    """All ways to substitute a fifth of an item of up to 20 tokens; runs of 26 and more hold a shorter one that is as similar."""
    import pyarrow as pa

    for n in range(1, 21):
        item = [f"t{k}" for k in range(n)]
        index = D.Index.of([7], [" ".join(item).encode()])
        texts = [" ".join("x" if k in other else w for k, w in enumerate(item)).encode() for other in combinations(range(n), n // 5)]
        assert {d for d, _ in index.leaks(pa.array(texts, pa.binary()))} == set(range(len(texts))), n


def test_long_texts_and_common_seeds(spark, monkeypatch):
    """A very long text, and one word over and over on both sides: every seed of it hits every place."""
    r = random.Random(11)
    long = [f"w{r.randrange(3000)}" for _ in range(150_000)]
    items = [(1, " ".join(long[90_000:90_040])), (2, "echo " * 60), (3, " ".join(f"v{k}" for k in range(20)))]
    docs = [(10, " ".join(long)), (11, "echo " * 3000), (12, "echo " * 5), (13, "x " * 50_000)]
    table, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {(10, 1, 40, 40, 90_000), (11, 2, 60, 60, 2940)}
    assert {tuple(x) for x in D.contaminated(table, bench).collect()} == want
    import pyarrow as pa

    monkeypatch.setattr(D, "MOST_HITS", 64)
    index = D.Index.of([2], [items[1][1].encode()])
    assert index.leaks(pa.array([b"y " + b"echo " * 300], pa.binary())) == {(0, 0): (60, 60, 241)}
