"""The network's predictions against a forward pass written out, window by window and filter by filter."""

import math

import numpy as np

from recordloom.llm import langid as L


def naive(net, text):
    """(probabilities by language) of a text's bytes, each response a sum of its own."""
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())
    n, d = len(raw), net.embed.shape[1]
    starts, weights = [], []
    for k in range(max(1, math.ceil(n / L.WINDOW))):
        starts.append(min(k * L.WINDOW, max(n - L.WINDOW, 0)))
        weights.append(min(L.WINDOW, max(0, n - k * L.WINDOW)))
    total = np.zeros(len(net.langs))
    for a, weight in zip(starts, weights):
        window = (raw[a : a + L.WINDOW] + bytes(L.WINDOW))[: L.WINDOW]
        act = []
        for f in range(net.filters.shape[1]):
            best = -math.inf
            width = L.WIDTHS[f // L.FILTERS]
            for place in range(L.WINDOW - net.widest + 1):
                response = 0.0
                for j in range(width):
                    for e in range(d):
                        response += float(net.embed[window[place + j], e]) * float(net.filters[j * d + e, f])
                best = max(best, response)
            act.append(max(0.0, best + float(net.bias[f])))
        z = [sum(act[f] * float(net.out[f, k]) for f in range(len(act))) + float(net.out_bias[k]) for k in range(len(net.langs))]
        e = [math.exp(v - max(z)) for v in z]
        total += np.array(e) / sum(e) * weight
    return total / max(1, sum(weights))


def test_as_a_written_out_pass(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    net = L.fit(docs)
    own = docs.where("text is not null and length(text) between 1 and 900").orderBy("doc_id").limit(8)
    odd = spark.createDataFrame([(-1, "é"), (-2, "A" * 161), (-3, "the " * 80)], "doc_id long, text string")
    texts = {r.doc_id: r.text for r in own.select("doc_id", "text").unionByName(odd).collect()}
    rows = spark.createDataFrame([(i, t, "lang?", 7, True, "zz") for i, t in texts.items()], "doc_id long, text string, source string, score int, held_out boolean, lang_pred string")
    got = {r.doc_id: r for r in L.identify(rows, net).collect()}
    assert len(got) == len(texts)
    for i, t in texts.items():
        p = naive(net, t)
        if any(c.isalpha() for c in t):
            assert abs(got[i].score - p.max()) < 1e-4 and p[net.langs.index(got[i].lang_pred)] > p.max() - 1e-4
        else:
            assert (got[i].lang_pred, got[i].score) == ("und", 0)


def test_ties_go_to_the_first_language(spark):
    zero = lambda *shape: np.zeros(shape, np.float32)
    wide = max(L.WIDTHS)
    net = L.Network(["aa", "bb"], zero(256, L.EMBED), zero(wide * L.EMBED, 3), zero(3), zero(3, 2), zero(2))
    r = L.identify(spark.createDataFrame([(1, "text")], "doc_id long, text string"), net).first()
    assert (r.lang_pred, r.score) == ("aa", 0.5)


def test_what_no_language_claims_is_rejected(spark):
    """A score near even odds is rejected whatever the number of languages."""
    wide = max(L.WIDTHS)
    docs = spark.createDataFrame([(1, "text", 5), (2, "123", 6), (3, None, 7)], "doc_id long, text string, least int")
    for k in (1, 2, 3, 8):
        zero = lambda *shape: np.zeros(shape, np.float32)
        even = L.Network([f"l{i}" for i in range(k)], zero(256, L.EMBED), zero(wide * L.EMBED, 3), zero(3), zero(3, k), zero(k))
        assert [r.doc_id for r in L.accepted(docs, even).collect()] == ([1] if k == 1 else [])
        sure = L.Network(even.langs, even.embed, even.filters, even.bias, even.out, np.arange(k, dtype=np.float32))
        assert [tuple(r) for r in L.accepted(docs, sure).collect()] == [(1, "text", 5)]
