import hashlib
import re

import corpus_pipeline as P
import public_tokenizers
from tokenizers import Tokenizer

from recordloom.llm import langid
from tests.llm.test_decontam import tokens
from tests.llm.test_substrings import WORD, brute


def shingles(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}


def keepers(docs):
    root = {i: i for i, _ in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = [(i, shingles(t)) for i, t in docs]
    for i, a in sets:
        for j, b in sets:
            if i < j and len(a & b) >= 0.8 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [(i, t) for i, t in docs if find(i) == i]


def test_as_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()]
    docs = [(i, t) for i, t in docs if re.search(r"[^\W\d_]", t or "")]
    docs = keepers(docs)
    cut = brute(docs)
    docs = [(i, t if not cut[i][1] else cut[i][3]) for i, t in docs if not cut[i][1] or cut[i][3]]
    leaks = [tokens(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    leaky = {i for i, t in docs for m in leaks if " ".join(m) in " ".join(tokens(t))}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: library.encode(t, add_special_tokens=False).ids for i, t in docs}
    got = {r.doc_id: r for r in P.run(spark, sf).collect()}
    # what holds an item word for word goes; nothing goes that shares no 13 tokens with one
    assert leaky and not leaky & got.keys()
    far = {i for i, t in docs for m in leaks for k in range(max(1, len(m) - 4)) if " ".join(m[k : k + 5]) in " ".join(tokens(t))}
    assert want.keys() - far <= got.keys() <= want.keys()
    for i, r in got.items():
        assert r.ids == want[i] and r.n_tokens == len(want[i])
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, want[i])).encode()).hexdigest()


def test_stages_on_odd_rows(spark, sf):
    rows = [(1, None, "en", "s", 0), (2, "", None, "s", 0), (3, "?!? 123", "en", "s", 7), (4, "the one and only thing", "en", "s", 22), (4, "the one and only thing", "en", "s", 22), (None, "the one and only thing", None, None, None), (None, "another text it is", "en", "t", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == P.COLUMNS, name
    assert sorted((r.doc_id or 0, r.text) for r in docs.collect()) == [(0, "another text it is"), (4, "the one and only thing")]
    assert P.STAGES[-1][1](spark, docs, sf).count() == 2
    empty = docs.limit(0)
    for _, stage in P.STAGES:
        empty = stage(spark, empty, sf)
        assert empty.collect() == []


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    net = langid.fit(docs)
    rows = langid.identify(docs, net).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert len(rows) > 200 and sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    again = {r.doc_id: r.lang_pred for r in langid.identify(docs.drop("lang", "source"), net).collect()}
    assert all(again[r.doc_id] == r.lang_pred for r in rows)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !?"), (None, "the and of it"), (5, "der und die " * 30_000)], "doc_id long, text string")
    got = {r.doc_id: r for r in langid.identify(odd, net).collect()}
    assert [got[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and got[1].score == 0 and got[None].held_out is False
    assert all(0 <= r.score <= 1 for r in got.values()) and got[5].lang_pred in net.langs
    unlabelled = odd.selectExpr("doc_id", "text", "cast(null as string) lang")
    assert langid.fit(unlabelled) is None and {r.lang_pred for r in langid.identify(odd, None).collect()} == {"und"}
    assert langid.identify(odd.limit(0), net).collect() == []
