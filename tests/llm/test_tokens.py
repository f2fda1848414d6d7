import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from recordloom.llm.bpe import Automaton, Codec, encode_decode
from recordloom.llm.token_counts import count_tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "Hello WORLD's   naïve <|endoftext|>x <|ENDOFTEXT|> 123 é é  a", "a\u0000b ​ c\u0085d e", "  x  ", "", None, "   ", "a" * 40_000,
    "ΑΣ ΣΑΣ İi ǅ 中文 字符 🙂🙂🙂 ́a á !!!!!!???....", "don't i've we'll 's's", "thethethe inininin" * 3, "word " * 20_000, "don't i've we'll 's's", "x<|endoftext|>y<|startoftext|>",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return Codec(PATH)


def merged(word, merges, end):
    """Merges by rank, leftmost first, one pair at a time."""
    parts = [*word[:-1], word[-1] + end]
    ranks = {m: r for r, m in enumerate(merges)}
    while True:
        found = min(((ranks[p], i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in ranks), default=None)
        if found is None:
            return parts
        i = found[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@settings(max_examples=60, deadline=None)
@given(st.randoms(use_true_random=False))
def test_automaton_accepts_what_merging_gives(random):
    base = ["a", "b", "c"]
    vocab = [*base, *(x + "." for x in base)]
    merges = []
    for _ in range(random.randint(1, 14)):
        u, v = random.choice([t for t in vocab if not t.endswith(".")]), random.choice(vocab)
        if u + v not in vocab:
            # only pairs that occur as neighbours at that time, as in a trained list
            merges.append((u, v))
            vocab.append(u + v)
    table = Automaton({t: i for i, t in enumerate(vocab)}, merges, ".")
    live = [m for m in merges if {i for i, b in enumerate(table.born) if b is not None} >= {vocab.index(m[0]), vocab.index(m[1]), vocab.index(m[0] + m[1])}]
    for _ in range(60):
        word = "".join(random.choice(base) for _ in range(random.randint(1, 12)))
        assert table.decode(table.encode(word)) == merged(word, live, ".")


@settings(max_examples=150, deadline=None)
@given(text=st.text(max_size=60))
def test_any_text_as_the_library(library, codec, text):
    raw = text.encode("utf-8", "replace")
    want = library.encode(raw.decode(), add_special_tokens=False).ids
    ids, decoded = codec.code(raw)
    assert [int(x) for x in ids.split()] == want and decoded.decode() == library.decode(want, skip_special_tokens=False)


def test_other_kinds_of_files_are_refused(tmp_path):
    with pytest.raises(ValueError):
        Codec(public_tokenizers.path("byte_bpe_50k.json"))
    spec = json.load(open(PATH, encoding="utf-8"))
    spec["normalizer"]["normalizers"].pop()
    (tmp_path / "t.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        Codec(str(tmp_path / "t.json"))


def test_queries_as_the_library(spark, library):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, n_tokens string")
    counts = {r.doc_id: r for r in count_tokens(docs, PATH).collect()}
    coded = {r.doc_id: r for r in encode_decode(docs, PATH).collect()}
    assert len(counts) == len(coded) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert (counts[i].n_bytes, counts[i].n_tokens, counts[i].over_limit) == (len((t or "").encode()), len(ids), len(ids) > 2048)
        text = library.decode(ids, skip_special_tokens=False)
        assert coded[i].ids == ids and coded[i].decoded == text and coded[i].n_tokens == len(ids)
        assert coded[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert coded[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert count_tokens(docs.limit(0), PATH).collect() == [] and encode_decode(docs.limit(0), PATH).collect() == []


def test_long_pieces_are_cut_at_safe_places(spark, library):
    from recordloom.llm import token_counts as C

    texts = ["Letters,marks;and.1more!" * 4000, "don't.x" * 9000 + "<|endoftext|>" + "y" * 50_000 + ".", "字" * 9000 + "a.b" * 9000, "x" * 40_000]
    got = {r.doc_id: r.n_tokens for r in count_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), PATH).collect()}
    assert [got[i] for i in range(4)] == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    data = np.frombuffer(texts[0].encode(), np.uint8)
    starts, ends = C.shorter(data, np.array([0]), np.array([len(data)]))
    assert len(starts) == len(ends) >= len(data) // C.LONG - 1 and (starts[1:] == ends[:-1]).all() and int((ends - starts).max()) < 2 * C.LONG


@pytest.mark.parametrize("most", [1, 50, 3000])
def test_tables_of_any_size(library, most):
    """Texts with more different words than a table holds, after others."""
    r = random.Random(most)
    codec = Codec(PATH, most)
    for n in (5, 2000, 3, 400, 2000):
        text = " ".join("".join(r.choice("abcdeé'.1") for _ in range(r.randrange(1, 9))) for _ in range(n)) + " \u200b"
        want = library.encode(text, add_special_tokens=False).ids
        ids, decoded = codec.code(text.encode())
        assert [int(x) for x in ids.split()] == want and decoded.decode() == library.decode(want, skip_special_tokens=False)
