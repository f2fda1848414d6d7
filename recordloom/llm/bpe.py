"""Byte-pair encoding by a tokenization automaton.

The automaton reads token sequences and accepts exactly those that byte-pair merging produces. It starts as one state with
a loop for every base symbol, which accepts any spelling. The merges are then compiled in rank order, each by a *merge
gadget* for (u, v) -> uv: wherever u leads to a state that has an arc v, that state is replaced by a copy without
the arc v, and an arc uv is added that leads where v led. The outcome is deterministic, and every text has one accepted spelling.

After all gadgets, the state reached depends only on the token read last. Written out, the arcs of all states would number in
the billions, because a copy shares nearly all arcs with its original, so the compiled form keeps what each gadget
did: which state was copied for a new token (that of its right part), which arc a new arc stands beside (that of its left part), which
arc was cut, and when. The presence of an arc follows from these tables, and the rows that texts use are filled into a
transition table as they are met.

A word is encoded by running the automaton along its symbols: from each state reached, the longest token that has an arc there
and from whose end the run can go on. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textscan import by_bytes, give_back, parts, released

#: Entries of each of a task's tables of known words. A full table becomes the old one, from which what is met again moves to the new one.
MOST_KNOWN = 200_000
MOST_ARCS = 200_000
BATCH_BYTES = 1 << 20
START = -1
#: Marks that stand alone behind a word.
MARKS = frozenset((b".", b",", b";", b":", b"!", b"?"))


def _byte_level() -> dict[int, int]:
    """The published byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for U+0100 and on in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + k for k, b in enumerate(others)}


BYTE_LEVEL = _byte_level()
INNER, LAST = 1, 2


class Automaton:
    """Compiled merges over symbols; ``end`` is the mark of a word's last symbol."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str) -> None:
        self.end = end
        size = max(vocab.values()) + 1
        self.labels = [""] * size
        for t, i in vocab.items():
            self.labels[i] = t
        self.born: list[int | None] = [None] * size
        self.copied = [0] * size  # the token whose state a token's own state is a copy of
        self.beside = [0] * size  # the token beside whose arcs a token's arcs were added
        self.cut: dict[int, int] = {}  # by state and token: when the arc was cut
        self.arcs: dict[int, bool] = {}
        made = {u + v for u, v in merges}
        tokens = [i for t, i in vocab.items() if t not in made]
        for i in tokens:
            self.born[i] = -1
        for rank, (u, v) in enumerate(merges):
            if self.gadget(rank, vocab[u], vocab[v], vocab[u + v]):
                tokens.append(vocab[u + v])
        # the spellings of the arcs' labels, letter by letter: what follows, and the token spelled so far within a word and at its end
        self.spelled: dict[str, list] = {}
        self.longest = max((len(self.labels[i].removesuffix(end)) for i in tokens), default=0)
        for i in tokens:
            follow, entry = self.spelled, None
            for letter in self.labels[i].removesuffix(end):
                entry = follow.setdefault(letter, [{}, None, None])
                follow = entry[0]
            if entry is not None:
                entry[LAST if self.labels[i].endswith(end) else INNER] = i

    def gadget(self, rank: int, left: int, right: int, token: int) -> bool:
        """Applies a merge; False if no state has both arcs, and so the token is never spelled."""
        born = self.born
        if born[left] is None or born[right] is None or born[token] is not None or not self._has(left, right, rank, False):
            return False
        born[token], self.copied[token], self.beside[token] = rank, right, left
        self.cut[left << 20 | right] = rank
        return True

    def _has(self, state: int, token: int, when: float, after: bool) -> bool:
        """Has the state behind ``state`` an arc ``token`` just before (or after) the gadget ``when``?"""
        born, cut = self.born, self.cut
        while True:
            gone = cut.get(state << 20 | token)
            if gone is not None and (gone <= when if after else gone < when):
                return False
            if born[token] >= born[state]:
                if born[token] < 0:
                    return True
                when, token, after = born[token], self.beside[token], True  # the arc came with its left part's
            else:
                when, state, after = born[state], self.copied[state], False  # the state was copied then

    def arc(self, state: int, token: int) -> bool:
        """Has the state after ``state`` an arc ``token``? Fills the transition table."""
        if len(self.arcs) >= MOST_ARCS:
            self.arcs.clear()
        known = self.arcs[state << 20 | token] = self._has(state, token, float("inf"), False)
        return known

    def readings(self, word: str, start: int) -> list[tuple[int, int]]:
        """(token, end) of the tokens spelled from ``start`` on, the longest last."""
        n, follow, i, out = len(word), self.spelled, start, []
        for letter in word[start : start + self.longest]:
            entry = follow.get(letter)
            if entry is None:
                break
            i += 1
            follow, inner, last = entry
            token = inner if i < n else last
            if token is not None:
                out.append((token, i))
        return out

    def encode(self, word: str) -> list[int]:
        """The tokens of a pre-split word, a non-empty string of base symbols.

        The automaton is run along the word, the longest token first wherever the state has several; where none goes on, the run steps back. Each
        beginning of the word has one accepted spelling, so a place is left for good once nothing goes on behind it.
        """
        n, arcs = len(word), self.arcs
        out, open_, places, dead = [START], [self.readings(word, 0)], [0], set()
        while open_:
            state, ways = out[-1], open_[-1]
            while ways:
                token, end = ways.pop()
                if end in dead:
                    continue
                if state != START:
                    has = arcs.get(state << 20 | token)
                    if has is None:
                        has = self.arc(state, token)
                    if not has:
                        continue
                out.append(token)
                if end == n:
                    return out[1:]
                open_.append(self.readings(word, end))
                places.append(end)
                break
            else:
                dead.add(places.pop())
                open_.pop()
                out.pop()
        raise ValueError(f"no tokens spell {word[:40]!r}")

    def decode(self, ids: list[int]) -> list[str]:
        """The labels of the arcs."""
        return [self.labels[i] for i in ids]


#: What the short ways of ``Codec`` rest on, the normaliser and the pre-splitting rule of the word tokenizers it reads.
NORMALIZERS = [("NFC", None), ("Replace", r"\s+"), ("Lowercase", None)]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def supported(spec: dict) -> None:
    """Raises unless texts are composed, made small and split as ``words_of`` and ``pieces_of`` assume, white space is dropped, and decoding joins labels by spaces."""
    steps = [(n["type"], n.get("pattern", {}).get("Regex")) for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    parts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    split = [p for p in parts if p["type"] == "Split" and p["pattern"].get("Regex") == SPLIT and p["behavior"] == "Removed" and p["invert"]]
    level = [p for p in parts if p["type"] == "ByteLevel" and not p["add_prefix_space"] and not p.get("use_regex", True)]
    model, added = spec["model"], spec["added_tokens"]
    plain = model["type"] == "BPE" and model.get("end_of_word_suffix") and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
    alone = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) and not any(c.isspace() for c in t["content"]) for t in added)
    if steps != NORMALIZERS or len(parts) != 2 or not split or not level or not plain or not alone or spec.get("decoder") or spec.get("post_processor"):
        raise ValueError("not a tokenizer of the kind that this codec reads: words with ends, small letters, white space dropped")


class Codec:
    """A word tokenizer file: its own normaliser and pre-splitting rule, with the automaton in place of its model. Files of other kinds are an error (see ``supported``)."""

    def __init__(self, path: str, most_known: int = MOST_KNOWN) -> None:
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        supported(spec)
        model = spec["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model["end_of_word_suffix"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        labels = self.automaton.labels
        labels += [""] * (max(self.special.values(), default=0) + 1 - len(labels))
        for t, i in self.special.items():
            labels[i] = t
        self.marks = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # the file's own rule, with its classes narrowed to what printable lower-case ASCII can hold
        self.plain = re.compile(split.replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9"))
        tokenizer = Tokenizer.from_file(path)
        self.normalize, self.presplit = tokenizer.normalizer.normalize_str, tokenizer.pre_tokenizer.pre_tokenize_str
        self.most_known = most_known
        self.pieces: dict[str, tuple[str, str]] = {}
        self.old_pieces: dict[str, tuple[str, str]] = {}
        self.ids: dict[bytes, bytes] = {}
        self.texts: dict[bytes, bytes] = {}
        self.old: tuple[dict[bytes, bytes], dict[bytes, bytes]] = {}, {}
        self.silent: set[bytes] = set()

    def words_of(self, raw: bytes) -> list[str] | None:
        """The pre-split words of the usual chunk, letters with a mark behind them or none; None for any other."""
        tail = None
        if not raw.isalpha() and raw[-1:] in MARKS:
            raw, tail = raw[:-1], raw[-1:].decode()
        if raw.isalpha():
            word = raw.lower().decode()
        else:
            text = raw.decode("utf-8", "replace")
            # letters below U+0250 are in composed form, and their classes and small forms the same in every Unicode version
            small = text.lower()
            if not text.isalpha() or not small.isalpha() or max(text) >= "\u0250":
                return None
            word = small.encode().decode("latin-1").translate(BYTE_LEVEL)
        return [word, tail] if tail else [word]

    def pieces_of(self, text: str) -> list[str]:
        """Pre-split words of a text without special strings."""
        if text.isascii() and text.isprintable():
            return self.plain.findall(text.lower())
        return [p for p, _ in self.presplit(self.normalize(text))] if text else []

    def chunk(self, raw: bytes) -> list[tuple[str, str]]:
        """Ids and labels, joined by spaces, of the words of a text without ASCII white space."""
        usual = self.words_of(raw)
        if usual is not None:
            return [self.pieces.get(p) or self.coded(p) for p in usual]
        text = raw.decode("utf-8", "replace")
        if self.marks and self.marks.search(text):
            parts = self.marks.split(text)
        else:
            parts = [text]
        out: list[tuple[str, str]] = []
        for part in parts:
            if part in self.special:
                out.append((str(self.special[part]), part))
                continue
            for p in self.pieces_of(part):
                out.append(self.pieces.get(p) or self.coded(p))
        return out

    def coded(self, piece: str) -> tuple[str, str]:
        if len(self.pieces) >= self.most_known:
            self.pieces, self.old_pieces = {}, self.pieces
        known = self.old_pieces.get(piece)
        if known is None:
            ids = self.automaton.encode(piece)
            known = " ".join(map(str, ids)), " ".join(self.automaton.decode(ids))
        self.pieces[piece] = known
        return known

    def learn(self, new: set[bytes]) -> None:
        old_ids, old_texts = self.old
        for raw in new:
            if raw in old_ids:
                self.ids[raw], self.texts[raw] = old_ids[raw], old_texts[raw]
                continue
            found = self.chunk(raw)
            if len(found) == 1:
                ids, text = found[0]
            else:
                ids, text = " ".join([f[0] for f in found]), " ".join([f[1] for f in found])
                if not found:
                    self.silent.add(raw)
            self.ids[raw], self.texts[raw] = ids.encode(), text.encode()

    def code(self, raw: bytes) -> tuple[bytes, bytes]:
        """Decimal ids and decoded labels of a whole text, each joined by one space."""
        coded = [x for x in map(self.part, parts(raw)) if x[0]]
        if len(coded) == 1:
            return coded[0]
        return b" ".join([ids for ids, _ in coded]), b" ".join([text for _, text in coded])

    def part(self, raw: bytes) -> tuple[bytes, bytes]:
        chunks = raw.split()
        found = list(map(self.ids.get, chunks))
        if None in found:
            new = {c for c, ids in zip(chunks, found, strict=True) if ids is None}
            if len(self.ids) + len(new) > self.most_known:
                # what this text needs goes into the new tables, whatever their size
                self.old, self.ids, self.texts = (self.ids, self.texts), {}, {}
                new = set(chunks)
            self.learn(new)
            found = list(map(self.ids.__getitem__, chunks))
        if self.silent and not self.silent.isdisjoint(chunks):
            chunks = [c for c in chunks if c not in self.silent]
            found = list(map(self.ids.__getitem__, chunks))
        return b" ".join(found), b" ".join(map(self.texts.__getitem__, chunks))


def coder(path: str, more: tuple[str, ...], most_known: int = MOST_KNOWN):
    """A mapInArrow function: (id, raw binary) to (id, n_tokens, ids_sha256, decoded_sha256[, ids, decoded])."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path, most_known)
        for batch in by_bytes(batches, "raw", BATCH_BYTES):
            n, ids_sha, text_sha, ids_all, texts = [], [], [], [], []
            for raw in batch.column("raw"):
                ids, text = codec.code(raw.as_py())
                n.append(ids.count(b" ") + 1 if ids else 0)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(text).hexdigest())
                if "ids" in more:
                    ids_all.append(np.array(ids.split(), np.int32) if ids else np.zeros(0, np.int32))
                if "decoded" in more:
                    texts.append(text)
            out = {"id": batch.column(0), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string())}
            if "ids" in more:
                out["ids"] = pa.ListArray.from_arrays(np.cumsum([0, *n]).astype(np.int32), np.concatenate(ids_all))
            if "decoded" in more:
                out["decoded"] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_pydict(out)
        del codec
        give_back()

    return released(run)


def encode_decode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", more: tuple[str, ...] = ("ids", "decoded"), most_known: int = MOST_KNOWN) -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256 and, as ``more`` says, ids (array<int>) and decoded (string) of every row.

    Special strings inside a text become special tokens, as the library does by default; none are added. Texts of any length are whole: a text is cut at ASCII
    white space, which the tokenizer drops. A null text counts as empty: no tokens, digests of the empty string.
    Repeated rows are coded each, a null key is kept, extra columns are not read, and an empty table gives no rows.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("raw"))
    kinds = {"ids": "array<int>", "decoded": "string"}
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + "".join(f", {c} {kinds[c]}" for c in kinds if c in more)
    return rows.mapInArrow(coder(path, more, most_known), schema).withColumnRenamed("id", key)
