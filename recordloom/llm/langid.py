"""Language identification by a byte convolutional network.

A text is read as fixed-length windows of bytes (ASCII capitals made small). Bytes are embedded, filters of several widths slide over a
window, their largest responses are kept, and a softmax layer turns those into language probabilities; a
text's probabilities are the mean over all its windows, weighted by the bytes each adds. The network is trained in
numpy on a bounded sample of labelled rows and applied to Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.durable import keep
from .textscan import by_bytes, released, spans

WINDOW, WIDTHS, FILTERS, EMBED = 160, (2, 3, 4), 12, 6
#: The sample the classifier is fitted on: rows of each language, and windows of each row.
ROWS_A_LANGUAGE, WINDOWS_A_ROW, MOST_LANGUAGES = 300, 6, 300
UNKNOWN = "und"

_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[65:91] += 32


@dataclass
class Network:
    langs: list[str]
    embed: np.ndarray
    filters: np.ndarray  # (widest * EMBED, filters of all widths); the narrower ones end in zeros
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @property
    def widest(self) -> int:
        return self.filters.shape[0] // self.embed.shape[1]

    def patches(self, x: np.ndarray) -> np.ndarray:
        e = np.ascontiguousarray(self.embed[x])
        n, length, d = e.shape
        places = length - self.widest + 1
        return np.lib.stride_tricks.as_strided(e, (n, places, self.widest * d), (e.strides[0], e.strides[1], e.strides[2]))

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of windows (n, WINDOW) of bytes."""
        out = np.empty((len(x), len(self.langs)), np.float32)
        for k in range(0, len(x), 128):
            p = self.patches(x[k : k + 128])
            n, places, width = p.shape
            top = (p.reshape(n * places, width) @ self.filters).reshape(n, places, -1).max(axis=1)
            out[k : k + n] = softmax(np.maximum(top + self.bias, 0) @ self.out + self.out_bias)
        return out


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(x: np.ndarray, y: np.ndarray, langs: list[str], epochs: int = 6, seed: int = 1) -> Network:
    """Adam on the cross-entropy; the same input gives the same network."""
    rng = np.random.default_rng(seed)
    widest, total = max(WIDTHS), FILTERS * len(WIDTHS)
    mask = np.zeros((widest, EMBED, total), np.float32)
    for i, w in enumerate(WIDTHS):
        mask[:w, :, i * FILTERS : (i + 1) * FILTERS] = 1
    mask = mask.reshape(widest * EMBED, total)
    net = Network(
        langs, rng.normal(0, 0.5, (256, EMBED)).astype(np.float32), (rng.normal(0, 0.3, mask.shape) * mask).astype(np.float32),
        np.zeros(total, np.float32), rng.normal(0, 0.2, (total, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32),
    )
    names = ("embed", "filters", "bias", "out", "out_bias")
    first, second, t = {k: np.zeros_like(getattr(net, k)) for k in names}, {k: np.zeros_like(getattr(net, k)) for k in names}, 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for k in range(0, len(order), 64):
            rows = order[k : k + 64]
            xb, n = x[rows], len(rows)
            p = net.patches(xb)
            z = (p.reshape(n * p.shape[1], -1) @ net.filters).reshape(n, p.shape[1], -1)
            at = z.argmax(axis=1)
            top = np.take_along_axis(z, at[:, None, :], 1)[:, 0] + net.bias
            act = np.maximum(top, 0)
            d = softmax(act @ net.out + net.out_bias)
            d[np.arange(n), y[rows]] -= 1
            d /= n
            dtop = (d @ net.out.T) * (top > 0)
            seen = p[np.arange(n)[:, None], at]  # (n, filters, widest * EMBED): what each filter responded to
            dseen = dtop[:, :, None] * net.filters.T[None]
            dembed = np.zeros_like(net.embed)
            read = xb[np.arange(n)[:, None, None], at[:, :, None] + np.arange(widest)]
            np.add.at(dembed, read.ravel(), dseen.reshape(-1, EMBED))
            grads = {"embed": dembed, "filters": np.einsum("nf,nfw->wf", dtop, seen) * mask, "bias": dtop.sum(0), "out": act.T @ d, "out_bias": d.sum(0)}
            t += 1
            for name, g in grads.items():
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.999 * second[name] + 0.001 * g * g
                step = 0.004 * (first[name] / (1 - 0.9**t)) / (np.sqrt(second[name] / (1 - 0.999**t)) + 1e-8)
                getattr(net, name)[...] -= step.astype(np.float32)
    return net


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts: their bytes, text numbers and weights. The last window of a long text ends with it."""
    size = np.diff(offsets)
    each = np.maximum(1, -(-size // WINDOW))
    text = np.repeat(np.arange(len(size)), each)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each)
    new = np.clip(size[text] - nth * WINDOW, 0, WINDOW)
    start = np.minimum(nth * WINDOW, np.maximum(size[text] - WINDOW, 0))
    index = (offsets[:-1][text] + start)[:, None] + np.arange(WINDOW)
    inside = index < offsets[1:][text][:, None]
    padded = np.concatenate([_SMALL[data], np.zeros(1, np.uint8)])
    return np.where(inside, padded[np.minimum(index, len(data))], 0), text, new.astype(np.float64)


def held_out(key: Column) -> Column:
    """Is crc32 of the key as text, modulo 4, equal to 2? A null key is not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Network | None:
    """A network from labelled rows that are not held out; None without any.

    The sample: of each language the ROWS_A_LANGUAGE rows that come first by a hash of the key, and WINDOWS_A_ROW pieces spread
    over each of their texts. More than MOST_LANGUAGES languages are an error.
    """
    learn = docs.where(F.col(key).isNotNull() & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}") & ~held_out(F.col(key)))
    counts = keep(learn.groupBy(F.col(lang).alias("lang")).agg(F.count(F.lit(1)).alias("n")))
    langs = sorted(r.lang for r in counts.select("lang").limit(MOST_LANGUAGES + 1).collect())
    if not langs:
        return None
    if len(langs) > MOST_LANGUAGES:
        raise ValueError("too many languages")
    # the first of a language by hash are among those whose hash is below a share that three times as many rows meet, so no task sees more, however common a language is
    place = F.xxhash64(F.col(key)).bitwiseAND((1 << 53) - 1)
    rows = learn.select(F.col(key).alias("id"), F.col(lang).alias("lang"), place.alias("place")).join(F.broadcast(counts), "lang")
    few = rows.where(F.col("place") < F.least(F.lit(1.0), 3.0 * ROWS_A_LANGUAGE / F.col("n")) * float(1 << 53))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("place", "id"))
    chosen = keep(few.withColumn("nth", nth).where(F.col("nth") <= ROWS_A_LANGUAGE).select("id", "lang"))
    at = [F.substring(F.col(text), 1 + F.floor(F.length(text) * i / WINDOWS_A_ROW).cast("int"), F.lit(WINDOW)) for i in range(WINDOWS_A_ROW)]
    # at most ROWS_A_LANGUAGE * MOST_LANGUAGES ids: short enough to broadcast and to collect
    rows = learn.select(F.col(key).alias("id"), F.col(lang).alias("lang"), F.array(*at).alias("pieces")).join(F.broadcast(chosen), ["id", "lang"], "left_semi")
    found = sorted({(r.id, r.lang, tuple(r.pieces)) for r in rows.collect()})
    raw = [(p.encode()[:WINDOW], langs.index(name)) for _, name, pieces in found for p in dict.fromkeys(pieces) if p.strip()]
    x = np.zeros((len(raw), WINDOW), np.uint8)
    for i, (p, _) in enumerate(raw):
        x[i, : len(p)] = np.frombuffer(p, np.uint8)
    return train(_SMALL[x], np.array([k for _, k in raw]), langs)


def predictor(net: Network | None):
    """A mapInArrow function: (id, raw binary, letters boolean) to (id, lang_pred, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "raw", 1 << 20):
            n = batch.num_rows
            names, score = np.full(n, UNKNOWN, object), np.zeros(n)
            if net is not None:
                x, text, weight = windows(*spans(batch.column("raw")))
                p = net.predict(x) * weight[:, None]
                total = np.stack([np.bincount(text, p[:, k], n) for k in range(len(net.langs))], axis=1)
                total /= np.maximum(np.bincount(text, weight, n), 1)[:, None]
                known = batch.column("letters").to_numpy(zero_copy_only=False)
                names = np.where(known, np.array(net.langs, object)[total.argmax(axis=1)], UNKNOWN)
                score = np.where(known, np.clip(total.max(axis=1), 0, 1), 0.0)
            yield pa.RecordBatch.from_pydict({"id": batch.column(0), "lang_pred": pa.array(names, pa.string()), "score": pa.array(score)})

    return released(run)


def identify(docs: DataFrame, net: Network | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, lang_pred, score (0 to 1) for every row.

    A text that is null or has no letter is ``und`` with score 0; so is every text if nothing could be learnt. Of languages with equal probabilities the first in
    order of their names is taken. Only the
    text's bytes are an input of a prediction. Repeated rows are predicted each; a null key is kept and not held out; extra columns are not
    read; an empty table gives no rows.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("raw"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    found = rows.mapInArrow(predictor(net), f"id {kind}, lang_pred string, score double")
    return found.select(F.col("id").alias(key), held_out(F.col("id")).alias("held_out"), "lang_pred", "score")


def accepted(docs: DataFrame, net: Network | None, text: str = "text", least: float = 0.05) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has letters and is in some language with a score of ``least`` of the way from even odds to certainty.

    Even odds are one by the number of languages, which is the least score that there can be. Without a network, texts with letters are accepted.
    """
    if net is not None:
        least = 1 / len(net.langs) + least * (1 - 1 / len(net.langs))

    @F.arrow_udf("double")
    def score(raw: pa.Array) -> pa.Array:
        out = []
        for part in by_bytes(iter([pa.record_batch([raw], ["raw"])]), "raw", 1 << 20):
            x, row, weight = windows(*spans(part.column("raw")))
            p = net.predict(x) * weight[:, None]
            total = np.stack([np.bincount(row, p[:, k], part.num_rows) for k in range(len(net.langs))], axis=1)
            out.append(total.max(axis=1) / np.maximum(np.bincount(row, weight, part.num_rows), 1))
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    lettered = docs.where(F.col(text).rlike(r"\p{L}"))
    return lettered if net is None else lettered.where(score(F.col(text).cast("binary")) >= least)
