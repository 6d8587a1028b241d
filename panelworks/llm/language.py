"""Language identification by a convolutional network over bytes, trained in numpy.

A text is cut into fixed-length windows of bytes.  Filters of several widths slide over the embedded
bytes of a window, each filter's maximum is kept, and a softmax layer turns the maxima into
probabilities of languages.  A document's probabilities are the mean over all its windows,
weighted by their bytes.

The network is trained on a bounded sample of labelled windows.  For prediction, filters
are folded into tables over pairs of bytes, so that a window position costs two lookups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelworks.llm.common import map_batches, slices, utf8

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
# Bound of the sample the driver sees: documents per language and in all, windows per document.
DOCUMENTS = 400
SAMPLE = 20_000
WINDOWS = 4
EPOCHS = 8
BATCH = 64
UNDETERMINED = "und"
# Windows scored at once, so that the working arrays stay in the processor's cache.
TOGETHER = 1024


@dataclass
class Network:
    languages: list[str]
    symbol: np.ndarray  # (256,) number of each byte; 0 for padding and bytes never seen
    embedding: np.ndarray  # (symbols, EMBEDDING)
    filters: list[np.ndarray]  # per width: (width, EMBEDDING, FILTERS)
    bias: np.ndarray  # (widths * FILTERS,)
    dense: np.ndarray  # (widths * FILTERS, languages)
    dense_bias: np.ndarray

    def weights(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, self.bias, self.dense, self.dense_bias]

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Contributions of the pair of bytes at a position, and of the pair two later."""
        taps = [np.einsum("se,wef->wsf", self.embedding, f) for f in self.filters]
        near, far = [], []
        for width, tap in zip(WIDTHS, taps, strict=True):
            near.append(tap[0][:, None, :] + tap[1][None, :, :])
            zero = np.zeros_like(near[-1])
            if width == 3:
                far.append(zero + tap[2][:, None, :])
            elif width == 4:
                far.append(tap[2][:, None, :] + tap[3][None, :, :])
        pairs = len(self.embedding) ** 2
        return (
            np.ascontiguousarray(np.concatenate(near, 2).reshape(pairs, -1), np.float32),
            np.ascontiguousarray(np.concatenate(far, 2).reshape(pairs, -1), np.float32),
        )


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(windows: list[bytes], labels: list[str], epochs: int = EPOCHS, seed: int = 0) -> Network:
    """Fit a network by Adam on the cross entropy; the same input gives the same network.

    Languages weigh the same however many windows they have.
    """
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    target = np.array([languages.index(x) for x in labels])
    raw = np.zeros((len(windows), WINDOW), np.uint8)
    for i, window in enumerate(windows):
        raw[i, : len(window)] = np.frombuffer(window, np.uint8)
    seen = np.unique(raw[raw > 0])
    symbol = np.zeros(256, np.int64)
    symbol[seen] = np.arange(1, len(seen) + 1)
    x = symbol[raw]
    maxima = len(WIDTHS) * FILTERS
    net = Network(
        languages,
        symbol,
        rng.normal(0, 0.5, (len(seen) + 1, EMBEDDING)),
        [rng.normal(0, (2 / (w * EMBEDDING)) ** 0.5, (w, EMBEDDING, FILTERS)) for w in WIDTHS],
        np.zeros(maxima),
        rng.normal(0, maxima**-0.5, (maxima, len(languages))),
        np.zeros(len(languages)),
    )
    weight = len(target) / (len(languages) * np.bincount(target, minlength=len(languages)))
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in net.weights()]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        rate = 4e-3 * (1 - epoch / epochs)
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            step += 1
            for w, g, (m, v) in zip(
                net.weights(), _gradients(net, x[rows], target[rows], weight), moments, strict=True
            ):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def _gradients(net: Network, x: np.ndarray, target: np.ndarray, weight: np.ndarray):
    n = np.arange(len(x))
    best, places = [], []
    for width, filters in zip(WIDTHS, net.filters, strict=True):
        taps = np.einsum("se,wef->wsf", net.embedding, filters).astype(np.float32)
        length = WINDOW - width + 1
        out = sum(taps[o][x[:, o : o + length]] for o in range(width))
        place = out.argmax(1)
        places.append(place)
        best.append(np.take_along_axis(out, place[:, None, :], 1)[:, 0, :])
    before = np.concatenate(best, 1) + net.bias
    pooled = np.maximum(before, 0)
    error = _softmax(pooled @ net.dense + net.dense_bias)
    error[n, target] -= 1
    error *= weight[target][:, None] / len(x)
    back = (error @ net.dense.T) * (before > 0)
    embedding = np.zeros_like(net.embedding)
    filters = []
    for k, (width, place) in enumerate(zip(WIDTHS, places, strict=True)):
        own = back[:, k * FILTERS : (k + 1) * FILTERS]
        grad = np.zeros_like(net.filters[k])
        for o in range(width):
            at = x[n[:, None], place + o]
            grad[o] = np.einsum("nf,nfe->ef", own, net.embedding[at])
            np.add.at(embedding, at, own[:, :, None] * net.filters[k][o].T[None])
        filters.append(grad)
    return [embedding, *filters, back.sum(0), pooled.T @ error, error.sum(0)]


def predict(net: Network, tables: tuple[np.ndarray, np.ndarray], texts: list[bytes]) -> np.ndarray:
    """(texts, languages): mean probabilities over all windows of each whole text.

    Windows overlap, so that a filter of any width sees each place of the text.
    """
    lengths = np.array([len(t) for t in texts], np.int64)
    stride = WINDOW - max(WIDTHS) + 1
    windows = np.maximum(1, -(-(lengths - max(WIDTHS) + 1) // stride))
    first = np.cumsum(windows) - windows
    owner = np.repeat(np.arange(len(texts)), windows)
    inside = np.arange(len(owner)) - first[owner]
    # each text is padded to its last window's end
    sizes = (windows - 1) * stride + WINDOW
    begins = np.cumsum(sizes) - sizes
    padded = np.zeros(int(sizes.sum()), np.uint8)
    for text, at in zip(texts, begins, strict=True):
        padded[at : at + len(text)] = np.frombuffer(text, np.uint8)
    places = begins[owner] + inside * stride
    scores = np.concatenate(
        [
            _score(net, tables, padded[places[i : i + TOGETHER, None] + np.arange(WINDOW)])
            for i in range(0, len(places), TOGETHER)
        ]
    )
    share = np.clip(lengths[owner] - inside * stride, 1, WINDOW)
    total = np.add.reduceat(scores * share[:, None], first, axis=0)
    return total / total.sum(1, keepdims=True)


def _score(net: Network, tables: tuple[np.ndarray, np.ndarray], raw: np.ndarray) -> np.ndarray:
    near, far = tables
    x = np.zeros((WINDOW + 2, len(raw)), net.symbol.dtype)
    x[:WINDOW] = net.symbol[raw].T
    pair = x[:-1] * len(net.embedding) + x[1:]
    best = np.full((len(raw), near.shape[1]), -np.inf, np.float32)
    out, more = np.empty_like(best), np.empty((len(raw), far.shape[1]), np.float32)
    for i in range(WINDOW - min(WIDTHS) + 1):
        np.take(near, pair[i], axis=0, out=out, mode="clip")
        np.take(far, pair[i + 2], axis=0, out=more, mode="clip")
        out[:, FILTERS:] += more
        fit = sum(i + width <= WINDOW for width in WIDTHS) * FILTERS  # the others reach too far
        np.maximum(best[:, :fit], out[:, :fit], out=best[:, :fit])
    return _softmax(np.maximum(best + net.bias, 0) @ net.dense + net.dense_bias)


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: a fifth, by the checksum of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample_windows(labelled: DataFrame, documents: int = DOCUMENTS, windows: int = WINDOWS):
    """(lang, doc_id, windows): hashed positions of the ``documents`` rows of each language
    whose id hashes lowest.  ``labelled`` has doc_id, text and lang.

    Ids are chosen without reading texts.  At most ``SAMPLE`` are chosen, evenly over the
    languages, which bounds the broadcast of the chosen ids and what the driver collects.
    """
    lowest = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        labelled.where("lang is not null and doc_id is not null")
        .select("lang", "doc_id")
        .withColumn("place", F.row_number().over(lowest))
        .where(F.col("place") <= documents)
        .orderBy("place", F.xxhash64("doc_id"), "lang", "doc_id")
        .limit(SAMPLE)
        .select(F.col("lang").alias("_lang"), F.col("doc_id").alias("_id"))
        .distinct()
    )
    text = F.col("text").cast("binary")
    last = F.greatest(F.length(text) - WINDOW, F.lit(0))
    cuts = [
        F.substring(
            text,
            (F.pmod(F.xxhash64("doc_id", F.lit(i)), F.lit(1 << 40)) % (last + 1)).cast("int") + 1,
            F.lit(WINDOW),
        )
        for i in range(windows)
    ]
    return (
        labelled.join(
            F.broadcast(chosen),
            (F.col("lang") == F.col("_lang")) & (F.col("doc_id") == F.col("_id")),
        )
        .where(F.col("text").rlike(r"\p{L}"))
        .select("lang", "doc_id", F.array(*cuts).alias("windows"))
    )


def fit(labelled: DataFrame, documents: int = DOCUMENTS, windows: int = WINDOWS) -> Network | None:
    """A network trained on the bounded sample; None if there is nothing to learn from."""
    rows = sorted(sample_windows(labelled, documents, windows).collect())
    pairs = [(bytes(w), row["lang"]) for row in rows for w in dict.fromkeys(row["windows"])]
    if not pairs:
        return None
    return train([w for w, _ in pairs], [lang for _, lang in pairs])


def identify(
    docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, lang_pred, score for every row, from the whole text alone.

    Null texts and texts without a letter are ``und`` with score 0, as is everything
    if there was nothing to learn from.
    """
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.when(text.rlike(r"\p{L}"), text).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.tables() if net else None
        for x in slices(batches):
            texts = utf8(x.column("text"))
            names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            some = [i for i, t in enumerate(texts) if t] if net else []
            if some:
                found = predict(net, tables, [texts[i] for i in some])
                for i, k in zip(some, found.argmax(1), strict=True):
                    names[i] = net.languages[k]
                scores[some] = found.max(1)
            yield pa.RecordBatch.from_arrays(
                [x.column("doc_id"), pa.array(names), pa.array(scores)],
                names=["doc_id", "lang_pred", "score"],
            )

    return map_batches(rows, run, "doc_id bigint, lang_pred string, score double")
