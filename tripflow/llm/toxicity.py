"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

Words (lower case) fall into 2^BUCKET_BITS hash buckets, each with a small vector; filters of width 1, 2 and 3
slide over the words of the whole text; each filter keeps its largest response (a passage anywhere in a long
text counts in full); a logistic layer on these maxima gives the raw score. Buckets that the training sample
hardly saw have a zero vector and cannot move a score. A threshold is calibrated for each language on sampled
rows that the weights were not trained on; at scoring time the language comes from the text alone, by the
n-gram filters, and the score is moved so that 0.5 is the threshold of that language.

Defined results: a null or empty text has all maxima at zero and the score of that; without labelled rows of both
classes the score is the share of toxic rows (0 without any); repeated rows get equal scores; an empty table
gives an empty table; the added column is `score`, all others come from `keep`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm import langid
from tripflow.llm.common import FOLD, PLAIN_WORD, RangeHash, free_name, lean, row_bytes, sliced, word_spans

BUCKET_BITS = 20
DIMENSIONS = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
# The fit uses about so many labelled rows of each class, chosen by a hash of their text.
ROWS_PER_CLASS = (5000, 2500)
LEAST_TEXTS = 3
EPOCHS = 6
# A bucket's first estimate is drawn to zero as if so many texts had said nothing.
SHRINK = 10
BATCH = 64


def buckets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every word, and for each row the index of its first word (n + 1)."""
    body, offsets = row_bytes(column)
    starts, ends, first = word_spans(body, offsets, PLAIN_WORD)
    hashes = RangeHash(body, FOLD)(starts, ends)
    return (hashes & np.uint64((1 << BUCKET_BITS) - 1)).astype(np.int32), first


@dataclass
class Network:
    """`row` maps a bucket to its vector; row 0 is the zero vector of unknown words."""

    row: np.ndarray
    vectors: np.ndarray
    kernels: dict[int, np.ndarray]
    biases: dict[int, np.ndarray]
    weights: np.ndarray
    intercept: float

    def maxima(self, words: np.ndarray, first: np.ndarray, places: bool = False):
        """Largest response of each filter per text (texts x filters, at least 0) and where it stands (-1: nowhere)."""
        n = len(first) - 1
        out = np.zeros((n, len(WIDTHS) * FILTERS), np.float32)
        at = np.full(out.shape, -1, np.int64)
        vectors = self.vectors[self.row[words]]
        last = first[1:]
        for i, width in enumerate(WIDTHS):
            sizes = last - first[:-1] - width + 1
            live = np.flatnonzero(sizes > 0)
            m = len(words) - width + 1
            if not len(live) or m <= 0:
                continue
            kernel = self.kernels[width]
            response = vectors[:m] @ kernel[0]
            for k in range(1, width):
                response += vectors[k : k + m] @ kernel[k]
            response += self.biases[width]
            # Windows that run into the next text lie between the segments [first, last - width].
            bounds = np.empty(2 * len(live), np.int64)
            bounds[::2], bounds[1::2] = first[live], first[live] + sizes[live]
            pad = np.vstack([response, np.full((1, FILTERS), -np.inf, np.float32)])
            top = np.maximum.reduceat(pad, bounds, axis=0)[::2]
            columns = slice(i * FILTERS, (i + 1) * FILTERS)
            out[live, columns] = np.maximum(top, 0)
            if places:
                for r, t in enumerate(live):
                    a, b = first[t], first[t] + sizes[t]
                    best = a + response[a:b].argmax(axis=0)
                    at[t, columns] = np.where(top[r] > 0, best, -1)
        return out, at

    def logits(self, words: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.maxima(words, first)[0] @ self.weights + self.intercept


def train(texts: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Network:
    """Adam on the logistic loss, classes weighted alike; `texts` are bucket arrays."""
    rng = np.random.default_rng(seed)
    sizes = np.array([len(t) for t in texts], np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    flat = np.concatenate(texts) if len(texts) else np.empty(0, np.int32)
    pairs = np.unique(doc.astype(np.int64) << BUCKET_BITS | flat)
    used, counts = np.unique(pairs & ((1 << BUCKET_BITS) - 1), return_counts=True)
    positive = np.bincount(
        np.searchsorted(used, pairs & ((1 << BUCKET_BITS) - 1)), labels[pairs >> BUCKET_BITS], minlength=len(used)
    )
    frequent = counts >= LEAST_TEXTS
    used, counts, positive = used[frequent], counts[frequent], positive[frequent]
    row = np.zeros(1 << BUCKET_BITS, np.int32)
    row[used] = np.arange(1, len(used) + 1)
    share = max(labels.mean(), 1e-6)
    # The first dimension starts at the smoothed log odds of the bucket, so that rare words are found at once.
    odds = np.log((positive + share) / (counts - positive + 1 - share) * (1 - share) / share)
    vectors = rng.normal(0, 0.05, (len(used) + 1, DIMENSIONS)).astype(np.float32)
    vectors[1:, 0] = 0.5 * odds * counts / (counts + SHRINK)
    vectors[0] = 0
    kernels = {w: rng.normal(0, 0.15, (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS}
    for w in WIDTHS:
        kernels[w][0, 0] += 0.7
    biases = {w: np.full(FILTERS, -0.4, np.float32) for w in WIDTHS}
    net = Network(row, vectors, kernels, biases, np.full(len(WIDTHS) * FILTERS, 0.1, np.float32), -1.0)
    parameters = [net.vectors, *kernels.values(), *biases.values(), net.weights, np.array([net.intercept], np.float32)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
    weight = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for low in range(0, len(order), BATCH):
            chosen = order[low : low + BATCH]
            words = np.concatenate([texts[k] for k in chosen])
            first = np.concatenate([[0], np.cumsum(sizes[chosen])])
            pooled, at = net.maxima(words, first, places=True)
            logit = pooled @ net.weights + parameters[-1][0]
            error = (1 / (1 + np.exp(-logit)) - labels[chosen]) * weight[chosen] / len(chosen)
            grads = [np.zeros_like(p) for p in parameters]
            grads[-1][0] = error.sum()
            grads[-2][:] = pooled.T @ error + 1e-4 * net.weights
            through = error[:, None] * net.weights[None, :] * (at >= 0)
            for i, width in enumerate(WIDTHS):
                text, filt = np.nonzero(at[:, i * FILTERS : (i + 1) * FILTERS] >= 0)
                g = through[text, i * FILTERS + filt].astype(np.float32)
                np.add.at(grads[1 + len(WIDTHS) + i], filt, g)
                for k in range(width):
                    r = row[words[at[text, i * FILTERS + filt] + k]]
                    np.add.at(grads[1 + i][k].T, filt, g[:, None] * net.vectors[r])
                    np.add.at(grads[0], r, g[:, None] * kernels[width][k][:, filt].T)
            grads[0][0] = 0
            step += 1
            rate = 0.01 * min(1, step / 20)
            for p, g, (m, v) in zip(parameters, grads, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.intercept = float(parameters[-1][0])
    return net


def best_threshold(logits: np.ndarray, labels: np.ndarray) -> float:
    """The cut with the fewest errors, a missed text counting twice; between the two logits next to it, in the middle of equally good cuts."""
    order = np.argsort(logits, kind="stable")
    x, y = logits[order], labels[order]
    errors = 2 * np.concatenate([[0], np.cumsum(y)]) + (1 - y).sum() - np.concatenate([[0], np.cumsum(1 - y)])
    best = np.flatnonzero(errors == errors.min())
    cut = int(best[len(best) // 2])
    if cut == 0 or cut == len(x):
        return float(x[0] - 1 if cut == 0 else x[-1] + 1)
    return float((x[cut - 1] + x[cut]) / 2)


@dataclass
class Toxicity:
    network: Network | None
    languages: langid.LanguageFilter
    thresholds: dict[str, float]
    default: float
    constant: float = 0.0
    scale: float = field(default=1.0)

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), self.constant)
        logit = self.network.logits(*buckets(texts))
        langs: list[str] = []
        for part in langid.text_slices(texts.to_pylist()):
            langs += self.languages.predict(part)[0]
        cut = np.array([self.thresholds.get(k, self.default) for k in langs])
        return 1 / (1 + np.exp(-np.clip((logit - cut) * self.scale, -30, 30)))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    lang: str = "lang",
    rows_per_class: tuple[int, int] = ROWS_PER_CLASS,
    min_positives: int = 15,
) -> Toxicity:
    """Learn from a bounded sample of `labels` (id, label 0/1) and its texts in `docs` (id, text, language).

    The sample is drawn from the labels alone, so the documents are joined with a list of bounded size.
    Languages serve the calibration; labelled ids without a document and other labels than 0 and 1 are left out.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    languages = langid.fit(rows, rows_per_language=1000)
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).where("label in (0, 1)")
    seen = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(seen) < 2:
        return Toxicity(None, languages, {}, 0.0, constant=float(1 in seen))
    scale = 1 << 30
    limit = F.when(F.col("label") == 1, min(scale, scale * rows_per_class[1] // seen[1])).otherwise(
        min(scale, scale * rows_per_class[0] // seen[0])
    )
    chosen = known.where(F.pmod(F.xxhash64("id", F.lit("toxicity")), F.lit(scale)) < limit)
    # About as many rows as `rows_per_class` allows, whatever the corpus: repeated ids count once.
    chosen = chosen.groupBy("id").agg(F.max("label").alias("label"))
    sample = rows.join(F.broadcast(chosen), "id").groupBy("id").agg(F.max("label").alias("label"), F.min("text").alias("text"))

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "text"):
                words, first = buckets(part.column("text"))
                langs: list[str] = []
                for some in langid.text_slices(part.column("text").to_pylist()):
                    langs += languages.predict(some)[0]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key"),
                        part.column("label"),
                        pa.array(langs, pa.string()),
                        pa.array([words[a:b].astype("<i4").tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary()),
                    ],
                    ["key", "label", "lang", "words"],
                )

    keyed = sample.select(F.xxhash64("text").alias("key"), "label", "text")
    got = keyed.mapInArrow(lean(ids), "key long, label int, lang string, words binary").toArrow()
    order = np.argsort(got.column("key").to_numpy(), kind="stable")
    words = [np.frombuffer(w, "<i4") for w in got.column("words").to_pylist()]
    words = [words[k] for k in order]
    labels = got.column("label").to_numpy()[order].astype(np.int64)
    langs = np.array(got.column("lang").to_pylist(), object)[order]
    del got
    if len(set(labels.tolist())) < 2:
        return Toxicity(None, languages, {}, 0.0, constant=float(labels.any()))
    # The weights learn from four fifths of the sample, the thresholds from the rest.
    apart = np.arange(len(words)) % 5 == 4
    thresholds, default = {}, 0.0
    if 0 < labels[~apart].sum() < (~apart).sum() and 0 < labels[apart].sum() < apart.sum():
        network = train([w for w, a in zip(words, apart, strict=True) if not a], labels[~apart])
        some = [w for w, a in zip(words, apart, strict=True) if a]
        logit = network.logits(np.concatenate(some), np.concatenate([[0], np.cumsum([len(w) for w in some])]))
        default = best_threshold(logit, labels[apart])
        for k in sorted(set(langs[apart])):
            own = langs[apart] == k
            positives = int(labels[apart][own].sum())
            if min(positives, int(own.sum()) - positives) >= min_positives:
                thresholds[k] = best_threshold(logit[own], labels[apart][own])
    else:
        network = train(words, labels)
    return Toxicity(network, languages, thresholds, default)


def score(docs: DataFrame, model: Toxicity, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns `keep` and `score`, one row per input row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    body = free_name([*keep, "score"], "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, body, 1 << 20):
                scores = shared.value.scores(part.column(body))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array(scores, pa.float64())], [*keep, "score"]
                )

    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("score", T.DoubleType())])
    return docs.select(*keep, F.col(text).alias(body)).mapInArrow(lean(run), schema)
