"""Quality classifier: random-indexing word vectors, pooled, under a two-layer network.

Every token has a fixed sparse index vector, drawn from its hash. A token's word vector is
the sum of the index vectors of its neighbours over the whole corpus, without the part that
all tokens share. Tokens are hashed into a fixed number of buckets, so the vectors are a
table of fixed size however large the corpus: each task sums its own, and Spark adds them.
A document is the mean of its word vectors; a small numpy network fitted on a bounded
labelled sample scores it, and a temperature calibrates the scores.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import held_out, texts, training_rows

BUCKETS = 8192
AGAIN = BUCKETS  # a token equal to the one before it
GAP = BUCKETS + 1  # between documents
WIDTH = 48
NONZERO = 2
REACH = 2
HIDDEN = 24
PREDICT_SCORE = 0.3
# Bounds of the training sample.
ROWS_PER_CLASS = 1500
MAX_CHARS = 8000

_TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^\s0-9A-Za-z\x80-\xff]+")
_CHUNK = 200_000


class Codes(dict):
    """Bucket of each token; remembers up to a fixed number of tokens."""

    def __missing__(self, token: bytes) -> int:
        if len(self) >= 300_000:
            self.clear()
        found = self[token] = zlib.crc32(token) % BUCKETS
        return found


def token_codes(text: bytes, memo: Codes) -> np.ndarray:
    tokens = _TOKEN.findall(text)
    codes = np.fromiter(map(memo.__getitem__, tokens), np.int64, len(tokens))
    if len(codes) > 1:
        again = codes[1:] == codes[:-1]
        codes[1:][again] = AGAIN
    return codes


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Per bucket the places and the signs of its index vector; the gap's signs are zero."""
    draw = np.random.default_rng(7)
    places = draw.integers(0, WIDTH, (GAP + 1, NONZERO))
    signs = draw.choice([-1.0, 1.0], (GAP + 1, NONZERO))
    signs[GAP] = 0
    return places, signs


def add_contexts(codes: np.ndarray, into: np.ndarray, places: np.ndarray, signs: np.ndarray) -> None:
    """Add to each token's row the index vectors of its neighbours."""
    for apart in range(1, REACH + 1):
        left, right = codes[:-apart], codes[apart:]
        for word, near in ((left, right), (right, left)):
            for k in range(NONZERO):
                into += np.bincount(word * WIDTH + places[near, k], signs[near, k], into.size)


def context_sums(docs: DataFrame) -> np.ndarray:
    """Sums of neighbours' index vectors per bucket, over every document."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        total, memo = np.zeros((GAP + 1) * WIDTH), Codes()
        waiting: list[np.ndarray] = []
        size, gap = 0, np.full(REACH, GAP)
        for batch in batches:
            for text in texts(batch):
                codes = token_codes(text, memo)
                waiting += [codes, gap]
                size += len(codes) + REACH
                if size >= _CHUNK:
                    add_contexts(np.concatenate(waiting), total, places, signs)
                    waiting, size = [], 0
        if waiting:
            add_contexts(np.concatenate(waiting), total, places, signs)
        table = total.reshape(GAP + 1, WIDTH)[:GAP]
        used = np.flatnonzero(np.abs(table).sum(1))
        yield pa.RecordBatch.from_arrays([pa.array(used), *[pa.array(table[used, k]) for k in range(WIDTH)]], names=names)

    names = ["bucket", *[f"v{k}" for k in range(WIDTH)]]
    rows = docs.select(F.col("text").cast("string")).mapInArrow(sums, ", ".join(["bucket long", *[f"{c} double" for c in names[1:]]]))
    out = np.zeros((GAP + 1, WIDTH))
    for row in rows.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in names[1:]]).collect():  # at most BUCKETS + 1 rows
        out[row["bucket"]] = row[1:]
    return out


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Unit vectors without the direction that all buckets share; unused buckets are zero."""
    sizes = np.linalg.norm(sums, axis=1, keepdims=True)
    unit = sums / np.maximum(sizes, 1e-9)
    used = sizes[:, 0] > 0
    if used.any():
        unit[used] -= unit[used].mean(0)
    return (unit / np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(text: bytes, vectors: np.ndarray, memo: Codes) -> np.ndarray:
    """The mean of a text's word vectors; zero without words."""
    codes = token_codes(text, memo)
    return vectors[codes].mean(0) if len(codes) else np.zeros(WIDTH, np.float32)


@dataclass
class Network:
    """Two layers over standardised inputs, with a temperature."""

    center: np.ndarray
    spread: np.ndarray
    layers: list[np.ndarray]  # weights and biases: W1, b1, W2, b2
    temperature: float = 1.0

    def logits(self, rows: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((rows - self.center) / self.spread @ w1 + b1) @ w2 + b2[0]

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(rows) / self.temperature, -30, 30)))


def fit_network(rows: np.ndarray, labels: np.ndarray, weights: np.ndarray, epochs: int = 150, rate: float = 0.01) -> Network:
    """Full training by Adam in mini-batches, on the weighted log loss."""
    draw = np.random.default_rng(11)
    net = Network(
        rows.mean(0),
        rows.std(0) + 1e-6,
        [draw.normal(0, WIDTH**-0.5, (rows.shape[1], HIDDEN)), np.zeros(HIDDEN), draw.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)],
    )
    x = (rows - net.center) / net.spread
    first, second, step = [np.zeros_like(p) for p in net.layers], [np.zeros_like(p) for p in net.layers], 0
    for _ in range(epochs):
        for pick in np.array_split(draw.permutation(len(x)), max(1, len(x) // 128)):
            w1, b1, w2, b2 = net.layers
            h = np.tanh(x[pick] @ w1 + b1)
            p = 1 / (1 + np.exp(-np.clip(h @ w2 + b2[0], -30, 30)))
            e = weights[pick] * (p - labels[pick]) / len(pick)
            back = np.outer(e, w2) * (1 - h**2)
            grads = [x[pick].T @ back + 1e-4 * w1, back.sum(0), h.T @ e + 1e-4 * w2, np.array([e.sum()])]
            step += 1
            for k, g in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                net.layers[k] = net.layers[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return net


def best_temperature(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The temperature of least log loss, between a twentieth and twenty."""

    def loss(t: float) -> float:
        return float((weights * np.logaddexp(0, np.where(labels == 1, -logits, logits) / t)).sum())

    return float(min(np.geomspace(0.05, 20, 240), key=loss))


def fit(sample: list[tuple[str, int, float]], vectors: np.ndarray) -> Network:
    """Fit on four fifths of the sample, set the temperature on the rest.

    Rows weigh as their labels do in the corpus. With fewer than two labels the network
    gives that label to every text, and 1 without any rows.
    """
    labels = np.array([y for _, y, _ in sample], float)
    memo = Codes()
    if len(set(labels.tolist())) < 2:
        sure = -20.0 if len(labels) and labels[0] == 0 else 20.0
        none = [np.zeros((WIDTH, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), np.array([sure])]
        return Network(np.zeros(WIDTH), np.ones(WIDTH), none)
    rows = np.stack([pooled(text.encode(), vectors, memo) for text, _, _ in sample]).astype(float)
    weights = np.array([w for _, _, w in sample])
    weights /= weights.mean()
    apart = np.array([zlib.crc32(text.encode()) % 5 == 1 for text, _, _ in sample])
    if len(set(labels[apart].tolist())) < 2 or len(set(labels[~apart].tolist())) < 2:
        apart = np.zeros(len(labels), bool)
    net = fit_network(rows[~apart], labels[~apart], weights[~apart])
    check = apart if apart.any() else ~apart
    net.temperature = best_temperature(net.logits(rows[check]), labels[check], weights[check])
    return net


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document, repeated rows included.

    ``score`` is the probability that the text's quality label is 1. Labels of held-out rows
    are never read, and ids only choose which rows are held out; a null id counts as empty
    text there. A null text is empty. Without labelled rows every score is near 1. No rows
    give no rows.
    """
    vectors = word_vectors(context_sums(docs))
    net = fit(training_rows(docs, labels, "quality", ROWS_PER_CLASS, MAX_CHARS), vectors)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Codes()
        for batch in batches:
            rows = np.stack([pooled(text, vectors, memo) for text in texts(batch)]) if batch.num_rows else np.zeros((0, WIDTH))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(net.probability(rows))], names=["doc_id", "score"])

    return (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .mapInArrow(scores, "doc_id long, score double")
        .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= PREDICT_SCORE).cast("int").alias("predicted"))
    )
