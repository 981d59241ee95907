"""Quality rules: base counts of a text, and a hashed n-gram logistic regression.

The features of a text are the shares of its word unigrams and bigrams and of its byte 1-,
2- and 3-grams in hashed buckets, as a mean over its segments. The regression is fitted on a bounded sample of labelled
rows, its scores are calibrated (Platt) on rows it was not fitted on, and whole texts are
scored in Arrow batches against a fixed threshold.
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

from tripmill.llm.common import texts, training_rows

WORD_BUCKETS = 2048
CHAR_BUCKETS = 1024
CHAR_LENGTHS = (1, 2, 3)
SEGMENT = 3000
KEEP_SCORE = 0.3
# Bounds of the training sample.
ROWS_PER_CLASS = 1000
MAX_CHARS = 6000

SYMBOLS = b"#*$%&|<>"
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_SYMBOL = bytes(1 if b in SYMBOLS else 0 for b in range(256))
_CONTINUES = bytes(1 if 0x80 <= b < 0xC0 else 0 for b in range(256))


def _numbered(words: list[bytes]) -> np.ndarray:
    """Equal words get equal small numbers."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """How many words lie in windows of ``width`` words that occur twice or more.

    Windows are compared exactly, by numbering pairs, then pairs of pairs, and so on.
    """
    n = len(words) - width + 1
    if n < 2:
        return 0
    ones = _numbered(words)
    ranks, length = ones, 1
    while length < width:
        # Double the length while it fits, then go on word by word.
        more = length if 2 * length <= width else 1
        after = ranks if more == length else ones
        count = len(words) - length - more + 1
        keys = ranks[:count] * len(words) + after[length : length + count]
        ranks, length = np.unique(keys, return_inverse=True)[1], length + more
    again = np.bincount(ranks)[ranks] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(again)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + width, -1)
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of a UTF-8 text."""
    words = text.split()  # bytes split at ASCII white space alone
    joined = b"".join(words)
    word_chars = len(joined) - joined.translate(_CONTINUES).count(1)
    seen: set[bytes] = set()
    repeated = 0
    for line in text.split(b"\n"):
        if line.split(None, 1):
            repeated += line in seen
            seen.add(line)
    return len(words), word_chars, text.translate(_SYMBOL).count(1), repeated, repeated_words(words)


_POWERS = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917))


def char_buckets(text: np.ndarray, length: int) -> np.ndarray:
    """Buckets of all byte n-grams of one length."""
    n = len(text) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint32)
    mixed = np.full(n, 97 * length, np.uint32)
    for k in range(length):
        mixed = (mixed ^ text[k : k + n]) * _POWERS[k]
    mixed ^= mixed >> np.uint32(15)
    return (mixed * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - CHAR_BUCKETS.bit_length() + 1)


class WordBuckets(dict):
    """Bucket of each word; remembers up to a fixed number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 300_000:
            self.clear()
        found = self[word] = zlib.crc32(word)
        return found


def word_buckets(words: list[bytes], memo: WordBuckets) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and of the pairs of neighbours."""
    codes = np.fromiter(map(memo.__getitem__, words), np.uint32, len(words))
    pairs = codes[:-1] * np.uint32(2654435761) + codes[1:]
    pairs[codes[:-1] == codes[1:]] = 0  # a word said twice is one kind of pair, whatever the word
    shift = np.uint32(32 - WORD_BUCKETS.bit_length() + 1)
    return (codes * np.uint32(2654435761)) >> shift, (pairs * np.uint32(2246822519)) >> shift


def families(text: bytes, memo: WordBuckets) -> list[tuple[np.ndarray, int]]:
    """The n-gram buckets of a text with the number of buckets, by kind of n-gram."""
    raw = np.frombuffer(text, np.uint8).astype(np.uint32)
    words, pairs = word_buckets(text.split(), memo)
    return [(words, WORD_BUCKETS), (pairs, WORD_BUCKETS)] + [(char_buckets(raw, n), CHAR_BUCKETS) for n in CHAR_LENGTHS]


def segments(text: bytes) -> Iterator[bytes]:
    """The text in stretches of about ``SEGMENT`` bytes that end at white space."""
    begin = 0
    while len(text) - begin > SEGMENT:
        found = _SPACE.search(text, begin + SEGMENT)
        end = found.end() if found else len(text)
        yield text[begin:end]
        begin = end
    yield text[begin:]


def features(text: bytes, memo: WordBuckets) -> np.ndarray:
    """Root shares per bucket, as a mean over the text's segments, so that a long text weighs
    as its parts do. A kind without n-grams is all zero."""
    total = np.zeros(2 * WORD_BUCKETS + len(CHAR_LENGTHS) * CHAR_BUCKETS, np.float32)
    for part in segments(text):
        weight, at = len(part) / max(1, len(text)), 0
        for buckets, size in families(part, memo):
            if len(buckets):
                total[at : at + size] += weight * np.sqrt(np.bincount(buckets, minlength=size) / len(buckets))
            at += size
    return total


@dataclass
class NgramModel:
    """Linear weights with their calibration; ``score`` is the probability of label 1."""

    weights: np.ndarray
    bias: float
    scale: float = 1.0
    shift: float = 0.0

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return rows @ self.weights + self.bias

    def probability(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * raw + self.shift, -30, 30)))


def fit_logistic(rows: np.ndarray, labels: np.ndarray, weights: np.ndarray, l2: float = 1e-4, steps: int = 200) -> tuple[np.ndarray, float]:
    """Weighted logistic regression by accelerated full-batch gradient steps."""
    w = np.zeros(rows.shape[1], np.float32)
    ahead, bias, bias_ahead = w.copy(), 0.0, 0.0
    share = (weights / weights.sum()).astype(np.float32)
    step = 4.0 / (1.0 + float((rows**2).sum(1).max()))
    for k in range(steps):
        p = 1 / (1 + np.exp(-np.clip(rows @ ahead + bias_ahead, -30, 30)))
        error = (share * (p - labels)).astype(np.float32)
        grad, grad_bias = rows.T @ error + l2 * ahead, float(error.sum())
        new, new_bias = ahead - step * grad, bias_ahead - step * grad_bias
        momentum = k / (k + 3)
        ahead, bias_ahead = new + momentum * (new - w), new_bias + momentum * (new_bias - bias)
        w, bias = new, new_bias
    return w, bias


def platt(raw: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Scale and shift that make ``raw`` a log odds, by damped Newton steps."""
    x = np.stack([raw, np.ones_like(raw)], 1).astype(float)
    # Targets a little inside 0 and 1, as with few rows the fit would otherwise run away.
    n1, n0 = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        grad = x.T @ (weights * (p - target))
        hess = (x * (weights * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        theta = theta - step * min(1.0, 2.0 / (1e-9 + np.abs(step).max()))
    return float(theta[0]), float(theta[1])


def fit(sample: list[tuple[str, int, float]]) -> NgramModel:
    """Fit on four fifths of the sample, classes counting equally; calibrate on the rest.

    The calibration weighs rows as their labels weigh in the corpus. A sample with fewer than
    two labels gives a model whose score is that label for every text, or 1 without any rows.
    """
    labels = np.array([y for _, y, _ in sample], np.float32)
    size = 2 * WORD_BUCKETS + len(CHAR_LENGTHS) * CHAR_BUCKETS
    if len(set(labels.tolist())) < 2:
        return NgramModel(np.zeros(size, np.float32), -30.0 if len(labels) and labels[0] == 0 else 30.0)
    memo = WordBuckets()
    rows = np.stack([features(text.encode(), memo) for text, _, _ in sample])
    apart = np.array([zlib.crc32(text.encode()) % 5 == 1 for text, _, _ in sample])
    if len(set(labels[apart].tolist())) < 2 or len(set(labels[~apart].tolist())) < 2:
        apart = np.zeros(len(labels), bool)
    equal = np.where(labels == 1, len(labels) / labels.sum(), len(labels) / (1 - labels).sum())
    model = NgramModel(*fit_logistic(rows[~apart], labels[~apart], equal[~apart]))
    check = apart if apart.any() else ~apart
    natural = np.array([w for _, _, w in sample])
    model.scale, model.shift = platt(model.raw(rows[check]), labels[check], (natural / natural.mean())[check])
    return model


def score_texts(batch: list[bytes], model: NgramModel, memo: WordBuckets) -> np.ndarray:
    """Calibrated probabilities of whole texts."""
    raw = np.array([float(features(text, memo) @ model.weights) + model.bias for text in batch])
    return model.probability(raw) if len(batch) else raw


def judge(docs: DataFrame, labels: DataFrame, keep_score: float = KEEP_SCORE) -> DataFrame:
    """Per document the base counts, ``base_failed``, ``score`` and ``kept``.

    Returns ``doc_id`` and those columns, one row per input row, repeated rows included; a
    null text is empty, has no words and so fails the base rules. Neither ids nor labels are
    inputs of a score. Without labelled rows the base rules alone decide.
    """
    model = fit(training_rows(docs, labels, "quality", ROWS_PER_CLASS, MAX_CHARS))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    schema = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in counts], ("score", pa.float64())])

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordBuckets()
        for batch in batches:
            own = list(texts(batch))
            columns = list(zip(*map(base_counts, own), strict=True)) or [[]] * len(counts)
            arrays = [pa.array(c, pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays, pa.array(score_texts(own, model, memo))], schema=schema)

    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .mapInArrow(rows_of, f"doc_id long, {', '.join(f'{c} long' for c in counts)}, score double")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= keep_score))
    )
