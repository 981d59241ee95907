"""Toxicity: a bidirectional gated recurrent network with attention, over overlapping windows.

A word's input is an embedding of its hash beside the mean embedding of its byte n-grams.
Both run through a gated recurrent layer in each direction, attention pools the states of a
window, and a document scores as its worst window does. Labels are of documents, so in
training a toxic document teaches through the window that looks worst, a clean one through
its worst and a random one. All of it is numpy, fitted on a bounded labelled sample.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import held_out, texts, training_rows

WINDOW, STRIDE = 32, 24  # words
WORD_BUCKETS, WORD_WIDTH = 4096, 8
GRAM_BUCKETS, GRAM_WIDTH = 8192, 12
GRAMS = (3, 4, 5, 6)
HIDDEN, ATTENTION = 8, 8
DECAY = 0.01  # per step, of the embeddings
EPOCHS, STEPS, BATCH = 6, 125, 96
PREDICT_SCORE = 0.5
# Bounds of the training sample.
ROWS_PER_CLASS = 1500
MAX_CHARS = 4000

_WORD = re.compile(r"[^\W_]+")
_AT_ONCE = 4096  # windows
_WORDS = 4096


def words_of(text: bytes) -> list[str]:
    return _WORD.findall(text.decode("utf-8", "replace").lower())


class Vocabulary:
    """Distinct words of some texts, with their hash buckets and those of their n-grams."""

    def __init__(self, documents: list[list[str]]):
        seen: dict[str, int] = {}
        self.codes = np.fromiter((seen.setdefault(w, len(seen)) for words in documents for w in words), np.int64)
        self.ends = np.cumsum([len(words) for words in documents], dtype=np.int64)
        raw = [w.encode("utf-8", "replace") for w in seen]
        self.size = len(raw)
        self.word = np.fromiter((zlib.crc32(w) % WORD_BUCKETS for w in raw), np.int64, len(raw))
        parts = [self._grams(raw[a : a + _WORDS]) for a in range(0, len(raw), _WORDS)] or [self._grams([])]
        begin = np.cumsum([0, *[len(grams) for grams, _ in parts[:-1]]])
        self.grams = np.concatenate([grams for grams, _ in parts])
        self.starts = np.concatenate([starts + a for (_, starts), a in zip(parts, begin, strict=True)])

    def spans(self) -> Iterator[tuple[slice, slice]]:
        """Some words at a time, as their n-grams are many: their places, and those of their n-grams."""
        for a in range(0, self.size, _WORDS):
            b = min(self.size, a + _WORDS)
            yield slice(a, b), slice(self.starts[a], self.starts[b] if b < self.size else len(self.grams))

    @staticmethod
    def _grams(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """N-gram buckets of all words on end, and where each word's begin.

        A word stands between two marks, so each has at least one n-gram.
        """
        text = np.frombuffer(b"".join([b"\x01" + w + b"\x02" for w in raw]), np.uint8).astype(np.uint32)
        lengths = np.fromiter((len(w) + 2 for w in raw), np.int64, len(raw))
        owner = np.repeat(np.arange(len(raw)), lengths)
        buckets, owners = [], []
        for n in GRAMS:
            count = len(text) - n + 1
            if count <= 0:
                continue
            inside = owner[:count] == owner[n - 1 :]
            mixed = np.full(count, 131 * n, np.uint32)
            for k in range(n):
                mixed = (mixed ^ text[k : k + count]) * np.uint32(2654435761)
            buckets.append(((mixed ^ (mixed >> np.uint32(16))) % np.uint32(GRAM_BUCKETS))[inside])
            owners.append(owner[:count][inside])
        if not buckets:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        buckets, owners = np.concatenate(buckets).astype(np.int32), np.concatenate(owners)
        order = np.argsort(owners, kind="stable")
        return buckets[order], np.searchsorted(owners[order], np.arange(len(raw)))

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Word codes by window (``size`` where a window has ended), and each window's document.

        Windows overlap and cover every word; a document without words has one empty window.
        """
        begin = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        length = self.ends - begin
        number = np.maximum(1, -(-(length - (WINDOW - STRIDE)) // STRIDE))
        owner = np.repeat(np.arange(len(number)), number)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
        at = (begin[owner] + nth * STRIDE)[:, None] + np.arange(WINDOW)
        padded = np.append(self.codes, self.size)
        return np.where(at < self.ends[owner][:, None], padded[np.minimum(at, len(self.codes))], self.size), owner


def sums_by(index: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of ``index``, and for each the sum of its rows."""
    order = np.argsort(index, kind="stable")
    found, first = np.unique(index[order], return_index=True)
    return found, np.add.reduceat(rows[order], first) if len(index) else rows


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


@dataclass
class GatedNetwork:
    """Parameters by name, and the calibration of a document's worst logit."""

    p: dict[str, np.ndarray] = field(default_factory=dict)
    scale: float = 1.0
    shift: float = 0.0

    @staticmethod
    def fresh(seed: int = 5) -> GatedNetwork:
        draw = np.random.default_rng(seed)

        def normal(*shape: int, size: float) -> np.ndarray:
            return draw.normal(0, size, shape).astype(np.float32)

        wide = WORD_WIDTH + GRAM_WIDTH
        return GatedNetwork(
            {
                "word": normal(WORD_BUCKETS, WORD_WIDTH, size=0.1),
                "gram": normal(GRAM_BUCKETS, GRAM_WIDTH, size=0.1),
                "wx": normal(wide, 6 * HIDDEN, size=wide**-0.5),
                "bx": np.zeros(6 * HIDDEN, np.float32),
                "u0": normal(HIDDEN, 3 * HIDDEN, size=HIDDEN**-0.5),
                "u1": normal(HIDDEN, 3 * HIDDEN, size=HIDDEN**-0.5),
                "wa": normal(2 * HIDDEN, ATTENTION, size=(2 * HIDDEN) ** -0.5),
                "ba": np.zeros(ATTENTION, np.float32),
                "va": normal(ATTENTION, size=ATTENTION**-0.5),
                "wo": normal(2 * HIDDEN, size=(2 * HIDDEN) ** -0.5),
                "bo": np.zeros(1, np.float32),
            }
        )

    def inputs(self, words: Vocabulary) -> np.ndarray:
        """Input of each word: its own embedding and the mean of its n-grams'."""
        if not words.size:
            return np.zeros((0, WORD_WIDTH + GRAM_WIDTH), np.float32)
        sums = np.empty((words.size, GRAM_WIDTH), np.float32)
        for own, grams in words.spans():
            sums[own] = np.add.reduceat(self.p["gram"][words.grams[grams]], words.starts[own] - grams.start)
        counts = np.diff(np.append(words.starts, len(words.grams)))
        return np.concatenate([self.p["word"][words.word], sums / counts[:, None]], 1)

    def gates(self, x: np.ndarray) -> np.ndarray:
        """The inputs' share of both directions' gates, with a last row for ended windows."""
        out = np.zeros((len(x) + 1, 6 * HIDDEN), np.result_type(x, self.p["wx"]))
        np.matmul(x, self.p["wx"], out=out[:-1])
        out[:-1] += self.p["bx"]
        return out

    def forward(self, gates: np.ndarray, ids: np.ndarray, keep: bool = False):
        """Logits of the windows, and with ``keep`` all that the way back needs."""
        p, (n, width), pad = self.p, ids.shape, len(gates) - 1
        live = ids != pad
        states = np.zeros((width, n, 2 * HIDDEN), np.float32)
        trace: list[dict[int, tuple]] = [{}, {}]
        for way in (0, 1):
            h, u = np.zeros((n, HIDDEN), np.float32), p[f"u{way}"]
            side = gates[:, 3 * HIDDEN * way : 3 * HIDDEN * (way + 1)]
            for t in range(width) if way == 0 else range(width - 1, -1, -1):
                g, hu = side[ids[:, t]], h @ u
                zr = sigmoid(g[:, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                c = np.tanh(g[:, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
                new = c + z * (h - c)
                new *= live[:, t, None]  # an ended window's state stays at zero
                if keep:
                    trace[way][t] = (h, hu, z, r, c)
                h = new
                states[t, :, HIDDEN * way : HIDDEN * (way + 1)] = h
        a = np.tanh(states @ p["wa"] + p["ba"])
        score = np.where(live.T, a @ p["va"], -1e9)
        share = np.exp(score - score.max(0))
        share /= share.sum(0)
        pooled = (share[..., None] * states).sum(0)
        logits = pooled @ p["wo"] + p["bo"][0]
        return (logits, (live, states, trace, a, share, pooled)) if keep else logits

    def backward(self, gates: np.ndarray, ids: np.ndarray, kept: tuple, error: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the parameters below the embeddings, and of ``gates``."""
        p, (n, width) = self.p, ids.shape
        live, states, trace, a, share, pooled = kept
        grad = {"wo": pooled.T @ error, "bo": np.array([error.sum()], np.float32)}
        d_pooled = error[:, None] * p["wo"]
        d_share = (states * d_pooled).sum(-1)
        d_score = share * (d_share - (share * d_share).sum(0))
        d_a = d_score[..., None] * p["va"] * (1 - a**2)
        grad |= {
            "va": np.einsum("tb,tba->a", d_score, a),
            "wa": np.einsum("tbh,tba->ha", states, d_a),
            "ba": d_a.sum((0, 1)),
        }
        d_states = share[..., None] * d_pooled + d_a @ p["wa"].T
        d_inputs = np.empty((width, n, 6 * HIDDEN), np.float32)
        for way in (0, 1):
            u, d_u, d_h = p[f"u{way}"], np.zeros_like(p[f"u{way}"]), np.zeros((n, HIDDEN), np.float32)
            for t in range(width - 1, -1, -1) if way == 0 else range(width):
                h, hu, z, r, c = trace[way][t]
                d_new = (d_h + d_states[t, :, HIDDEN * way : HIDDEN * (way + 1)]) * live[:, t, None]
                d_c = d_new * (1 - z) * (1 - c**2)
                d_z = d_new * (h - c) * z * (1 - z)
                d_r = d_c * hu[:, 2 * HIDDEN :] * r * (1 - r)
                d_hu = np.concatenate([d_z, d_r, d_c * r], 1)
                d_u += h.T @ d_hu
                d_h = d_new * z + d_hu @ u.T
                d_inputs[t, :, 3 * HIDDEN * way : 3 * HIDDEN * (way + 1)] = np.concatenate([d_z, d_r, d_c], 1)
            grad[f"u{way}"] = d_u
        d_gates = np.zeros_like(gates)
        found, sums = sums_by(ids.T.ravel(), d_inputs.reshape(-1, 6 * HIDDEN))
        d_gates[found] = sums
        return grad, d_gates

    def worst(self, words: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per document the highest window logit; also the windows, their owners and logits."""
        gates = self.gates(self.inputs(words))
        ids, owner = words.windows()
        logits = np.concatenate([self.forward(gates, ids[a : a + _AT_ONCE]) for a in range(0, len(ids), _AT_ONCE)] or [np.zeros(0)])
        top = np.full(len(words.ends), -np.inf)
        np.maximum.at(top, owner, logits)
        return top, ids, owner, logits

    def probability(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * logits + self.shift, -30, 30)))


def _seed_odds(net: GatedNetwork, words: Vocabulary, labels: np.ndarray) -> None:
    """Start the first number of each embedding at the bucket's log odds of toxic documents."""
    owner = np.searchsorted(words.ends, np.arange(len(words.codes)), "right")
    pairs = np.unique(owner * words.size + words.codes)
    doc, code = pairs // words.size, pairs % words.size
    counts = np.diff(np.append(words.starts, len(words.grams)))
    # Documents of each label that a word, or a word with an n-gram, occurs in.
    by_word = [np.bincount(code[labels[doc] == y], minlength=words.size) for y in (0, 1)]
    in_grams = [np.zeros(GRAM_BUCKETS) for _ in by_word]
    for own, grams in words.spans():
        for total, n in zip(in_grams, by_word, strict=True):
            total += np.bincount(words.grams[grams], np.repeat(n[own], counts[own]), GRAM_BUCKETS)
    in_words = [np.bincount(words.word, n, WORD_BUCKETS) for n in by_word]
    for name, (clean, toxic) in (("word", in_words), ("gram", in_grams)):
        many = [max(1, int((labels == y).sum())) for y in (0, 1)]
        # A few documents more of each label, so that a rare bucket says little.
        odds = np.log((toxic + 3) / (many[1] + 3)) - np.log((clean + 3 * many[0] / many[1]) / (many[0] + 3))
        net.p[name][:, 0] = np.clip(odds, -3, 3)


def fit_windows(documents: list[list[str]], labels: np.ndarray, rate: float = 0.01) -> GatedNetwork:
    """Train all parameters by Adam on the windows that teach.

    Each document is seen ``EPOCHS`` times, or more often in a small sample, so that there are
    about ``STEPS`` steps.
    """
    epochs = min(8 * EPOCHS, max(EPOCHS, -(-STEPS * BATCH // max(1, len(documents)))))
    net, draw, words = GatedNetwork.fresh(), np.random.default_rng(3), Vocabulary(documents)
    _seed_odds(net, words, labels)
    counts = np.diff(np.append(words.starts, len(words.grams)))
    state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0
    for epoch in range(epochs):
        if epoch < epochs // 3:  # the network knows nothing yet: go by the words' odds
            ids, owner = words.windows()
            x = net.inputs(words)
            odds = np.append(x[:, 0] + x[:, WORD_WIDTH], -np.inf)
            looks = odds[ids].max(1)
        else:
            _, ids, owner, looks = net.worst(words)
        order = np.lexsort((looks, owner))
        last = np.append(np.flatnonzero(np.diff(owner[order])), len(order) - 1)
        top = order[last]
        clean = np.flatnonzero(labels[owner] == 0)
        pick = np.concatenate([top, draw.choice(clean, min(len(clean), int((labels == 0).sum())), replace=False)])
        for batch in np.array_split(draw.permutation(pick), max(1, len(pick) // BATCH)):
            used, local = np.unique(ids[batch], return_inverse=True)
            local = local.reshape(len(batch), WINDOW)
            if used[-1] != words.size:
                used = np.append(used, words.size)
            own = used[:-1]
            number = counts[own]
            flat = np.repeat(words.starts[own] - (np.cumsum(number) - number), number) + np.arange(number.sum())
            grams, bucket = words.grams[flat], words.word[own]
            at = np.cumsum(number) - number
            mean = np.add.reduceat(net.p["gram"][grams], at) / number[:, None] if len(own) else np.zeros((0, GRAM_WIDTH))
            x = np.concatenate([net.p["word"][bucket], mean], 1).astype(np.float32)
            gates = net.gates(x)
            logits, kept = net.forward(gates, local, keep=True)
            y = labels[owner[batch]]
            error = ((sigmoid(logits) - y) / len(batch)).astype(np.float32)
            grad, d_gates = net.backward(gates, local, kept, error)
            d_gates = d_gates[:-1]
            grad["wx"], grad["bx"] = x.T @ d_gates, d_gates.sum(0)
            d_x = d_gates @ net.p["wx"].T
            touched = {
                "word": sums_by(bucket, d_x[:, :WORD_WIDTH]),
                "gram": sums_by(grams, np.repeat(d_x[:, WORD_WIDTH:] / number[:, None], number, 0)),
            }
            step += 1
            for k, (rows, g) in (touched | {k: (slice(None), g) for k, g in grad.items()}).items():
                m, v = state[k]  # an embedding's averages move when its row is used
                m[rows] = 0.9 * m[rows] + 0.1 * g
                v[rows] = 0.999 * v[rows] + 0.001 * g * g
                change = rate * (m[rows] / (1 - 0.9**step)) / (np.sqrt(v[rows] / (1 - 0.999**step)) + 1e-8)
                net.p[k][rows] -= change.astype(np.float32)
            for k in touched:
                net.p[k][:, 1:] *= 1 - DECAY
    return net


def fit(sample: list[tuple[str, int, float]]) -> GatedNetwork:
    """Fit on four fifths of the sample, calibrate on the rest by the labels' own shares.

    With fewer than two labels every text gets that label, and 0 without any rows.
    """
    from tripmill.llm.quality_rules import platt

    labels = np.array([y for _, y, _ in sample])
    if len(set(labels.tolist())) < 2:
        net = GatedNetwork.fresh()
        net.scale, net.shift = 0.0, 30.0 if len(labels) and labels[0] == 1 else -30.0
        return net
    once: dict[str, str] = {}  # each word is held once, however often it occurs
    documents = [[once.setdefault(w, w) for w in words_of(text.encode())] for text, _, _ in sample]
    apart = np.array([zlib.crc32(text.encode()) % 5 == 1 for text, _, _ in sample])
    if len(set(labels[apart].tolist())) < 2 or len(set(labels[~apart].tolist())) < 2:
        apart = np.zeros(len(labels), bool)
    net = fit_windows([d for d, a in zip(documents, apart, strict=True) if not a], labels[~apart])
    check = apart if apart.any() else ~apart
    logits = net.worst(Vocabulary([d for d, a in zip(documents, check, strict=True) if a]))[0]
    weights = np.array([w for _, _, w in sample])[check]
    net.scale, net.shift = platt(logits, labels[check], weights / weights.mean())
    return net


def scored(docs: DataFrame, labels: DataFrame, column: str = "toxicity") -> DataFrame:
    """``docs`` with a last column ``toxicity``, the probability that label toxic is 1.

    Columns stay as they are, but an input column of that name is replaced; every row is
    returned, repeated ones too. A null text is empty, and an empty text scores as a text
    without words. Without labelled rows every score is near 0. No rows give no rows.
    """
    net = fit(training_rows(docs, labels, "toxic", ROWS_PER_CLASS, MAX_CHARS))
    docs = docs.drop(column)
    out = docs.withColumn(column, F.lit(0.0)).schema

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                logits = net.worst(Vocabulary([words_of(t) for t in texts(part)]))[0]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(net.probability(logits))], names=out.names)

    return docs.mapInArrow(rows_of, out)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document; see ``scored``.

    Labels of held-out rows are never read, and ids only choose which rows those are; a null
    id counts as empty text there.
    """
    return scored(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), labels).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= PREDICT_SCORE).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, least: float = PREDICT_SCORE) -> DataFrame:
    """``docs`` without the rows that score ``least`` or more.

    Null and empty texts score like texts without words. Repeated rows go or stay together,
    and of texts that share an id, or lack one, each is judged for itself. Columns stay as
    they are, whatever their names. No rows give no rows, whatever the labels.
    """
    name = "toxicity"
    while name in docs.columns:
        name += "_"
    return scored(docs, labels, name).where(F.col(name) < least).drop(name)
