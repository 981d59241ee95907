from __future__ import annotations

import tracemalloc
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tests.llm.cases import corpus, documents
from tripmill.llm import toxicity
from tripmill.llm.toxicity import HIDDEN, STRIDE, WINDOW, GatedNetwork, Vocabulary

LARGE = "/root/testdata/sf0.1"


def test_windows_overlap_and_cover_every_word():
    documents_ = [[f"w{k}" for k in range(n)] for n in (0, 1, 5, STRIDE, WINDOW, WINDOW + 1, 200)]
    words = Vocabulary(documents_)
    ids, owner = words.windows()
    for k, doc in enumerate(documents_):
        own = ids[owner == k]
        codes = {f"w{c}" for c in own[own < words.size]}
        assert codes == set(doc)
        assert len(own) == max(1, -(-(len(doc) - (WINDOW - STRIDE)) // STRIDE))
        for before, after in zip(own, own[1:], strict=False):
            assert before[STRIDE:].tolist() == after[: WINDOW - STRIDE].tolist()


def test_many_words_at_a_time():
    names = [f"w{k}x{k % 977}" for k in range(2 * toxicity._WORDS + 5)]
    words = Vocabulary([names, names[:7]])
    ends = np.append(words.starts[1:], len(words.grams))
    for k in (0, 1, toxicity._WORDS - 1, toxicity._WORDS, len(names) - 1):
        assert words.grams[words.starts[k] : ends[k]].tolist() == Vocabulary([[names[k]]]).grams.tolist()
    net = GatedNetwork.fresh()
    plain = [net.p["gram"][words.grams[a:b]].mean(0) for a, b in zip(words.starts, ends, strict=True)]
    assert np.allclose(net.inputs(words)[:, toxicity.WORD_WIDTH :], plain, atol=1e-5)


def test_many_words_take_little_memory():
    documents_ = [[f"word{40 * k + n:x}" for n in range(40)] for k in range(1000)]
    labels, net = np.arange(1000) % 2, GatedNetwork.fresh()
    tracemalloc.start()
    words = Vocabulary(documents_)
    toxicity._seed_odds(net, words, labels)
    net.worst(words)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 42_000_000


def test_gradients_equal_differences():
    draw, net = np.random.default_rng(0), GatedNetwork.fresh()
    net.p = {k: v.astype(float) for k, v in net.p.items()}
    gates = draw.normal(size=(20, 6 * HIDDEN))
    gates[-1] = 0
    ids = draw.integers(0, 20, (5, WINDOW))
    ids[:, -9:] = 19
    ids[2, 3:] = 19
    y = np.array([0, 1, 0, 1, 1.0])
    logits, kept = net.forward(gates, ids, keep=True)
    grad, d_gates = net.backward(gates, ids, kept, 1 / (1 + np.exp(-logits)) - y)

    def slope(array, at) -> float:
        out, own = [], array[at]
        for step in (1e-3, -1e-3):
            array[at] = own + step
            out.append(np.logaddexp(0, np.where(y == 1, -1, 1) * net.forward(gates, ids)).sum())
        array[at] = own
        return (out[0] - out[1]) / 2e-3

    for name in ("wo", "va", "ba", "wa", "u0", "u1"):
        at = tuple(draw.integers(0, s) for s in net.p[name].shape)
        assert abs(slope(net.p[name], at) - grad[name][at]) < 1e-4
    for at in ((ids[0, 2], 5), (ids[1, 7], 30), (ids[3, 0], 47)):
        assert abs(slope(gates, at) - d_gates[at]) < 1e-4


def test_held_out_rows(spark):
    labels = spark.read.parquet(f"{LARGE}/labels.parquet")
    docs = spark.read.parquet(f"{LARGE}/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    rows = toxicity.score(docs, labels).join(labels, "doc_id").where("held_out").select("predicted", "toxic").collect()
    n = Counter((r["predicted"], r["toxic"]) for r in rows)
    # Some rows are labelled toxic without any word that says so.
    assert n[1, 1] / (n[0, 1] + n[1, 1]) > 0.8
    assert n[0, 0] / (n[0, 0] + n[1, 0]) > 0.97


def test_documents_of_all_kinds(spark):
    labels = spark.createDataFrame([(1, 1, 0), (4, 1, 1), (4, 1, 1), (7, 1, 0), (None, 1, 1), (2, 0, None)], "doc_id long, quality int, toxic int")
    clash = documents(spark).withColumns({"toxicity": F.lit("x"), "score": F.lit(0), "toxic": F.lit(1)})
    out = toxicity.score(clash, labels).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(r[0] for r in corpus())
    assert all(0 <= r["score"] <= 1 for r in out)
    kept = toxicity.drop_toxic(clash, labels)
    assert kept.columns == clash.columns


def test_no_rows_and_no_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.score(documents(spark, []), none).collect() == []
    assert toxicity.drop_toxic(documents(spark), none).count() == len(corpus())


def plain_logit(net: GatedNetwork, window: list[str]) -> float:
    """One window, a number at a time."""
    p = {k: v.astype(float) for k, v in net.p.items()}

    def input_of(word: str) -> np.ndarray:
        raw = word.encode()
        marked, buckets = b"\x01" + raw + b"\x02", []
        for n in toxicity.GRAMS:
            for k in range(len(marked) - n + 1):
                mixed = 131 * n
                for byte in marked[k : k + n]:
                    mixed = ((mixed ^ byte) * 2654435761) % (1 << 32)
                buckets.append((mixed ^ (mixed >> 16)) % toxicity.GRAM_BUCKETS)
        return np.append(p["word"][zlib.crc32(raw) % toxicity.WORD_BUCKETS], np.mean([p["gram"][b] for b in buckets], 0))

    sides = []
    for way, words in ((0, window), (1, window[::-1])):
        h, states, u = np.zeros(HIDDEN), [], p[f"u{way}"]
        for word in words:
            g = (input_of(word) @ p["wx"] + p["bx"])[3 * HIDDEN * way : 3 * HIDDEN * (way + 1)]
            own = h @ u
            z = 1 / (1 + np.exp(-(g[:HIDDEN] + own[:HIDDEN])))
            r = 1 / (1 + np.exp(-(g[HIDDEN : 2 * HIDDEN] + own[HIDDEN : 2 * HIDDEN])))
            h = z * h + (1 - z) * np.tanh(g[2 * HIDDEN :] + r * own[2 * HIDDEN :])
            states.append(h)
        sides.append(states if way == 0 else states[::-1])
    both = [np.append(a, b) for a, b in zip(*sides, strict=True)]
    if not both:
        return float(p["bo"][0])
    looks = np.array([np.tanh(s @ p["wa"] + p["ba"]) @ p["va"] for s in both])
    share = np.exp(looks - looks.max()) / np.exp(looks - looks.max()).sum()
    return float(sum(a * s for a, s in zip(share, both, strict=True)) @ p["wo"] + p["bo"][0])


def test_documents_score_as_their_worst_window_does():
    draw, net = np.random.default_rng(2), GatedNetwork.fresh()
    net.p["bx"] += draw.normal(0, 0.3, net.p["bx"].shape).astype(np.float32)
    texts = [[f"wörd{k}" for k in draw.integers(0, 30, n)] for n in (0, 1, 2, STRIDE, WINDOW, WINDOW + 1, 90)]
    top = net.worst(Vocabulary(texts))[0]
    for words, logit in zip(texts, top, strict=True):
        windows = [words[a : a + WINDOW] for a in range(0, max(1, len(words) - (WINDOW - STRIDE)), STRIDE)]
        assert abs(max(plain_logit(net, w) for w in windows) - logit) < 1e-4


def test_held_out_labels_are_not_read(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(300)
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    results = [sorted(map(tuple, toxicity.score(docs, of).collect())) for of in (labels, flipped)]
    assert results[0] == results[1]


def test_very_long_texts(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1)], "doc_id long, quality int, toxic int")
    rows = [(1, "some words of it " * 40_000, None, None, 0), (2, "y" * 1_000_000, None, None, 0)]
    out = toxicity.score(documents(spark, rows), labels).collect()
    assert sorted(r["doc_id"] for r in out) == [1, 2] and all(0 <= r["score"] <= 1 for r in out)
