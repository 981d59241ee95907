from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.llm.cases import SCHEMA, corpus, documents
from tripmill.llm import quality_network, quality_rules

MEDIUM = "/root/testdata/sf0.01"


def brute_counts(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    often = Counter(windows)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    hit = {p for k, w in enumerate(windows) if often[w] > 1 for p in range(k, k + 5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_counts_equal_brute_force():
    draw = random.Random(8)
    texts = ["".join(draw.choice("ab\n \t#é|") for _ in range(draw.randint(0, 90))) for _ in range(800)]
    texts += [" ".join(draw.choice("ab") for _ in range(draw.randint(0, 40))) for _ in range(200)]
    texts += [r[1] or "" for r in corpus()]
    for text in texts:
        assert quality_rules.base_counts(text.encode()) == brute_counts(text), text


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{MEDIUM}/labels.parquet")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{MEDIUM}/documents.parquet")


def accuracy(scored, labels, column) -> float:
    rows = scored.join(labels, "doc_id").where(F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
    return rows.select(F.avg((column == F.col("quality")).cast("double"))).first()[0]


def test_rules_on_held_out_rows(docs, labels):
    out = quality_rules.judge(docs, labels)
    # Texts under ten words fail the base rules whatever their label.
    long = out.where("n_words >= 10")
    assert accuracy(long, labels, F.col("kept").cast("int")) > 0.95


def test_network_on_held_out_rows(docs, labels):
    out = quality_network.score(docs, labels)
    assert accuracy(out, labels, F.col("predicted")) > 0.95
    assert out.count() == docs.count()
    assert out.where("held_out <> (crc32(cast(doc_id as string)) % 5 = 0)").isEmpty()


@pytest.mark.parametrize("judge", [quality_rules.judge, quality_network.score])
def test_documents_of_all_kinds(spark, labels, judge):
    clash = documents(spark).withColumns({"score": F.lit("x"), "kept": F.lit(1), "quality": F.lit(0), "n_words": F.lit(2)})
    out = judge(clash, labels).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(r[0] for r in corpus())
    assert all(0 <= r["score"] <= 1 for r in out)


def test_rules_of_all_kinds_by_brute_force(spark, labels):
    rows = quality_rules.judge(documents(spark), labels).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = sorted((repr(r["doc_id"]), *[r[n] for n in names], r["base_failed"]) for r in rows)
    want = []
    for doc_id, text, *_ in corpus():
        c = brute_counts(text)
        want.append((repr(doc_id), *c, c[0] < 10 or 100 * c[4] > 20 * c[0]))
    assert got == sorted(want)
    assert not any(r["kept"] and r["base_failed"] for r in rows)


@pytest.mark.parametrize("judge", [quality_rules.judge, quality_network.score])
def test_no_rows_and_no_labels(spark, labels, judge):
    assert judge(documents(spark, []), labels).collect() == []
    none = spark.createDataFrame([(None, 1, None), (2, None, None)], "doc_id long, quality int, toxic int")
    assert all(r["score"] > 0.99 for r in judge(documents(spark), none).collect())


def test_scores_do_not_follow_ids_or_held_out_labels(spark, docs, labels):
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    other = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r["doc_id"]: r["score"] for r in quality_rules.judge(docs, labels).collect()}
    b = {r["doc_id"]: r["score"] for r in quality_rules.judge(docs, other).collect()}
    assert a == b


def test_token_codes_mark_repeats():
    codes = quality_network.token_codes(b"the the cat, cat the", quality_network.Codes())
    assert (codes == quality_network.AGAIN).tolist() == [False, True, False, False, False, False]
    assert quality_network.token_codes(b"", quality_network.Codes()).tolist() == []
    assert codes[0] == zlib.crc32(b"the") % quality_network.BUCKETS


def test_long_text_is_read_whole(spark, docs, labels):
    """What comes behind 100,000 characters counts as what stands before them."""
    labelled = docs.join(labels, "doc_id").orderBy("doc_id").collect()
    good = "\n".join([r["text"] for r in labelled if r["quality"] == 1][:60])
    junk = "\n".join([r["text"] for r in labelled if r["quality"] == 0 and "$$$" in r["text"]])
    whole = good + "\n" + junk * (1 + 2 * len(good) // len(junk))
    rows = [(-1, good, None, None, None), (-2, whole, None, None, None)]
    both = docs.unionByName(spark.createDataFrame(rows, SCHEMA))
    out = {r["doc_id"]: r for r in quality_rules.judge(both, labels).where("doc_id < 0").collect()}
    assert len(good) > 100_000 and out[-2]["n_symbols"] == brute_counts(whole)[2]
    assert out[-2]["score"] < 0.5 < out[-1]["score"]


def plain_codes(text: str) -> list[int]:
    """Buckets of the tokens, a token equal to the one before it as ``AGAIN``."""
    tokens = re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^\s0-9A-Za-z\x80-\xff]+", text.encode())
    codes = [zlib.crc32(t) % quality_network.BUCKETS for t in tokens]
    return [quality_network.AGAIN if k and codes[k] == codes[k - 1] else c for k, c in enumerate(codes)]


def test_context_sums_equal_a_loop_over_neighbours(spark):
    rows = corpus()
    places, signs = quality_network.index_vectors()
    want = np.zeros((quality_network.GAP + 1, quality_network.WIDTH))
    for row in rows:
        codes = plain_codes(row[1] or "")
        for i, word in enumerate(codes):
            for j in range(max(0, i - quality_network.REACH), min(len(codes), i + quality_network.REACH + 1)):
                if i != j:
                    for place, sign in zip(places[codes[j]], signs[codes[j]], strict=True):
                        want[word, place] += sign
    assert np.allclose(quality_network.context_sums(documents(spark).repartition(3)), want)


def test_pooling_and_network_equal_plain_versions():
    draw = np.random.default_rng(4)
    vectors = quality_network.word_vectors(draw.normal(size=(quality_network.GAP + 1, quality_network.WIDTH)))
    memo, net = quality_network.Codes(), None
    texts_ = [r[1] or "" for r in corpus()]
    pooled = np.stack([quality_network.pooled(t.encode(), vectors, memo) for t in texts_])
    for text, row in zip(texts_, pooled, strict=True):
        codes = plain_codes(text)
        want = sum((vectors[c].astype(float) for c in codes), np.zeros(quality_network.WIDTH)) / max(1, len(codes))
        assert np.allclose(row, want, atol=1e-5)
    labels = (pooled[:, 0] > np.median(pooled[:, 0])).astype(float)
    net = quality_network.fit_network(pooled.astype(float), labels, np.ones(len(labels)))
    net.temperature = 1.7
    w1, b1, w2, b2 = net.layers
    for row, got in zip(pooled, net.probability(pooled), strict=True):
        x = [(v - c) / s for v, c, s in zip(row, net.center, net.spread, strict=True)]
        hidden = [math.tanh(sum(a * w for a, w in zip(x, w1[:, k], strict=True)) + b1[k]) for k in range(quality_network.HIDDEN)]
        logit = sum(h * w for h, w in zip(hidden, w2, strict=True)) + b2[0]
        assert abs(got - 1 / (1 + math.exp(-max(-30, min(30, logit / 1.7))))) < 1e-6
    # Training lowers the loss that a constant has.
    assert np.logaddexp(0, np.where(labels == 1, -net.logits(pooled), net.logits(pooled))).mean() < 0.3


def test_held_out_labels_are_not_read(docs, labels):
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    results = [sorted(map(tuple, quality_network.score(docs.limit(400), of).collect())) for of in (labels, flipped)]
    assert results[0] == results[1]


def test_network_on_very_long_texts(spark, labels):
    rows = [(1, "word other thing. " * 100_000, None, None, 0), (2, "x" * 2_000_000, None, None, 0), (3, "a few words", None, None, 0)]
    out = quality_network.score(documents(spark, rows), labels).collect()
    assert sorted(r["doc_id"] for r in out) == [1, 2, 3] and all(0 <= r["score"] <= 1 for r in out)
