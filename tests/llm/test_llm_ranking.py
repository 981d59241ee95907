from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import SCHEMA, corpus, documents, words
from tripmill.llm import ranking

ASCII = {c: c + 32 for c in range(65, 91)}
ITEMS = "item_id long, text string"


def terms(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(ASCII))


def brute(docs: list[tuple], items: list[tuple], top: int = 10) -> list[tuple]:
    counted = [(r[0], Counter(terms(r[1]))) for r in docs if terms(r[1])]
    n_docs, n_words = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, c in counted:
            m = 100 - 75 + (75 * sum(c.values()) * n_docs) // n_words
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in terms(text) if c[t]
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, k + 1, d, -s) for k, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:top])]
    return sorted(out, key=repr)


def found(df) -> list[tuple]:
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def queries(seed: int = 5) -> list[tuple]:
    draw = random.Random(seed)
    own = [(k, words(draw, n)) for k, n in enumerate((1, 2, 8, 40))]
    return [*own, own[2], (2, "W1 w1 w2"), (None, "w3 É"), (9, None), (10, ""), (11, "nowhere"), (12, "ñ ü"), (13, words(draw, 3000, 60))]


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
@pytest.mark.parametrize("block_docs", [3, 8192])
def test_against_brute_force(spark, block_bytes, block_docs):
    items = queries()
    df = spark.createDataFrame(items, ITEMS)
    assert found(ranking.search(documents(spark).repartition(3), df, 10, block_bytes, block_docs)) == brute(corpus(), items)


def test_ties_and_many_documents(spark):
    draw = random.Random(2)
    texts = [words(draw, draw.randint(1, 30), 25) for _ in range(300)]
    docs = [(draw.randrange(400), draw.choice(texts), None, None, 0) for _ in range(900)]
    items = [(k, words(draw, draw.randint(1, 12), 30)) for k in range(25)]
    df = spark.createDataFrame(docs, SCHEMA).repartition(4)
    assert found(ranking.search(df, spark.createDataFrame(items, ITEMS), 4, block_docs=40)) == brute(docs, items, 4)


def test_a_block_keeps_every_document_that_may_be_among_the_best():
    draw = np.random.default_rng(3)
    for _ in range(200):
        n, vocabulary = int(draw.integers(1, 60)), 12
        held = draw.random((n, vocabulary)) < draw.random(vocabulary)
        tfs = draw.integers(1, 6, (n, vocabulary))
        sizes = draw.integers(10, 90, n)
        ends = np.append(0, np.cumsum(held.sum(1)))
        block = ranking.Postings(np.arange(n), sizes, ends, np.nonzero(held)[1].astype(np.int32), tfs[held].astype(np.int32), n, int(sizes.sum()))
        df = held.sum(0)
        order = [int(t) for t in np.argsort(df, kind="stable") if df[t]]
        weights = draw.integers(0, 4000, len(order))
        query = ranking.Query(0, np.array(order, np.int32), weights)
        m = 25 + 75 * sizes * n // sizes.sum()
        units = np.where(held, 1_000_000_000 * tfs // (1000 * tfs + 8 * m[:, None]), 0)
        exact = (units[:, order] * weights).sum(1)
        for floor in (0, int(np.median(exact))):
            alive, scores = block.search(query, 3, floor)
            assert (scores == exact[alive]).all()
            least = max(floor, sorted(exact)[-3] if n >= 3 else 0)
            assert set(np.flatnonzero((exact >= least) & (exact > 0))) <= set(alive)


def test_no_accumulators_once_the_rest_cannot_reach():
    n = 1000  # one rare term in ten documents, one that all hold
    ends = np.append(0, np.cumsum([2] * 10 + [1] * (n - 10)))
    terms_ = np.array([0, 1] * 10 + [1] * (n - 10), np.int32)
    block = ranking.Postings(np.arange(n), np.full(n, 5), ends, terms_, np.ones(len(terms_), np.int32), n, 5 * n)
    alive, _ = block.search(ranking.Query(0, np.array([0, 1], np.int32), np.array([5000, 1])), 10, 0)
    assert len(alive) == 10


def test_odd_tables(spark):
    items = spark.createDataFrame(queries(), ITEMS)
    assert found(ranking.search(documents(spark, []), items)) == []
    assert found(ranking.search(documents(spark), spark.createDataFrame([], ITEMS))) == []
    clash = documents(spark).withColumns({c: F.lit("x") for c in ("item_id", "rank", "score", "n", "terms", "number")})
    more = items.withColumns({c: F.lit(1.5) for c in ("doc_id", "times", "number", "score")})
    assert found(ranking.search(clash, more)) == brute(corpus(), queries())


def test_a_very_long_text(spark):
    draw = random.Random(8)
    docs = [(1, words(draw, 300_000, 5000), None, None, 0), (2, words(draw, 50, 5000), None, None, 0), (3, "w1 " * 200_000, None, None, 0)]
    items = [(1, words(draw, 30, 5000)), (2, "w1")]
    assert found(ranking.search(documents(spark, docs), spark.createDataFrame(items, ITEMS))) == brute(docs, items)
