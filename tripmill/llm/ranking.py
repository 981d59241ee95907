"""Ranked lexical search, a term at a time with limited accumulators.

The index is partitioned by document: each task holds the postings of its own documents, block
by block. For each item of the query set the terms are taken rarest first, and each posting
adds to its document's accumulator. What a document can still gain is bounded by the best
postings of the terms left; once that cannot reach the k-th partial score, no accumulator is
created any more, and the survivors alone are updated, exactly, until the terms are used up.
The k-th score that a task has reached in earlier blocks holds as a bound in later ones.

Items may be many: they are searched in blocks of ``BLOCK_BYTES`` of text, which is all that
travels to the tasks. Scores are integers, so they depend on no order of summing.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import texts, written

TOP = 10
BLOCK_BYTES = 8 << 20
BLOCK_DOCS = 8192
INDEX = "doc_id long, n long, terms array<int>, tfs array<int>"
# Letters A-Z to lower case; ASCII other than letters and digits separates terms.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERMS).split()


class Query(NamedTuple):
    """An item: its known terms, rarest first, and what one unit of each adds."""

    number: int
    terms: np.ndarray
    weights: np.ndarray


def build_index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, tfs`` of every document with a term: its number of terms, and those
    of ``vocabulary`` it holds, by number, with their occurrences."""

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.get
        for batch in batches:
            ids, sizes, ends, terms, tfs = [], [], [0], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
                words = terms_of(text)
                if not words:
                    continue
                found, counts = np.unique(np.array([k for k in map(known, words) if k is not None], np.int32), return_counts=True)
                ids.append(doc_id)
                sizes.append(len(words))
                ends.append(ends[-1] + len(found))
                terms.append(found)
                tfs.append(counts.astype(np.int32))
            if ids:
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(x))) for x in (terms, tfs)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), *lists], names=["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(rows_of, INDEX)


def document_frequencies(index: DataFrame, size: int) -> np.ndarray:
    """In how many documents each of ``size`` terms occurs; each task sends its sums once."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["term", "df"])

    out = np.zeros(size, np.int64)
    for term, df in index.select("terms").mapInArrow(sums, "term int, df long").groupBy("term").agg(F.sum("df")).collect():
        out[term] = df
    return out


def top_rows(scores: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Places of the best ``top``: higher scores first, then lower ids."""
    if len(scores) > 4 * top:
        least = np.partition(scores, -top)[-top]
        near = np.flatnonzero(scores >= least)
        return near[np.lexsort((ids[near], -scores[near]))[:top]]
    return np.lexsort((ids, -scores))[:top]


class Postings:
    """The postings of one block of documents, by term: places of documents, and what a unit of
    weight earns there."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, ends: np.ndarray, terms: np.ndarray, tfs: np.ndarray, n_docs: int, n_words: int):
        self.ids = ids
        doc = np.repeat(np.arange(len(ids)), np.diff(ends))
        shares = 100 - 75 + (75 * sizes * n_docs) // n_words
        order = np.argsort(terms, kind="stable")
        doc, tf = doc[order], tfs[order].astype(np.int64)
        self.docs, self.units = doc, (1_000_000_000 * tf) // (1000 * tf + 8 * shares[doc])
        self.terms, first = np.unique(terms[order], return_index=True)
        self.cuts = np.append(first, len(doc))
        self.best = np.maximum.reduceat(self.units, first) if len(doc) else np.zeros(0, np.int64)

    def search(self, query: Query, top: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of all documents that may be among the best ``top``, given that
        ``top`` documents elsewhere score ``floor`` or more (0: not known)."""
        at = np.searchsorted(self.terms, query.terms)
        here = at < len(self.terms)
        here[here] = self.terms[at[here]] == query.terms[here]
        at, weights = at[here], query.weights[here]
        gains = weights * self.best[at]
        left = np.append(np.cumsum(gains[::-1])[::-1], 0)  # what the terms from the k-th on can add
        scores = np.zeros(len(self.ids), np.int64)

        def reached(partial: np.ndarray) -> int:
            if len(partial) < top:
                return floor
            return max(floor, int(np.partition(partial, len(partial) - top)[len(partial) - top]))

        k = 0
        while k < len(at):  # accumulators are created
            # The k-th partial score is at most the sum of the gains so far.
            if left[k] < max(floor, left[0] - left[k]) and left[k] < reached(scores):
                break
            own = slice(self.cuts[at[k]], self.cuts[at[k] + 1])
            scores[self.docs[own]] += weights[k] * self.units[own]
            k += 1
        alive = np.flatnonzero(scores)
        while k < len(at) and len(alive):  # survivors are updated
            alive = alive[scores[alive] + left[k] >= reached(scores[alive])]
            own = slice(self.cuts[at[k]], self.cuts[at[k] + 1])
            docs = self.docs[own]
            place = np.searchsorted(docs, alive)
            place[place == len(docs)] = 0
            hit = docs[place] == alive
            scores[alive[hit]] += weights[k] * self.units[own][place[hit]]
            k += 1
        return alive, scores[alive]


def _blocks(batches: Iterator[pa.RecordBatch], n_docs: int, n_words: int, block_docs: int) -> Iterator[Postings]:
    for batch in batches:
        for start in range(0, batch.num_rows, block_docs):
            part = batch.slice(start, block_docs)
            ids = part.column(0).fill_null(np.iinfo(np.int64).max).to_numpy()
            ends = np.append(0, np.cumsum(pa.compute.list_value_length(part.column(2)).to_numpy()))
            yield Postings(ids, part.column(1).to_numpy(), ends, part.column(2).flatten().to_numpy(), part.column(3).flatten().to_numpy(), n_docs, n_words)


def best_of_tasks(index: DataFrame, queries: list[Query], n_docs: int, n_words: int, top: int = TOP, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``number, doc_id, score``: the best ``top`` documents of each task for each query. A null
    id stands as the largest number."""

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        found = {q.number: nothing for q in queries}
        for block in _blocks(batches, n_docs, n_words, block_docs):
            for query in queries:
                scores, ids = found[query.number]
                floor = int(scores[-1]) if len(scores) == top else 0
                alive, more = block.search(query, top, floor)
                if len(alive):
                    scores, ids = np.append(scores, more), np.append(ids, block.ids[alive])
                    best = top_rows(scores, ids, top)
                    found[query.number] = scores[best], ids[best]
        for number, (scores, ids) in found.items():
            keep = scores > 0
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(keep.sum(), number)), pa.array(ids[keep]), pa.array(scores[keep])], names=["number", "doc_id", "score"])

    return index.mapInArrow(rows_of, "number long, doc_id long, score long")


def _ask(docs: DataFrame, items: list[tuple[int, bytes]], top: int, block_docs: int) -> DataFrame:
    """``number, doc_id, score``: the best documents of a block of items, over all tasks."""
    counted = {number: Counter(terms_of(text)) for number, text in items}
    vocabulary = {term: k for k, term in enumerate(sorted({t for c in counted.values() for t in c}))}
    index = written(build_index(docs, vocabulary), "lexical-index")
    n_docs, n_words = index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = document_frequencies(index, len(vocabulary))
    weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(f) + 1))) for f in df]
    queries = []
    for number, counts in counted.items():
        known = sorted((int(df[vocabulary[t]]), vocabulary[t], n) for t, n in counts.items() if df[vocabulary[t]])
        if known:
            queries.append(Query(number, np.array([k for _, k, _ in known], np.int32), np.array([n * weight[k] for _, k, n in known], np.int64)))
    return best_of_tasks(index, queries, n_docs, n_words, top, block_docs)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best documents of each item, all rows of
    ``docs`` against all rows of ``items``.

    Scores above 0 alone count. Among equal scores lower ids come first, null ids last, and
    repeated rows of ``docs`` each take a rank of their own. Null and empty texts have no
    terms; such items have no answer. Repeated rows of ``items`` are answered as often as they
    occur, and items that share an id each for itself. An empty table gives no rows. Other
    columns are not looked at. One item's text must fit a task.
    """
    own = items.select("item_id", F.col("text").cast("string").alias("text")).groupBy("item_id", "text").agg(F.count("*").alias("times"))
    own = written(own.withColumn("number", F.monotonically_increasing_id()), "search-items")
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = total // block_bytes + 1
    parts = []
    for block in range(blocks):
        rows = own.where(F.pmod(F.xxhash64("number"), F.lit(blocks)) == block).select("number", "text").collect()
        if rows:
            parts.append(_ask(docs, [(r["number"], (r["text"] or "").encode()) for r in rows], top, block_docs))
    if not parts:
        found = docs.sparkSession.createDataFrame([], "number long, doc_id long, score long")
    else:
        found = parts[0]
        for part in parts[1:]:
            found = found.unionByName(part)
    by_rank = Window.partitionBy("number").orderBy(F.desc("score"), F.asc("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= top)
    again = F.explode(F.expr("sequence(1, int(times))"))
    return ranked.join(own.select("number", "item_id", again.alias("time")), "number").select(
        "item_id", "rank", F.nullif("doc_id", F.lit(np.iinfo(np.int64).max)).alias("doc_id"), "score"
    )
