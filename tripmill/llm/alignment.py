"""Cross-tokenizer alignment by products of token-byte incidence matrices.

A tokenizer's tokens of one text form a sparse matrix, in compressed sparse rows: a row for each
token, a one in each byte that the token covers. With A and B the matrices of two tokenizers,
A·Bᵀ has an entry wherever an A token overlaps a B token: Gustavson's row products add up, for
each byte of an A token, the row of Bᵀ that names the B token there. Bytes where both
tokenizations end cut the text into groups; the same product over token-group incidences links
the tokens that share a group.

How often two ids are linked in the whole corpus is added up by Spark. Of these counts at most
``HOT_PAIRS`` go to every task, those of the most frequent id pairs; the others meet their
documents in a join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import texts, written
from tripmill.llm.packing import _OTHER

HOT_PAIRS = 1 << 20
_DOCS_AT_ONCE = 256
_SUMMED_AT_ONCE = 1 << 21


class CSR(NamedTuple):
    """A sparse matrix by rows: row i has ``columns[starts[i]:starts[i + 1]]``, in order."""

    starts: np.ndarray
    columns: np.ndarray


def by_bytes(lengths: np.ndarray) -> CSR:
    """Tokens by bytes: token i covers the ``lengths[i]`` bytes behind those of the tokens before."""
    starts = np.append(0, np.cumsum(lengths))
    return CSR(starts, np.arange(starts[-1]))


def by_groups(ends: np.ndarray, cuts: np.ndarray) -> CSR:
    """Tokens by groups: a token that ends at byte ``ends[i]`` lies in the first group to end there or later."""
    return CSR(np.arange(len(ends) + 1), np.searchsorted(cuts, ends))


def transposed(matrix: CSR, n_columns: int) -> CSR:
    rows = np.repeat(np.arange(len(matrix.starts) - 1), np.diff(matrix.starts))
    counts = np.bincount(matrix.columns, minlength=n_columns)
    return CSR(np.append(0, np.cumsum(counts)), rows[np.argsort(matrix.columns, kind="stable")])


def row_sizes(left: CSR, right: CSR) -> np.ndarray:
    """How many entries of ``right`` each entry of ``left`` meets."""
    return np.diff(right.starts)[left.columns]


def row_products(left: CSR, right: CSR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The product's entries ``row, column, value``, row by row.

    Each entry (i, k) of ``left`` adds row k of ``right`` to row i. Tokens follow the bytes, so
    what falls on one entry stands together and is summed there.
    """
    sizes = row_sizes(left, right)
    rows = np.repeat(np.repeat(np.arange(len(left.starts) - 1), np.diff(left.starts)), sizes)
    before = np.cumsum(sizes) - sizes
    columns = right.columns[np.arange(len(rows)) - np.repeat(before - right.starts[left.columns], sizes)]
    new = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]) | (columns[1:] != columns[:-1]))[: len(rows)])
    return rows[new], columns[new], np.diff(np.append(new, len(rows)))


class Alignment(NamedTuple):
    """Two tokenizations of one text: ids, bytes where tokens end, and where groups end."""

    a: np.ndarray
    b: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    cuts: np.ndarray

    def overlap_links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of A and B tokens that overlap, and by how many bytes."""
        n = int(self.a_ends[-1]) if len(self.a_ends) else 0
        left, right = (by_bytes(np.diff(np.append(0, e))) for e in (self.a_ends, self.b_ends))
        return row_products(left, transposed(right, n))

    def group_links(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of A and B tokens of one group, each pair of them."""
        left, right = by_groups(self.a_ends, self.cuts), by_groups(self.b_ends, self.cuts)
        return row_products(left, transposed(right, len(self.cuts)))[:2]

    def n_group_links(self) -> int:
        """How many pairs ``group_links`` has, from the row sizes alone."""
        left, right = by_groups(self.a_ends, self.cuts), by_groups(self.b_ends, self.cuts)
        return int(row_sizes(left, transposed(right, len(self.cuts))).sum())

    def groups(self) -> str:
        """``a1,a2|b1;a3|b2,b3``: the ids of each group."""
        a, b = (np.searchsorted(self.cuts, e) for e in (self.a_ends, self.b_ends))  # each token's group
        # Groups hold their A tokens and then their B tokens: a token stands behind the tokens
        # of its own side before it and those of the other side in earlier (for B: also in its own) groups.
        out = np.empty(len(a) + len(b), object)
        place_a = np.arange(len(a)) + np.searchsorted(b, a)
        place_b = np.arange(len(b)) + np.searchsorted(a, b, "right")
        for place, group, ids, mark in ((place_a, a, self.a, ";"), (place_b, b, self.b, "|")):
            size = 1 << int(ids.max(initial=1)).bit_length()
            out[place] = np.where(np.append(True, group[1:] != group[:-1]), _ids(mark, size)[ids], _ids(",", size)[ids])
        return "".join(out)[1:]


@cache
def _ids(mark: str, size: int) -> np.ndarray:
    """Every id below ``size`` in decimal behind a mark."""
    return np.array([f"{mark}{k}" for k in range(size)], object)


class Aligner:
    """Tokenizes texts with a byte-level BPE (A) and a sentence-piece model (B) and aligns them.

    A's vocabulary file is run by ``tiktoken``, which gives the ids of ``tokenizers``; texts
    with characters whose class the two might see differently go to ``tokenizers`` itself.
    """

    def __init__(self, path_a: str, path_b: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path_a)
        self.tokenizer.encode_special_tokens = True
        names = self.tokenizer.get_vocab()
        # The file spells each byte as one character: printable ones as themselves, the
        # others, in order, as those from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        ranks = {bytes(map(byte_of.__getitem__, name)): k for name, k in names.items() if name not in special}
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for raw, k in ranks.items():
            self.a_bytes[k] = raw
        self.bpe = tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.model = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
        self.lengths_a, self.lengths_b = (np.array([len(x) for x in side]) for side in (self.a_bytes, self.b_bytes))

    def ids_a(self, text: str) -> list[int]:
        if _OTHER.search(text):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.bpe.encode_ordinary(text)

    def align(self, texts_: list[str]) -> Iterator[Alignment | None]:
        """For each text its alignment; None if it is empty or its tokens do not spell it."""
        for text, b in zip(texts_, self.model.encode(texts_, num_threads=1), strict=True):
            whole = " " + text
            raw, a = whole.encode(), self.ids_a(whole)
            if not text or b"".join([self.a_bytes[k] for k in a]) != raw or b"".join([self.b_bytes[k] for k in b]) != raw:
                yield None
                continue
            a, b = np.array(a, np.int64), np.array(b, np.int64)
            a_ends, b_ends = np.cumsum(self.lengths_a[a]), np.cumsum(self.lengths_b[b])
            yield Alignment(a, b, a_ends, b_ends, np.intersect1d(a_ends, b_ends, assume_unique=True))


LINKED = (
    "row_id long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_group_links long, "
    "groups_sha256 string, pairs array<long>, times array<int>"
)


def linked_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row for each document: its sizes, and its linked id pairs with how often it links them.

    A pair is the A id times 2**32 plus the B id. ``row_id`` tells rows apart.
    """

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        row_id = TaskContext.get().partitionId() << 33
        for batch in batches:
            for first in range(0, batch.num_rows, _DOCS_AT_ONCE):
                part = batch.slice(first, _DOCS_AT_ONCE)
                rows, pairs, times = [], [], []
                own = [text.decode("utf-8", "replace") for text in texts(part)]
                for doc_id, found in zip(part.column(0).to_pylist(), aligner.align(own), strict=True):
                    if found is None:
                        rows.append((row_id, doc_id, 0, 0, 0, 0, 0, ""))
                        pairs.append([])
                        times.append([])
                    else:
                        i, j, _ = found.overlap_links()
                        own, n = np.unique((found.a[i] << 32) + found.b[j], return_counts=True)
                        digest = hashlib.sha256(found.groups().encode()).hexdigest()
                        rows.append((row_id, doc_id, len(found.a), len(found.b), len(found.cuts), len(i), found.n_group_links(), digest))
                        pairs.append(own)
                        times.append(n.astype(np.int32))
                    row_id += 1
                plain = [pa.array(c, pa.string() if k == 7 else pa.int64()) for k, c in enumerate(zip(*rows, strict=True))]
                lists = [pa.array(pairs, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays([*plain, *lists], names=[f.split()[0] for f in LINKED.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(rows_of, LINKED)


def pair_counts(linked: DataFrame) -> DataFrame:
    """``pair, n, best``: in how many links each id pair stands, and whether none with its B id
    stands in more. Tasks add up what they hold before it is shuffled."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, size = [], [], 0

        def combined() -> tuple[np.ndarray, np.ndarray]:
            found, place = np.unique(np.concatenate(keys), return_inverse=True)
            return found, np.bincount(place, np.concatenate(counts), len(found)).astype(np.int64)

        for batch in batches:
            keys.append(batch.column(0).flatten().to_numpy())
            counts.append(batch.column(1).flatten().to_numpy().astype(np.int64))
            size += len(keys[-1])
            if size > _SUMMED_AT_ONCE:
                found, n = combined()
                if len(found) > _SUMMED_AT_ONCE // 2:  # little to add up
                    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], names=["pair", "n"])
                    found, n = found[:0], n[:0]
                keys, counts, size = [found], [n], len(found)
        if size:
            found, n = combined()
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], names=["pair", "n"])

    added = linked.select("pairs", "times").mapInArrow(sums, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    added = written(added.withColumn("b", F.col("pair").bitwiseAND((1 << 32) - 1)), "pair-counts")
    most = added.groupBy("b").agg(F.max("n").alias("most"))
    return added.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def hottest(counts: DataFrame, limit: int) -> DataFrame:
    """The most frequent pairs, at most ``limit``: all that stand in 2**k links or more, for the least k that fits."""
    power = F.floor(F.log2("n"))
    sizes = sorted(((r["power"], r["pairs"]) for r in counts.groupBy(power.alias("power")).agg(F.count("*").alias("pairs")).collect()), reverse=True)
    least, total = 63, 0
    for k, pairs in sizes:
        total += pairs
        if total > limit:
            break
        least = k
    return counts.where(power >= least)


def align(docs: DataFrame, path_a: str, path_b: str, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256, n_group_links``.

    Null and empty texts, and texts that the joined tokens of either side do not spell with a
    space before them, have no tokens: zeros, and an empty digest. Repeated rows are answered
    as often as they occur and count as often; a null id stays null. No rows give no rows.
    Other columns are not looked at.
    """
    linked = written(linked_documents(docs, path_a, path_b), "linked")
    counts = written(pair_counts(linked), "pair-bests")
    hot = hottest(counts, hot_pairs).orderBy("pair").toPandas()
    hot_pair, hot_n, hot_best = (hot[c].to_numpy() for c in ("pair", "n", "best"))

    def look_up(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places among the hot pairs, and which of ``pairs`` are hot."""
        if not len(hot_pair):
            return np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
        at = np.searchsorted(hot_pair, pairs)
        at[at == len(hot_pair)] = 0
        return at, hot_pair[at] == pairs

    def hot_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, times = (batch.column(k).flatten().to_numpy() for k in (1, 2))
            ends = np.append(0, np.cumsum(pa.compute.list_value_length(batch.column(1)).to_numpy()))
            at, known = look_up(pairs)
            times = np.where(known, times, 0).astype(np.int64)
            sums = []
            for value in (hot_best, hot_n):
                total = np.append(0, np.cumsum(times * value[at])) if len(value) else np.zeros(len(pairs) + 1, np.int64)
                sums.append(pa.array(total[ends[1:]] - total[ends[:-1]]))
            yield pa.RecordBatch.from_arrays([*batch.columns[3:], *sums], names=[*plain, "n_best", "count_sum"])

    def cold_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, times = (batch.column(k).flatten().to_numpy() for k in (1, 2))
            row = np.repeat(batch.column(0).to_numpy(), pa.compute.list_value_length(batch.column(1)).to_numpy())
            cold = ~look_up(pairs)[1]
            if cold.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[cold]) for x in (row, pairs, times)], names=["row_id", "pair", "times"])

    plain = ["row_id", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_group_links"]
    types = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c in plain)
    done = linked.select("row_id", "pairs", "times", *plain).mapInArrow(hot_sums, f"{types}, n_best long, count_sum long")
    rest = linked.select("row_id", "pairs", "times").mapInArrow(cold_pairs, "row_id long, pair long, times int")
    rest = (
        rest.join(counts, "pair")
        .groupBy("row_id")
        .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("cold_best"), F.sum(F.col("times") * F.col("n")).alias("cold_sum"))
    )
    none = F.lit(0).cast("long")
    return done.join(rest, "row_id", "left").select(
        *["doc_id", "n_a", "n_b", "n_groups", "n_links"],
        (F.col("n_best") + F.coalesce("cold_best", none)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("cold_sum", none)).alias("count_sum"),
        *["groups_sha256", "n_group_links"],
    )
