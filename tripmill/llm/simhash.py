"""SimHash near-dedup: fingerprints of word shingles, linked by searches in BK-trees.

Two 64-bit fingerprints that differ in at most two bits agree in two of their four 16-bit
quarters. So distinct fingerprints are sharded by each pair of quarters, and a shard's
fingerprints form a BK-tree: a node's children are keyed by their Hamming distance to it,
and a search follows only the edges within the radius of its own distance. What a shard
finds leaves it as one link per fingerprint, never as pairs.

The trees are built where their shard lies instead of being broadcast, as they grow with the
corpus. A shard of more than ``SHARD_ROWS`` fingerprints (a large family of near copies) is
linked in another exact way: fingerprints within two bits both lie within one bit of some
third number, and at most 65 distinct ones lie around any number.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import named, texts, written
from tripmill.llm.components import components

SHINGLE = 3
RADIUS = 2
SEED = 42
SHARD_ROWS = 4000
_AT_ONCE = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority bits of the XXH64 of all word shingles; 0 without words."""
    words = text.lower().split()  # bytes: A-Z alone, and ASCII white space alone
    joined = b" ".join(words)
    if not words:
        return 0
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for a in range(0, len(starts), _AT_ONCE):
        spans = zip(starts[a : a + _AT_ONCE].tolist(), ends[a : a + _AT_ONCE].tolist(), strict=True)
        hashes = np.array([digest(joined[i:j], SEED) for i, j in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(0, dtype=np.int64)
    set_bits = 2 * counts > len(starts)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, tie, fingerprint`` of every row; ``tie`` is a hash of the text."""

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, shingle) for t in texts(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints)], names=["doc_id", "tie", "fingerprint"])

    own = docs.select(F.col("doc_id").cast("long"), text_hash(F.col("text")).alias("tie"), F.col("text").cast("string"))
    return own.mapInArrow(rows_of, "doc_id long, tie long, fingerprint long")


class BKTree:
    """A BK-tree over distinct fingerprints, searched for many at a time."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        self.children: list[list[tuple[int, int]]] = [[] for _ in prints]  # (distance, node)
        waiting = [(0, np.arange(1, len(prints)))] if len(prints) else []
        while waiting:  # all that hang below a node, dealt to its children by distance
            node, below = waiting.pop()
            if not len(below):
                continue
            distance = np.bitwise_count(prints[below] ^ prints[node])
            for d in np.unique(distance):
                group = below[distance == d]
                self.children[node].append((int(d), int(group[0])))
                waiting.append((int(group[0]), group[1:]))

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """Each node that some queries lie within ``radius`` of, with their places."""
        waiting = [(0, np.arange(len(queries)))] if len(self.prints) else []
        while waiting:
            node, asking = waiting.pop()
            distance = np.bitwise_count(queries[asking] ^ self.prints[node]).astype(np.int64)
            near = asking[distance <= radius]
            if len(near):
                yield node, near
            for d, child in self.children[node]:
                follow = asking[np.abs(distance - d) <= radius]
                if len(follow):
                    waiting.append((child, follow))


def shard_links(prints: np.ndarray, radius: int) -> np.ndarray:
    """For each fingerprint of a shard the least one it is linked to there, step by step."""
    if len(prints) == 2:
        return np.full(2, prints.min()) if int(prints[0] ^ prints[1]).bit_count() <= radius else prints
    label = np.arange(len(prints))
    for node, near in BKTree(prints).search(prints, radius):
        found = np.unique(label[near])
        low = min(int(found[0]), int(label[node]))
        other = np.append(found, label[node])
        if (other != low).any():
            label[np.isin(label, other)] = low
    order = np.argsort(prints, kind="stable")
    least = np.full(len(prints), np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, label[order], prints[order])
    return least[label]


def _shard_edges(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links of the shards in a partition that is sorted by shard."""
    rest_key, rest = np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def edges(keys: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        sizes = np.diff(np.append(first, len(keys)))
        a, b = [], []
        for at, size in zip(first[sizes > 1], sizes[sizes > 1], strict=True):
            group = prints[at : at + size]
            least = shard_links(group, radius)
            a.append(group[least != group])
            b.append(least[least != group])
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], names=["a", "b"])

    for batch in batches:
        keys = np.concatenate([rest_key, batch.column(0).to_numpy()])
        prints = np.concatenate([rest, batch.column(1).to_numpy().view(np.uint64)])
        if not len(keys):
            continue
        cut = int(np.searchsorted(keys, keys[-1]))  # the last shard may go on
        if cut:
            yield from edges(keys[:cut], prints[:cut])
        rest_key, rest = keys[cut:], prints[cut:]
    if len(rest):
        yield from edges(rest_key, rest)


def link_edges(prints: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``a, b``: links that join all ``fingerprint`` values within ``radius`` bits of each other.

    Values must be distinct. The radius is at most 2, which both ways of linking rely on.
    """
    if not 0 <= radius <= 2:
        raise ValueError("radius must be 0, 1 or 2")
    quarters = [F.shiftrightunsigned("fingerprint", 16 * k).bitwiseAND(0xFFFF) for k in range(4)]
    keys = [
        F.lit(n << 32).cast("long").bitwiseOR(F.shiftleft(quarters[i], 16)).bitwiseOR(quarters[j])
        for n, (i, j) in enumerate(combinations(range(4), 2))
    ]
    keyed = prints.select("fingerprint", F.explode(F.array(*keys)).alias("shard")).select("shard", "fingerprint")
    crowded = keyed.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > shard_rows).select("shard")
    crowded = written(crowded, "crowded")
    usual = keyed.join(crowded, "shard", "left_anti").repartition("shard").sortWithinPartitions("shard")
    searched = usual.mapInArrow(lambda batches: _shard_edges(batches, radius), "a long, b long")
    if radius == 0 or crowded.isEmpty():
        return searched
    hot = keyed.join(crowded, "shard", "left_semi").select("fingerprint").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << k if k < 63 else -(1 << 63)).cast("long") for k in range(64)])
    around = hot.select("fingerprint", F.explode(flips).alias("flip")).select("fingerprint", F.col("fingerprint").bitwiseXOR(F.col("flip")).alias("z"))
    if radius == 1:  # only what lies at z itself is within one bit of what lies around z
        around = around.join(hot.select(F.col("fingerprint").alias("z")), "z", "left_semi")
        pairs = around.select(F.col("z").alias("a"), F.col("fingerprint").alias("b"))
    else:
        # At most 65 values a group.
        pairs = (
            around.groupBy("z")
            .agg(F.collect_list("fingerprint").alias("near"))
            .where(F.size("near") > 1)
            .select(F.array_min("near").alias("a"), F.explode("near").alias("b"))
        )
    return searched.unionByName(pairs.where("a <> b"))


def families(prints: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``fingerprint, family`` of each distinct fingerprint; a family is named by one of them."""
    distinct = prints.select("fingerprint").distinct()
    roots = components(link_edges(distinct, radius, shard_rows))
    return distinct.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("family")
    )


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``doc_id, tie, fingerprint, component_id, family`` of every row.

    ``component_id`` is the smallest id that the row reaches over links, its own included;
    null ids count for nothing there, and it is null where no row of the group has an id.
    ``family`` names the group itself: rows of one id may lie in several.
    A null text is empty; texts without words have fingerprint 0 and are linked like others.
    Repeated rows are returned as often as they occur. No rows give no rows.
    """
    return _in_families(written(fingerprints(docs, shingle), "fingerprints"), radius, shard_rows)


def _in_families(prints: DataFrame, radius: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """What ``near_duplicates`` returns, of ``fingerprints`` that are written."""
    least = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    family = families(prints, radius, shard_rows)
    linked = written(least.join(family, "fingerprint"), "families")
    named = linked.groupBy("family").agg(F.min("least").alias("component_id"))
    by_print = linked.join(named, "family").select("fingerprint", "component_id", "family")
    return prints.join(by_print, "fingerprint").select("doc_id", "tie", "fingerprint", "component_id", "family")


def hexadecimal(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the one with the smallest id.

    Null texts count as empty, and texts without words are one group. Rows without an id stay
    only where no row of their group has one. Of rows that share an id, or lack one, the text
    with the smaller hash stays, and one of equal rows. Unlike texts that share an id are
    groups of their own and all stay. Columns stay as they are, whatever their names. No rows
    give no rows.
    """
    prints = written(fingerprints(docs.select("doc_id", "text"), shingle), "fingerprints")
    found = _in_families(prints, radius)
    row = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), "tie")
    stay = found.groupBy("family").agg(F.min(row).alias("row")).select("row.*")
    own = F.col("doc_id").cast("long")
    keyed = docs.select(
        F.struct(*map(named, docs.columns)).alias("whole"),
        own.isNull().alias("none"),
        F.coalesce(own, F.lit(0)).alias("id"),
        text_hash(F.col("text")).alias("tie"),
    )
    kept = keyed.join(stay, ["none", "id", "tie"], "left_semi")
    repeated = prints.groupBy("doc_id", "tie").agg(F.count("*").alias("n")).where("n > 1")
    if not repeated.isEmpty():
        kept = kept.dropDuplicates(["none", "id", "tie"])
    return kept.select("whole.*")
