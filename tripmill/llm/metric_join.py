"""N-gram Jaccard join in the metric space of shingle sets.

The Jaccard distance is a metric, and so is the size of the symmetric difference. A pair that
links, at a similarity of p percent, differs in at most ``min(size) * (100 - p) // p`` shingles.

1. *Rings.* A set's size is its distance to the empty set. Rings of sizes around that pivot
   are joined one by one; a set within reach of the ring below is replicated into it.
2. *Slices.* Within a ring the shingles are dealt by hash to more slices than a pair may
   differ in, so by the triangle inequality a linked pair coincides in some slice. The
   contents found in a slice are its pivots, and the sets at distance 0 of a pivot are its
   region. Only regions of several sets go on, so most sets of a corpus end here.
3. *Families.* Regions that share sets form a family; families are joined on their own. One
   of more than ``FAMILY_SHINGLES`` is divided among document pivots: a set goes to its
   nearest pivot, its Voronoi region, and is replicated into each region whose pivot is at
   most twice the linking distance farther away. What is still too large is divided again,
   and a family too dense for pivots to divide is joined block by block, every pair of blocks.
4. *Leaves.* One family or region in memory: sets near a pivot are linked to it; others meet
   by their rarest shingles, within the windows that the distances to the pivots leave, and
   their shingles are compared.

Every link between different texts is found, but only links that join what was apart are
written, so a large family never becomes its pairs. A shingle is a 64-bit hash, as in the
other operators; sets are told apart by 128 bits of their shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import texts, written
from tripmill.llm.components import components

SHINGLE = 3
PERCENT = 90
FAMILY_SHINGLES = 2_000_000
PIVOTS = 8
SLACK = 2  # slices beyond those needed, as some may be empty
_GROWTH = 1.5  # of the sizes of rings
_BITS = 1 << 23
_WORD_BITS = 1 << 15  # of one bitmap of Spark's


def shingle_set(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct shingles of a text as sorted hashes; fewer words are one shingle, none no shingle."""
    words = text.lower().split()  # bytes: A-Z alone, and ASCII white space alone
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    if len(words) > shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[i:j]) for i, j in zip(starts.tolist(), ends.tolist(), strict=True)], np.uint64))


def may_differ(size: int, percent: int) -> int:
    """In how many shingles a set of ``size`` may differ from a linked one that is no smaller."""
    return size * (100 - percent) // percent


def rings(size: int, percent: int) -> Iterator[tuple[int, int]]:
    """``ring, slices`` of each ring that a set of ``size`` lies in or can reach down to."""
    ring, low = 0, 1
    while low <= size:
        high = int(low * _GROWTH) + 1
        reach = may_differ(high - 1, percent)
        if 100 * (high - 1) >= percent * size and reach:
            yield ring, reach + 1 + SLACK
        ring, low = ring + 1, high


def regions_of(found: np.ndarray, percent: int) -> np.ndarray:
    """Numbers of the slice regions that a set lies in.

    In a ring of m slices where pairs differ in at most r shingles, sets that fill more than r
    slices coincide with their partners in a filled one. Sets that fill fewer can only have
    partners that do the same, and take their empty slices as regions as well.
    """
    out = []
    for ring, slices in rings(len(found), percent):
        at = ((found >> np.uint64(32)) * np.uint64(slices)) >> np.uint64(32)
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        content, place = np.add.reduceat(found, first), at[first]
        if len(place) < slices - SLACK:
            empty = np.setdiff1d(np.arange(slices, dtype=np.uint64), place)
            content, place = np.append(content, np.zeros(len(empty), np.uint64)), np.append(place, empty)
        mixed = (content ^ (content >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + place + np.uint64(ring << 40)
        out.append((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def described(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``doc_id, key, n, high, low, regions`` of every row: a hash of id and text, the size of its
    set, 128 bits of the set, and its slice regions."""

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, regions, ends = [], [], [], [0]
            for text in texts(batch):
                found = shingle_set(text, shingle)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                regions.append(regions_of(found, percent))
                ends.append(ends[-1] + len(regions[-1]))
            if sizes:
                high, low = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2).T
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(regions).view(np.int64)))
                columns = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(high), pa.array(low), lists]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "n", "high", "low", "regions"])

    return _keyed(docs).mapInArrow(rows_of, "doc_id long, key long, n long, high long, low long, regions array<long>")


def _keyed(docs: DataFrame) -> DataFrame:
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    return docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, F.coalesce(text, F.lit(""))).alias("key"), text.alias("text"))


def _bitmap(keys: DataFrame) -> np.ndarray:
    """Which values modulo ``_BITS`` the keys have: one bitmap of that size, whatever their number."""
    bit = F.pmod("key", F.lit(_BITS))
    words = keys.groupBy((bit / _WORD_BITS).cast("int").alias("word")).agg(F.bitmap_construct_agg(bit % _WORD_BITS).alias("bits")).collect()
    out = np.zeros(_BITS, bool)
    for word, bits in words:
        out[word * _WORD_BITS : (word + 1) * _WORD_BITS] = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")
    return out


def sets_of(docs: DataFrame, members: DataFrame, shingle: int) -> DataFrame:
    """``family, node, set`` of the ``members(key, high, low, family, node)``.

    Sets are made again from the texts. A bitmap of fixed size tells most rows without a
    member before they are; the join tells the others.
    """
    wanted = _bitmap(members)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.filter(pa.array(wanted[batch.column(1).to_numpy() % _BITS]))
            if not part.num_rows:
                continue
            found = [shingle_set(t, shingle).tobytes() for t in texts(part)]
            high, low = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, found)), np.int64).reshape(-1, 2).T
            columns = [part.column(1), pa.array(high), pa.array(low), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "high", "low", "set"])

    made = _keyed(docs).mapInArrow(rows_of, "key long, high long, low long, set binary")
    return made.join(members, ["key", "high", "low"]).select("family", "node", "set").dropDuplicates(["node"])


def overlaps(found: np.ndarray, ends: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets that lie behind one another with another set."""
    at = np.searchsorted(other, found)
    at[at == len(other)] = 0
    met = np.append(0, np.cumsum(other[at] == found)) if len(other) else np.zeros(len(found) + 1, np.int64)
    return met[ends[1:]] - met[ends[:-1]]


def leaf_links(sets: list[np.ndarray], percent: int, pivots: int = PIVOTS) -> list[tuple[int, int]]:
    """Links that join all sets of at least ``percent`` similarity, by their places."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    ends, found = np.append(0, np.cumsum(sizes)), np.concatenate(sets)
    group, links = np.arange(n), []

    def join(i: int, near: np.ndarray) -> None:
        for j in near.tolist():
            if group[i] != group[j]:
                links.append((i, j))
                group[group == group[j]] = group[i]

    distances, free = [], np.ones(n, bool)
    for _ in range(min(pivots, n)):  # what lies near a pivot is linked to it
        pivot = int(np.argmax(free))
        same = overlaps(found, ends, sets[pivot])
        either = sizes + sizes[pivot] - same
        near = np.flatnonzero(100 * same >= percent * either)
        distances.append(1 - same / np.maximum(either, 1))
        join(pivot, near)
        left = free.sum()
        free[near] = False
        free[pivot] = False
        if 8 * (left - free.sum()) < left or not free.any():
            break
    if (group == group[0]).all():
        return links
    distance, reach = np.array(distances).T, 1 - percent / 100 + 1e-9
    _, local, times = np.unique(found, return_inverse=True, return_counts=True)
    # The rarest shingles of each set, one more than it may lack in a partner, by their ranks.
    rank = np.empty(len(times), np.int64)
    rank[np.lexsort((np.arange(len(times)), times))] = np.arange(len(times))
    ranked = rank[local]
    inside = np.repeat(np.arange(n), sizes)
    ranked = ranked[np.lexsort((ranked, inside))]
    lacking = sizes + (-percent * sizes // 100) + 1
    within = np.arange(len(ranked)) - np.repeat(ends[:-1], sizes) < np.repeat(lacking, sizes)
    sharing = within & (np.sort(times)[ranked] > 1)
    key, owner = ranked[sharing], inside[sharing]
    order = np.argsort(key, kind="stable")
    by_key, owners = key[order], owner[order]
    low, high = np.searchsorted(by_key, key), np.searchsorted(by_key, key, "right")
    rows = np.searchsorted(owner, np.arange(n + 1))
    mark = np.zeros(len(times), bool)
    for i in range(n):
        runs = [owners[low[k] : high[k]] for k in range(rows[i], rows[i + 1])]
        if not runs:
            continue
        near = np.unique(np.concatenate(runs))
        near = near[(near < i) & (group[near] != group[i])]
        near = near[100 * np.minimum(sizes[near], sizes[i]) >= percent * np.maximum(sizes[near], sizes[i])]
        near = near[(np.abs(distance[near] - distance[i]) <= reach).all(1)]
        if not len(near):
            continue
        mark[local[ends[i] : ends[i + 1]]] = True
        same = np.array([mark[local[ends[j] : ends[j + 1]]].sum() for j in near.tolist()])
        mark[local[ends[i] : ends[i + 1]]] = False
        join(i, near[100 * same >= percent * (sizes[near] + sizes[i] - same)])
    return links


def _edges(links: list[tuple[int, int]], nodes: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([nodes[x[k]] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])


def leaf_edges(rows: DataFrame, percent: int) -> DataFrame:
    """``a, b``: links within each family of ``rows(family, node, set)``."""

    def edges_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, nodes, sets = None, [], []
        for batch in batches:
            for here, node, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if here != family:
                    if links := len(sets) > 1 and leaf_links(sets, percent):
                        yield _edges(links, nodes)
                    family, nodes, sets = here, [], []
                nodes.append(node)
                sets.append(np.frombuffer(raw, np.uint64))
        if links := len(sets) > 1 and leaf_links(sets, percent):
            yield _edges(links, nodes)

    sorted_ = rows.select("family", "node", "set").repartition("family").sortWithinPartitions("family", "node")
    return sorted_.mapInArrow(edges_of, "a long, b long")


def divided(rows: DataFrame, percent: int, pivots: int, level: int) -> DataFrame:
    """Large families divided among document pivots, and the links to the pivots.

    ``kind`` 0: ``family, node, set`` of a Voronoi region, with its old family as ``of``. Linked
    sets x, y with homes i, j differ by at most the linking distance in their distances to
    either pivot, so d(y, i) <= d(x, i) + e <= d(x, j) + e <= d(y, j) + 2 e: y reaches the region
    of x. ``kind`` 1: ``node`` is linked to ``family``, a pivot's node.
    """
    reach = 2 * (1 - percent / 100) + 1e-9
    firsts = [F.min(F.struct(F.xxhash64("node", F.lit(level * pivots + k)).alias("h"), "node", "set")).alias(f"p{k}") for k in range(pivots)]
    chosen = rows.groupBy("family").agg(*firsts).select("family", F.array(*[F.struct(f"p{k}.node", f"p{k}.set") for k in range(pivots)]).alias("pivots"))

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, []
        for batch in batches:
            out: list[tuple] = []
            for family, node, raw, around in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if family != last:
                    last, own = family, {p["node"]: np.frombuffer(p["set"], np.uint64) for p in around}
                here = np.frombuffer(raw, np.uint64)
                same = np.array([len(np.intersect1d(here, p, assume_unique=True)) for p in own.values()])
                either = np.array([len(p) for p in own.values()]) + len(here) - same
                distance = 1 - same / either
                for pivot, s, e, d in zip(own, same, either, distance, strict=True):
                    if 100 * s >= percent * e and pivot != node:
                        out.append((1, pivot, None, node, None))
                    if d <= distance.min() + reach:
                        out.append((0, pivot, family, node, raw))
            if out:
                types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["kind", "family", "of", "node", "set"])

    near = rows.join(chosen, "family").select("family", "node", "set", "pivots")
    return near.mapInArrow(rows_of, "kind int, family long, of long, node long, set binary")


def in_blocks(rows: DataFrame, sizes: DataFrame, limit: int) -> DataFrame:
    """Each pair of blocks of a family as a family of its own; a block has about half of ``limit``."""
    blocks = F.ceil(2 * F.col("shingles") / F.lit(limit)).cast("int")
    cut = rows.join(sizes.select("family", blocks.alias("blocks")), "family")
    own = cut.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = own.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    cell = F.xxhash64("family", F.least("own", "other"), F.greatest("own", "other"))
    return other.select(cell.alias("family"), "node", "set")


def family_edges(rows: DataFrame, percent: int, limit: int, pivots: int) -> DataFrame:
    """``a, b``: links within the families of ``rows(family, node, set)``, however large."""
    edges = None
    level, largest = 0, None
    while True:
        rows = written(rows, "families")
        shingles = F.sum(F.octet_length("set") / 8).cast("long").alias("shingles")
        sizes = written(rows.groupBy("family").agg(shingles).where(F.col("shingles") > limit), "large-families")
        found = leaf_edges(rows.join(sizes, "family", "left_anti"), percent)
        edges = found if edges is None else edges.unionByName(found)
        before, largest = largest, sizes.agg(F.max("shingles")).first()[0]
        if largest is None:
            return edges
        large = rows.join(sizes.select("family"), "family", "left_semi")
        if before is not None and 5 * largest > 4 * before:  # pivots no longer divide
            return edges.unionByName(leaf_edges(in_blocks(large, sizes, limit), percent))
        parts = written(divided(large, percent, pivots, level), "regions")
        edges = edges.unionByName(parts.where("kind = 1").select(F.col("family").alias("a"), F.col("node").alias("b")))
        named = F.xxhash64("of", "family").alias("family")
        rows = parts.where("kind = 0").select(named, "node", "set")
        level += 1


def join(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, limit: int = FAMILY_SHINGLES, pivots: int = PIVOTS) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, set_id, component_id``.

    Rows link when their sets have ``percent`` of their union in common, rows of equal sets
    among them, and ``component_id`` is the smallest id reachable over links, the row's own
    included. Null and empty texts and those without words have no set (a null ``set_id``) and
    link with nothing. Null ids count for nothing in ``component_id``, which is null where no
    linked row has one. Repeated rows are answered as often as they occur; rows that share an
    id but not a text are apart. No rows give no rows. Other columns are not looked at.
    """
    if not 1 <= percent <= 100:
        raise ValueError("percent must lie between 1 and 100")
    rows = written(described(docs, shingle, percent), "sets")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key"))
    nodes = rows.where("n > 0").groupBy("high", "low").agg(first.alias("first"), F.any_value("regions").alias("regions"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    lying = nodes.select("node", F.explode("regions").alias("region"))
    shared = lying.groupBy("region").agg(F.min("node").alias("b"), F.max("node").alias("last")).where("b < last").select("region", "b")
    meeting = lying.join(shared, "region").where("node > b").select(F.col("node").alias("a"), "b").distinct()
    families = written(components(meeting), "families")
    members = nodes.join(families, "node").select(F.col("first.key").alias("key"), "high", "low", F.col("root").alias("family"), "node")
    members = written(members, "members")
    edges = family_edges(sets_of(docs, members, shingle), percent, limit, pivots)
    linked = nodes.select("node", "high", "low", F.col("first.doc_id").alias("least"))
    linked = linked.join(components(edges), "node", "left").select("high", "low", "node", "least", F.coalesce("root", "node").alias("root"))
    linked = written(linked, "linked")
    named = linked.join(linked.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    named = named.select("high", "low", F.col("node").alias("set_id"), "component_id")
    alone = F.col("n") == 0
    return rows.join(named, ["high", "low"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), "set_id", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )
