"""Suffix-array dedup: removes every byte of a string of ``length`` bytes seen before.

A whole corpus in one suffix array would shuffle a row per byte. But a string can only occur
twice if the least hash among its byte n-grams (its minimizer) does, and equal strings have
equal minimizers at equal places. So the suffixes are distributed by minimizer:

1. Each task hashes its texts' n-grams. Every run of strings with one minimizer is a block,
   and the minimizers go to the task that counts them.
2. Blocks whose minimizer occurs once anywhere are done with. The others, with their text,
   meet at their minimizer. Equal blocks are dealt with before that where a task holds both.
   Blocks of a minimizer with very many distinct ones, such as those at the edges of a line
   that a third of the documents share, are cut into their strings, which meet by themselves.
3. There the difference-cover algorithm sorts the suffixes of the distinct blocks; neighbours
   that agree in ``length`` bytes are occurrences of one string, of which the first stays.
4. Each document gathers the starts of its repeated strings and drops the bytes they cover.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import named, texts
from tripmill.llm.suffix_array import equal_prefix_groups

LENGTH = 100
ADDED = ("n_bytes", "n_removed", "n_spans", "kept")
NO_ID = -(1 << 63)
_STRETCH = 1 << 19  # windows handled at once, under 2**20
_TOGETHER = 2_000_000  # minimizers or blocks' bytes that a task looks at together
_SUFFIXES = 200_000  # bytes of a suffix array, or up to four times that for one minimizer
_STRINGS = 16_000_000  # bytes of strings, cut from blocks, that a task looks at together
CROWD_BITS = 1 << 25  # at most 524,288 rows of 64 bits, whatever the number of crowded minimizers
_DIGEST = 16  # bytes that stand for a longer string
_ODD = 0x9E3779B97F4A7C15
_LOW = np.uint64((1 << 20) - 1)
APART, ALONE, SHARED = -1, 0, 1  # or more than SHARED: so many distinct blocks


def _crowd(length: int) -> int:
    """Distinct blocks of one minimizer that fit a suffix array; none has twice ``length`` bytes."""
    return max(1, 4 * _SUFFIXES // (2 * length))


class Minimizers:
    """Finds the blocks of a text: maximal runs of strings with one minimizer."""

    def __init__(self, length: int):
        self.length, self.gram = length, max(1, length // 3)
        size = _STRETCH + length
        self.powers, self.inverse = np.ones((2, size + 1), np.uint64)
        self.powers[1:] = np.cumprod(np.full(size, _ODD, np.uint64))
        self.inverse[1:] = np.cumprod(np.full(size, pow(_ODD, -1, 1 << 64), np.uint64))

    def _sums(self, text: np.ndarray) -> np.ndarray:
        """The running sum over the text that hashes of its pieces are taken from."""
        total = np.zeros(len(text) + 1, np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * self.powers[: len(text)], out=total[1:])
        return total

    def _hashes(self, text: np.ndarray, total: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each n-gram."""
        h = (total[self.gram :] - total[: -self.gram]) * self.inverse[: len(text) - self.gram + 1]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        return h

    def blocks(self, text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each stretch of the text the blocks' minimizers, first and last + 1 string."""
        for found, first, last, _ in self.hashed_blocks(text):
            yield found, first, last

    def hashed_blocks(self, text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """``blocks`` with a 64-bit hash of each block's bytes."""
        raw, wide = np.frombuffer(text, np.uint8), self.length - self.gram + 1
        for begin in range(0, max(0, len(raw) - self.length + 1), _STRETCH):
            piece = raw[begin : begin + _STRETCH + self.length - 1]
            total = self._sums(piece)
            h = self._hashes(piece, total)
            # The place in the low bits makes the leftmost of equal hashes the least.
            least = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
            step = 1
            while 2 * step <= wide:
                least = np.minimum(least[:-step], least[step:])
                step *= 2
            if step < wide:
                least = np.minimum(least[: step - wide], least[wide - step :])
            at = least & _LOW
            first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            last = np.append(first[1:], len(at))
            whole = (total[last + self.length - 1] - total[first]) * self.inverse[first]
            yield h[at[first]], first + begin, last + begin, whole


def _minimizer_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """``part, other, kind`` of documents' minimizers.

    One row of each minimizer goes to the part that counts it, with its document: of kind
    ALONE, or if it occurs several times in the documents looked at together, the number of
    its distinct blocks there, SHARED or more. The documents' other rows are of kind APART:
    they stay clear of the minimizer's part, and come by their document.
    """
    finder = Minimizers(length)
    prints: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    hashes: list[np.ndarray] = []
    size = 0

    def rows() -> pa.RecordBatch:
        m, doc, whole = np.concatenate(prints), np.concatenate(owners), np.concatenate(hashes)
        order = np.argsort(m, kind="stable")
        m, doc, whole = m[order], doc[order], whole[order]
        first = np.append(True, m[1:] != m[:-1])
        again = ~first | np.append(~first[1:], False)
        blocks = np.zeros(len(m), np.int64)  # at the first row of each repeated minimizer
        if again.any():
            own, block, begins = m[again], whole[again], np.flatnonzero(first[again])
            by = np.lexsort((block, own))  # minimizers stay where they are, their blocks are sorted
            block = block[by]
            differs = first[again] | np.append(True, block[1:] != block[:-1])
            blocks[first & again] = np.add.reduceat(differs.astype(np.int64), begins)
        new = first | (np.append(True, doc[1:] != doc[:-1]))  # one row a minimizer and document
        m, doc, first, again = m[new].view(np.int64), doc[new], first[new], again[new]
        kind = np.where(first, np.where(again, blocks[new], ALONE), APART)
        columns = [np.where(first, m, doc), np.where(first, doc, m), kind]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["part", "other", "kind"])

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
            for found, _, _, whole in finder.hashed_blocks(text):
                prints.append(found)
                hashes.append(whole)
                owners.append(np.full(len(found), doc, np.int64))
                size += len(found)
        if size > _TOGETHER:
            yield rows()
            prints, owners, hashes, size = [], [], [], 0
    if size:
        yield rows()


def _repeated_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc, minimizer`` of the minimizers that repeat, from rows sorted by part."""
    held: tuple | None = None  # the last row so far, which the next one may repeat

    def out(part: np.ndarray, other: np.ndarray, kind: np.ndarray, repeats: np.ndarray) -> pa.RecordBatch:
        apart = kind[repeats] == APART
        part, other = part[repeats], other[repeats]
        pair = [np.where(apart, part, other), np.where(apart, other, part)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in pair], names=["doc", "minimizer"])

    for batch in batches:
        if not batch.num_rows:
            continue
        part, other, kind = (batch.column(k).to_numpy() for k in range(3))
        if held is not None:
            part, other, kind = (np.append(a, b) for a, b in zip(held, (part, other, kind), strict=True))
        same = part[1:] == part[:-1]
        repeats = (kind != ALONE) | np.append(False, same) | np.append(same, False)
        held = (part[-1:], other[-1:], np.where(repeats[-1:] & (kind[-1:] == ALONE), SHARED, kind[-1:]))
        yield out(part[:-1], other[:-1], kind[:-1], repeats[:-1])
    if held is not None:
        yield out(*held, held[2] != ALONE)


def _crowded_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """``minimizer`` of those with more distinct blocks than a suffix array takes, from rows
    sorted by part. Blocks that tasks have in common count once for each of them."""
    most = _crowd(length)
    last, total = np.zeros(0, np.int64), 0  # the part not complete yet

    for batch in batches:
        part, kind = batch.column(0).to_numpy(), batch.column(2).to_numpy()
        part, kind = part[kind != APART], kind[kind != APART]
        if not len(part):
            continue
        blocks = np.append(total, np.maximum(kind, 1)) if len(last) else np.maximum(kind, 1)
        part = np.append(last, part)
        begins = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        sums = np.add.reduceat(blocks, begins)
        last, total = part[-1:], sums[-1]
        yield pa.RecordBatch.from_arrays([pa.array(part[begins[:-1]][sums[:-1] > most])], names=["minimizer"])
    if total > most:
        yield pa.RecordBatch.from_arrays([pa.array(last)], names=["minimizer"])


_BLOCK = pa.schema(
    [("part", pa.int64()), ("block", pa.binary()), ("id", pa.int64()), ("tie", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())]
)
_SPAN = pa.schema([("id", pa.int64()), ("tie", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])


def _as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _block_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The blocks whose minimizer repeats; those of crowded minimizers as one block a string,
    which meet by a hash of the string, with a digest in place of a string that is longer.

    Of equal blocks looked at together only the first goes on; the others come without text,
    as repeated from start to stop.
    """
    finder = Minimizers(length)
    first: dict[tuple[int, bytes], tuple[int, int, int, int]] = {}
    out: list[tuple] = []
    size = cut = 0

    def add(key: tuple[int, bytes], place: tuple[int, int, int, int]) -> bool:
        before = first.setdefault(key, place)
        if before is not place and before != place:
            first[key] = min(before, place)
            out.append(max(before, place))
        return before is place

    def rows() -> Iterator[pa.RecordBatch]:
        every: list[tuple] = [(m, block, *place) for (m, block), place in first.items()]
        out.sort()
        for id_, tie, start, stop in out:  # neighbouring spans of a document become one
            last = every[-1] if every else (0, b"")
            if last[1] is None and last[2:4] == (id_, tie) and last[5] == start:
                every[-1] = (*last[:5], stop)
            else:
                every.append((hash((id_, tie)), None, id_, tie, start, stop))
        for k in range(0, len(every), 20_000):
            yield _as_batch(every[k : k + 20_000], _BLOCK)

    for batch in batches:
        id_, tie, wanted, crowds = (batch.column(k) for k in (1, 2, 4, 5))  # then the row, not needed here
        for k, text in enumerate(texts(batch.select(["text"]))):
            repeated = np.asarray(wanted[k].as_py(), np.int64).view(np.uint64)
            crowded = set(crowds[k].as_py())
            own = (id_[k].as_py(), tie[k].as_py())
            for found, starts, stops in finder.blocks(text):
                hit = np.isin(found, repeated)
                for m, a, b in zip(found[hit].view(np.int64).tolist(), starts[hit].tolist(), stops[hit].tolist(), strict=True):
                    if m not in crowded:
                        if add((m, text[a : b + length - 1]), (*own, a, b)):
                            size += b - a + length
                        continue
                    for at in range(a, b):
                        string = text[at : at + length]
                        digest = blake2b(string, digest_size=_DIGEST).digest()
                        part = int.from_bytes(digest[:8], "little", signed=True)
                        cut += length * add((part, digest if length > _DIGEST else string), (*own, at, at + 1))
            if size > 4 * _TOGETHER or cut > _STRINGS or len(out) > _TOGETHER // 20:
                yield from rows()
                first, out, size, cut = {}, [], 0, 0
    yield from rows()


def _repeated_spans(blocks: list[tuple[tuple, bytes]], length: int) -> list[tuple]:
    """Repeated strings of distinct blocks, given as ``(place, text)`` in the places' order.

    The first occurrence of a string is the one in the first block that holds it.
    """
    sizes = np.array([len(text) for _, text in blocks], np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    joined = np.zeros(int((sizes + 1).sum()), np.int64)  # 0 ends a block
    whole = np.ones(len(joined), bool)
    whole[begins + sizes] = False
    joined[whole] = np.frombuffer(b"".join([text for _, text in blocks]), np.uint8).astype(np.int64) + 1
    edges = np.zeros(len(joined) + 1, np.int64)
    edges[begins] += 1
    edges[begins + sizes - length + 1] -= 1
    order, group = equal_prefix_groups(joined, np.cumsum(edges[:-1]) > 0, length)
    first = np.minimum.reduceat(order, np.flatnonzero(np.append(True, group[1:] != group[:-1])))
    again = np.sort(order[order != first[group]])
    if not len(again):
        return []
    owner = np.searchsorted(begins, again, "right") - 1
    cut = np.append(True, (again[1:] != again[:-1] + 1) | (owner[1:] != owner[:-1]))
    ends = np.append(np.flatnonzero(cut)[1:], len(again)) - 1
    spans = []
    for a, b, k in zip(again[cut].tolist(), again[ends].tolist(), owner[cut].tolist(), strict=True):
        (id_, tie, start, _), _ = blocks[k]
        spans.append((id_, tie, start + a - int(begins[k]), start + b + 1 - int(begins[k])))
    return spans


def _span_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Starts of repeated strings, as spans by document, from blocks sorted by minimizer."""
    spans: list[tuple] = []
    waiting: list[tuple[tuple, bytes]] = []  # distinct blocks of whole minimizers
    size = 0
    current: int | None = None
    first: dict[bytes, tuple] = {}

    def close() -> None:
        """The minimizer is complete: one distinct block alone holds no string twice."""
        nonlocal size
        blocks = [(place, block) for block, place in first.items() if len(block) >= length]  # no digests
        if len(blocks) > 1:
            waiting.extend(blocks)
            size += sum(len(block) + 1 for _, block in blocks)
        first.clear()

    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in range(6)]
        for m, block, *place in zip(*columns, strict=True):
            place = tuple(place)
            if block is None:
                spans.append(place)
                continue
            if m != current:
                close()
                current = m
                if size > _SUFFIXES:
                    spans += _repeated_spans(sorted(waiting, key=itemgetter(0)), length)
                    waiting, size = [], 0
            before = first.setdefault(block, place)
            if before != place:
                first[block] = min(before, place)
                spans.append(max(before, place))
        if len(spans) > 50_000:
            yield _as_batch(spans, _SPAN)
            spans = []
    close()
    if waiting:
        spans += _repeated_spans(sorted(waiting, key=itemgetter(0)), length)
    yield _as_batch(spans, _SPAN)


def _cover(starts: list, stops: list, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes covered by strings that start in ``[start, stop)``."""
    begin, end = np.asarray(starts, np.int64), np.asarray(stops, np.int64) + length - 1
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.append(True, begin[1:] > end[:-1])
    return begin[new], np.append(end[np.flatnonzero(new)[1:] - 1], end[-1])


def _cut_rows(docs: DataFrame, length: int, as_text: bool) -> DataFrame:
    """``row, n_bytes, n_removed, n_spans, kept`` of every row of ``docs``; ``row`` holds whether
    the text was null (``none``) and the other columns as they came (``own``)."""
    columns = [named(c) for c in docs.columns if c != "text"]
    raw = F.coalesce(docs["text"].cast("binary"), F.lit(b""))
    keyed = docs.select(
        F.struct(docs["text"].isNull().alias("none"), F.struct(*columns).alias("own")).alias("row"),
        F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID).cast("long")).alias("id"),
        F.xxhash64(raw).alias("tie"),
        raw.alias("text"),
    ).withColumn("doc", F.xxhash64("id", "tie"))
    minimizers = (
        keyed.select("doc", "text")
        .where(F.octet_length("text") >= length)
        .mapInArrow(lambda b: _minimizer_rows(b, length), "part long, other long, kind long")
        .repartition("part")
        .sortWithinPartitions("part")
    )
    # Both read one exchange. Crowded minimizers are marked in a bitmap of fixed size, which is all
    # that is broadcast. One that shares its bit with a crowded one counts as crowded everywhere.
    bit = F.pmod("minimizer", F.lit(CROWD_BITS))
    crowded = minimizers.mapInArrow(lambda b: _crowded_rows(b, length), "minimizer long").select(bit.alias("bit"))
    crowded = crowded.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, int(bit & 63)))").alias("bits"))
    marked = F.when(F.expr("shiftright(bits, int(bit & 63)) & 1 = 1"), F.col("minimizer"))
    repeated = (
        minimizers.mapInArrow(_repeated_rows, "doc long, minimizer long")
        .withColumn("bit", bit)
        .join(F.broadcast(crowded), F.shiftright("bit", 6) == F.col("word"), "left")
        .groupBy("doc")
        .agg(F.collect_set("minimizer").alias("repeated"), F.collect_set(marked).alias("crowded"))
    )
    # One exchange of the texts serves both joins; so both must ask for the same columns of it.
    copies = Window.partitionBy("doc", "id", "tie").orderBy("doc")
    by_doc = keyed.select("doc", "id", "tie", "text", "row").repartition("doc").withColumn("copy", F.row_number().over(copies))
    blocks = (
        by_doc.join(repeated, "doc")
        .where("copy = 1")
        .select("doc", "id", "tie", "text", "repeated", "crowded", "row")
        .mapInArrow(lambda b: _block_rows(b, length), "part long, block binary, id long, tie long, start long, stop long")
        .repartition("part")
        .sortWithinPartitions("part")
    )
    spans = (
        blocks.mapInArrow(lambda b: _span_rows(b, length), "id long, tie long, start long, stop long")
        .groupBy(F.xxhash64("id", "tie").alias("doc"))
        .agg(F.collect_list(F.struct("id", "tie", "start", "stop")).alias("spans"))
    )
    joined = by_doc.join(spans, "doc", "left").select(
        "row", "id", "tie", "copy", "text", *[F.col(f"spans.{c}").alias(f"span_{c}") for c in ("id", "tie", "start", "stop")]
    )
    result = "string" if as_text else "binary"
    schema = joined.select("row", *[F.lit(0).cast("long").alias(c) for c in ADDED[:3]], F.lit(None).cast(result).alias("kept")).schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            lists = [batch.column(k).to_pylist() for k in (1, 2, 3, 5, 6, 7, 8)]
            for text, id_, tie, copy, ids, ties, starts, stops in zip(texts(batch), *lists, strict=True):
                # Two documents may share the hash that the spans came by.
                own = [(a, b) for i, t, a, b in zip(ids or (), ties or (), starts or (), stops or (), strict=True) if i == id_ and t == tie]
                if copy > 1 and len(text) >= length:
                    own = [(0, len(text) - length + 1)]
                begin, end = _cover(*zip(*own, strict=True), length) if own else (np.zeros(0, np.int64),) * 2
                pieces = [text[a:b] for a, b in zip([0, *end.tolist()], [*begin.tolist(), len(text)], strict=True)]
                left = b"".join(pieces)
                rows.append((len(text), int((end - begin).sum()), len(begin), left.decode("utf-8", "ignore") if as_text else left))
            own = zip(*rows, strict=True) if rows else [[]] * 4
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string() if as_text else pa.binary())
            arrays = [pa.array(c, t) for c, t in zip(own, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=schema.names)

    return joined.mapInArrow(cut, schema)


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` without the bytes that repeat, with ``n_bytes, n_removed, n_spans``.

    A byte is removed if a string of ``length`` bytes that covers it, within its document,
    also starts earlier: in a document with a smaller id, or before it in the same one.
    Strings are those of the input. A null id is the smallest, and among equal ids the text
    with the smaller hash comes first; of rows that repeat id and text, all but one lose
    whatever ``length`` bytes can cover. A null text is empty, and texts shorter than
    ``length`` stay whole. Every row is returned with its columns; input columns named like
    the added ones are replaced. No rows give no rows.

    In place of ``text`` comes ``kept``, the remaining bytes, last of all columns.
    """
    done = _cut_rows(docs, length, as_text=False)
    return done.select(*[named(c, "row.own") for c in docs.columns if c != "text" and c not in ADDED], *ADDED)


def report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row; see ``remove_repeats``."""
    return remove_repeats(docs.select("doc_id", "text"), length).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with what ``remove_repeats`` leaves as ``text``, and ``n_chars`` its length where
    there is one.

    The parts of characters that a cut may leave go too; a null text stays null. Every row is
    returned, a text that repeats as a whole as an empty one, and other columns stay as they
    are, whatever their names. No rows give no rows.
    """
    done = _cut_rows(docs, length, as_text=True)
    text = F.when(~F.col("row.none"), F.col("kept"))
    new = {"text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return done.select(*[new[c].alias(c) if c in new else named(c, "row.own") for c in docs.columns])
