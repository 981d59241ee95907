"""Best-fit decreasing packing of whole documents into token sequences of one length.

Best fit depends on a document's length alone, so the packing is planned on the counts of
the lengths: a segment tree over the remaining capacities finds the tightest open bin, and
all documents of one length that go to bins of one capacity are placed in one step. The plan
is the exact best-fit-decreasing packing of the whole corpus, yet holds at most a few entries
per pair of lengths, whatever the number of documents. Tasks then look up where the k-th
document of a length goes.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import texts, written

SEQUENCE = 1024
END_ID = 2
MEMO = 200_000

# Characters whose class (letter, digit, space, other) is plain; texts with others are not
# cut here but given to the tokenizer whole.
_LATIN = "À-ÖØ-öø-ɏ"
_OTHER = re.compile(f"[^\x00-\x1b\x20-\x7f{_LATIN}]|<\\|endoftext\\|>")
_L, _S = f"A-Za-z{_LATIN}", "\t-\r "
# The vocabulary's own pre-tokens, written for those characters.
_PIECE = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[0-9]+| ?[^{_S}{_L}0-9]+|[{_S}]+(?![^{_S}])|[{_S}]+"
)


class PieceIds(dict):
    """Ids of each pre-token, as little-endian unsigned 32-bit bytes; remembers up to ``MEMO``.

    The merges of the vocabulary file are run by ``tiktoken``, which is much quicker at single
    words than ``tokenizers`` and gives the same ids.
    """

    def __init__(self, tokenizer_path: str):
        import tiktoken

        # The file spells each byte as one character: printable ones as themselves, the
        # others, in order, as those from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
        with open(tokenizer_path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        ranks = {bytes(byte_of[c] for c in token): k for token, k in model["vocab"].items() if all(c in byte_of for c in token)}
        ranks = {token: k for token, k in ranks.items() if token != b"<|endoftext|>"}
        self.bpe = tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, piece: str) -> bytes:
        found = packed(self.bpe.encode_ordinary(piece))
        if len(self) < MEMO:
            self[piece] = found
        return found


def packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def id_bytes(tokenizer_path: str) -> Callable[[str], bytes]:
    """A function from a text to its ids as little-endian unsigned 32-bit bytes.

    The vocabulary's merges never cross pre-tokens, so a text of plain characters is cut into
    them here, and each distinct one is encoded once. Other texts go to the tokenizer whole.
    """
    from tokenizers import Tokenizer

    pieces = PieceIds(tokenizer_path)
    tokenizer = cache(lambda: Tokenizer.from_file(tokenizer_path))

    def encode(text: str) -> bytes:
        if _OTHER.search(text):
            return packed(tokenizer().encode(text, add_special_tokens=False).ids)
        return b"".join(map(pieces.__getitem__, _PIECE.findall(text)))

    return encode


def token_pieces(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, keep_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of each document's pieces.

    A document is its ids and the end id; null text has the end id alone. Documents over
    ``sequence`` ids are cut into pieces of that length, the first taking what is left over.
    ``keep_ids`` adds the ids themselves, as an array. Repeated rows give their pieces as often
    as they occur, a null id stays null, and no rows give no rows.
    """
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + ([("ids", pa.list_(pa.int64()))] if keep_ids else []))
    end = np.asarray([END_ID], "<u4").tobytes()

    def pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = id_bytes(tokenizer_path)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                rows: list[tuple] = []
                for doc_id, text in zip(part.column(0).to_pylist(), texts(part), strict=True):
                    ids = encode(text.decode("utf-8", "replace")) + end
                    n = len(ids) // 4
                    cuts = [0, *range(n % sequence or sequence, n + 1, sequence)]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        own = ids[4 * a : 4 * b]
                        rows.append((doc_id, k, a, b - a, zlib.crc32(own), *([np.frombuffer(own, "<u4").tolist()] if keep_ids else [])))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    out = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<long>" if keep_ids else "")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(pieces_of, out)


class OpenBins:
    """Open bins by remaining capacity: a segment tree over the capacities."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.tree = [False] * (2 * self.size)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # (first bin, number)

    def tightest(self, length: int) -> int | None:
        """The least capacity of at least ``length`` that an open bin has."""
        node = length + self.size
        if self.tree[node]:
            return length
        while node > 1:  # up to the first right neighbour with an open bin, then down to its least
            if node % 2 == 0 and self.tree[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.tree[2 * node] else 2 * node + 1
                return node - self.size
            node //= 2
        return None

    def _mark(self, capacity: int) -> None:
        node = capacity + self.size
        self.tree[node] = bool(self.runs[capacity])
        while node > 1:
            node //= 2
            self.tree[node] = self.tree[2 * node] or self.tree[2 * node + 1]

    def add(self, capacity: int, first: int, number: int) -> None:
        if capacity and number:
            self.runs[capacity].append((first, number))
            self._mark(capacity)

    def take(self, capacity: int, most: int) -> tuple[int, int]:
        first, number = self.runs[capacity].pop()
        if number > most:
            self.runs[capacity].append((first + most, number - most))
            number = most
        self._mark(capacity)
        return first, number


def best_fit_plan(counts: dict[int, int], sequence: int = SEQUENCE) -> dict[int, np.ndarray]:
    """Per length the rows ``first rank, number, first bin, offset``, by rank.

    The k-th document of a length lies in the row with the last first rank up to k, in the
    bin as far from the row's first bin. Equal to placing the documents one by one, longest
    first, each into the fullest bin that takes it.
    """
    bins, opened = OpenBins(sequence), 0
    plan: dict[int, list[tuple[int, int, int, int]]] = {}
    for length in sorted(counts, reverse=True):
        rank, left, rows = 0, counts[length], plan.setdefault(length, [])
        while left:
            room = bins.tightest(length)
            fit = (room or sequence) // length  # a bin takes so many in a row, as it stays the tightest
            each, number = (fit, left // fit) if left >= fit else (left, 1)
            if room is None:
                room, first = sequence, opened
                opened += number
            else:
                first, number = bins.take(room, number)
            for k in range(each):
                rows.append((rank, number, first, sequence - room + k * length))
                rank += number
            left -= each * number
            bins.add(room - each * length, first, number)
    return {length: np.asarray(rows, np.int64) for length, rows in plan.items()}


def pack(pieces: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """Pieces of at most ``sequence`` ids with their ``sequence_id`` and ``offset``.

    Input columns of those names are replaced; the others, and repeated rows, all stay. Ties
    of length are broken arbitrarily, which never changes the number of sequences. Pieces of
    the full length are sequences of their own, numbered below zero. No rows give no rows.
    """
    spark = pieces.sparkSession
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    rows = written(pieces.select(*kept, F.monotonically_increasing_id().alias("__row")), "pieces")
    short = rows.where(F.col("length") < sequence)
    counts = {r["length"]: r["n"] for r in short.groupBy("length").agg(F.count("*").alias("n")).collect()}  # under 1024 rows
    plan = spark.sparkContext.broadcast(best_fit_plan(counts, sequence))

    # Ranks within a length, counted in parts, as one length may be that of most rows.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = short.withColumn("__part", F.pmod(F.xxhash64("__row"), F.lit(parts)))
    before = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy("length", "__part")
        .agg(F.count("*").alias("n"))
        .select("length", "__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    )
    inside = Window.partitionBy("length", "__part").orderBy("__row")
    ranked = (
        dealt.withColumn("__in", F.row_number().over(inside) - 1)
        .join(starts, ["length", "__part"])
        .select(*kept, (F.col("__before") + F.col("__in")).alias("__rank"))
    )
    out = ranked.select(*kept, F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "__rank"))
            sequences, offsets = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            for length in np.unique(lengths):
                here, table = lengths == length, plan.value[int(length)]
                at = np.searchsorted(table[:, 0], ranks[here], "right") - 1
                sequences[here] = table[at, 2] + ranks[here] - table[at, 0]
                offsets[here] = table[at, 3]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequences), pa.array(offsets)], names=out.names)

    full = rows.where(F.col("length") >= sequence).select(
        *kept, (-1 - F.col("__row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return ranked.mapInArrow(place, out).unionByName(full)


def pack_documents(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, keep_ids: bool = False) -> DataFrame:
    """All documents tokenized, cut and packed; see ``token_pieces`` and ``pack``."""
    return pack(token_pieces(docs, tokenizer_path, sequence, keep_ids), sequence)
