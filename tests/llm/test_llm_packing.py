from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.conftest import SMALL
from tests.llm.cases import corpus, documents
from tripmill.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text: str | None) -> list[int]:
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]


def test_ids_are_the_tokenizers(tokenizer, spark):
    draw, encode = random.Random(4), packing.id_bytes(PATH)
    odd = ["a'll  b\t\n x", "  ", "x \n\n y ", "it's 'S 12ab² é", "<|endoftext|>a", "\x1c a", "a b", "İǅ z", "don't''ve", "", "\n", " é ü\x0b", "☃🎈  x"]
    odd += ["".join(draw.choice("ab é'\ts\n12.,! ×ßǅ") for _ in range(40)) for _ in range(500)]
    odd += [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect()]
    for text in odd:
        assert encode(text) == np.asarray(ids_of(tokenizer, text)[:-1], "<u4").tobytes(), text


def test_plan_equals_placing_one_by_one():
    draw = random.Random(6)
    for _ in range(150):
        size = draw.choice([8, 16, 64, 1024])
        lengths = [draw.randint(1, size - 1) for _ in range(draw.randint(0, 200))]
        rooms: list[int] = []
        for n in sorted(lengths, reverse=True):
            fits = [b for b, room in enumerate(rooms) if room >= n]
            if fits:
                rooms[min(fits, key=rooms.__getitem__)] -= n
            else:
                rooms.append(size - n)
        used = defaultdict(list)
        for n, rows in packing.best_fit_plan(Counter(lengths), size).items():
            for _, number, first, offset in rows:
                for k in range(number):
                    used[first + k].append((int(offset), n))
        assert sorted(size - sum(n for _, n in v) for v in used.values()) == sorted(rooms)
        for v in used.values():
            ends = 0
            for offset, n in sorted(v):
                assert offset == ends
                ends += n


def check(rows: list, texts: dict, tokenizer, sequence: int) -> None:
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(texts)
    for doc_id, text in texts.items():
        ids, at = ids_of(tokenizer, text), 0
        for k, r in enumerate(sorted(by_doc[doc_id], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at)
            assert k == 0 or r["length"] == sequence
            assert r["ids_crc32"] == zlib.crc32(np.asarray(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    for placed in by_sequence.values():
        ends = 0
        for r in sorted(placed, key=lambda r: r["offset"]):
            assert r["offset"] == ends
            ends += r["length"]
        assert ends <= sequence


@pytest.mark.parametrize("sequence", [16, 1024])
def test_round_trip(spark, tokenizer, sequence):
    rows = [r for r in corpus() if r[0] is not None]
    texts = dict((r[0], r[1]) for r in rows[:-3])  # each id once
    df = documents(spark, [r for r in rows[:-3]])
    check(packing.pack_documents(df, PATH, sequence).collect(), texts, tokenizer, sequence)


def test_repeated_rows_null_ids_and_extra_columns(spark):
    df = documents(spark).withColumns({"sequence_id": F.lit("x"), "offset": F.lit(0), "piece": F.lit(9)})
    out = packing.pack_documents(df, PATH)
    firsts = Counter(r["doc_id"] for r in out.where("piece = 0").collect())
    assert firsts == Counter(r[0] for r in corpus())
    spots = out.select("sequence_id", "offset").collect()
    assert len(spots) == len(set(spots))


def test_no_rows(spark):
    assert packing.pack_documents(documents(spark, []), PATH).collect() == []


def test_kept_ids(spark, tokenizer):
    df = documents(spark, [(1, "some words here", None, None, None)])
    assert packing.pack_documents(df, PATH, keep_ids=True).first()["ids"] == ids_of(tokenizer, "some words here")
