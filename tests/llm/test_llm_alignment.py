from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.decoders import ByteLevel

from tests.llm.cases import SCHEMA, corpus, documents
from tripmill.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_group_links"]
ODD = [" ", "a  ", "   a", " \n ", "<s> x</s>", "<|endoftext|> hi", "▁a", "\n", "ﬁ", "☃🎈 x", "<unk>", "é\tü", "\x00a", "日本語 テキスト"]


@pytest.fixture(scope="module")
def models():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def tokens(models, text: str) -> tuple[list, list] | None:
    """(id, bytes) of both sides; None where they do not spell the text."""
    a, b = models
    letters = {chr(c): c for c in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    for c in range(256):
        if c not in letters.values():
            letters[chr(256 + len([k for k in letters if ord(k) > 255]))] = c
    side_a = [(k, bytes(letters[x] for x in a.id_to_token(k))) for k in a.encode(" " + text, add_special_tokens=False).ids]
    side_b = []
    for k in b.encode(text):
        piece = b.id_to_piece(k)
        side_b.append((k, bytes([int(piece[3:5], 16)]) if b.is_byte(k) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (side_a, side_b) if all(b"".join(x for _, x in side) == whole for side in (side_a, side_b)) else None


def spans(side: list) -> list[tuple[int, int, int]]:
    out, at = [], 0
    for k, raw in side:
        out.append((k, at, at + len(raw)))
        at += len(raw)
    return out


def brute(models, rows: list[tuple]) -> list[tuple]:
    found = []
    for doc_id, text in rows:
        sides = tokens(models, text) if text else None
        if sides is None:
            found.append((doc_id, None))
            continue
        a, b = map(spans, sides)
        links = [(x, y) for x, s, e in a for y, t, u in b if s < u and t < e]
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups = [[[x for x, s, e in side if low < e <= high] for side in (a, b)] for low, high in zip([0, *cuts], cuts, strict=False)]
        found.append((doc_id, (len(a), len(b), groups, links)))
    counts = Counter(link for _, f in found if f for link in f[3])
    most: dict[int, int] = {}
    for (_, y), n in counts.items():
        most[y] = max(most.get(y, 0), n)
    out = []
    for doc_id, f in found:
        if f is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, "", 0))
            continue
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in f[2])
        best = sum(counts[link] == most[link[1]] for link in f[3])
        out.append(
            (doc_id, f[0], f[1], len(f[2]), len(f[3]), best, sum(counts[link] for link in f[3]),
             hashlib.sha256(text.encode()).hexdigest(), sum(len(x) * len(y) for x, y in f[2]))
        )
    return sorted(out, key=repr)


def result(df) -> list[tuple]:
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=repr)


def rows() -> list[tuple]:
    draw = random.Random(2)
    more = [*ODD, *("".join(draw.choice("ab é'\ts\n12.,!  ionthe") for _ in range(60)) for _ in range(60))]
    return [*corpus(), *((1000 + k, t, None, None, 0) for k, t in enumerate(more))]


@pytest.mark.parametrize("hot_pairs", [1 << 20, 40, 0])
def test_against_brute_force(spark, models, hot_pairs):
    short = [r for r in rows() if len(r[1] or "") < 3000]
    df = spark.createDataFrame(short, SCHEMA).repartition(3)
    assert result(alignment.align(df, A, B, hot_pairs)) == brute(models, [r[:2] for r in short])


def test_products_equal_dense_ones():
    draw = np.random.default_rng(1)
    for _ in range(50):
        a, b = (np.cumsum(draw.integers(1, 4, 30)) for _ in range(2))
        a, b = (np.append(e[e < 40], 40) for e in (a, b))
        found = alignment.Alignment(np.arange(len(a)), np.arange(len(b)), a, b, np.intersect1d(a, b))
        dense = [np.array([[s <= k < e for k in range(40)] for s, e in zip([0, *x], x, strict=False)], int) for x in (a, b)]
        product = dense[0] @ dense[1].T
        i, j, n = found.overlap_links()
        assert sorted(zip(i, j, n, strict=True)) == sorted((*p, product[p]) for p in zip(*np.nonzero(product), strict=True))
        group = [np.array([[e > low and e <= high for low, high in zip([0, *found.cuts], found.cuts, strict=False)] for e in x], int) for x in (a, b)]
        shared = group[0] @ group[1].T
        pairs = sorted(zip(*found.group_links(), strict=True))
        assert pairs == sorted(zip(*np.nonzero(shared), strict=True))
        assert found.n_group_links() == len(pairs)


def test_token_bytes_are_those_of_the_decoder():
    aligner, decoder = alignment.Aligner(A, B), ByteLevel()
    tokenizer = Tokenizer.from_file(A)
    for k in range(0, 50_256, 97):
        raw = aligner.a_bytes[k]
        if b"\xef\xbf\xbd" not in (text := decoder.decode([tokenizer.id_to_token(k)])).encode():
            assert raw == text.encode()


def test_a_very_long_text(spark):
    draw = random.Random(3)
    text = " ".join("".join(draw.choice("aeinorst") for _ in range(draw.randint(1, 9))) for _ in range(60_000))
    found = result(alignment.align(documents(spark, [(1, text, None, None, 0), (2, "x" * 300_000, None, None, 0)]), A, B))
    assert [(r[0], r[1] > 60_000) for r in found] == [(1, True), (2, False)]
    assert all(r[4] >= max(r[1], r[2]) and r[5] <= r[4] and r[3] > 0 for r in found)


def test_odd_tables(spark, models):
    assert result(alignment.align(documents(spark, []), A, B)) == []
    own = [r for r in corpus() if len(r[1] or "") < 3000]
    clash = documents(spark, own).withColumns({c: F.lit("x") for c in ("row_id", "pairs", "times", "n_a", "n_links", "pair", "best")})
    assert result(alignment.align(clash, A, B)) == brute(models, [r[:2] for r in own])
