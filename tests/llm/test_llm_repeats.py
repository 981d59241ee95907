from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import corpus, documents
from tripmill.llm import repeats
from tripmill.llm.suffix_array import equal_prefix_groups, suffix_array


def test_suffix_array_sorts_suffixes():
    draw = random.Random(2)
    for _ in range(400):
        top = draw.choice([1, 2, 5, 255])
        text = [draw.randint(0, top) for _ in range(draw.randint(0, 70))]
        assert suffix_array(np.array(text, np.int64)).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


@pytest.mark.parametrize("length", [1, 3, 8, 9, 21])
def test_groups_are_the_equal_strings(length):
    draw = random.Random(length)
    text = bytes(draw.choice(b"ab") for _ in range(300))
    ok = np.arange(300) <= 300 - length
    order, group = equal_prefix_groups(np.frombuffer(text, np.uint8).astype(np.int64), ok, length)
    by_group: dict[int, set] = {}
    for at, g in zip(order, group, strict=True):
        by_group.setdefault(int(g), set()).add(text[at : at + length])
    assert all(len(v) == 1 for v in by_group.values())
    assert len(by_group) == len({text[k : k + length] for k in range(300 - length + 1)})


def brute(rows: list[tuple[int | None, str | None]], ties: dict, length: int) -> list[tuple]:
    """What stays of each row, by comparing every string with all before it."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, ties[r[1]]))
    seen, out = set(), []
    for doc_id, text in order:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - length + 1):
            if raw[k : k + length] in seen:
                gone[k : k + length] = True
            seen.add(raw[k : k + length])
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        runs = int((gone & ~np.append(False, gone[:-1])).sum()) if len(raw) else 0
        out.append((doc_id, len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def both(spark, df, length: int) -> tuple[list, list]:
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    hashed = df.select("text", F.xxhash64(F.coalesce(F.col("text").cast("binary"), F.lit(b"")))).distinct().collect()
    got = sorted((tuple(r) for r in repeats.report(df, length).collect()), key=repr)
    return got, brute(rows, {t: h for t, h in hashed}, length)


@pytest.mark.parametrize("length", [1, 7, 30, 100])
def test_documents_of_all_kinds(spark, length):
    got, want = both(spark, documents(spark), length)
    assert got == want


@pytest.mark.parametrize("limits", [{}, {"_SUFFIXES": 40, "_STRINGS": 200}, {"_TOGETHER": 50, "_STRETCH": 64}])
def test_small_alphabet_and_small_limits(spark, limits, monkeypatch):
    for name, value in limits.items():
        monkeypatch.setattr(repeats, name, value)
    draw = random.Random(5)
    line = "".join(draw.choice("abcd") for _ in range(40))
    rows = []
    for k in range(60):
        text = "".join(draw.choice("ab" if k % 3 else "abé") for _ in range(draw.randint(0, 120)))
        rows.append((draw.randrange(50), text + line + "".join(draw.choice("abc") for _ in range(k)) if k % 2 else text, None, None, None))
    got, want = both(spark, documents(spark, rows), 16)
    assert got == want


def in_process(rows: list[tuple[int, bytes]], length: int, parts: int) -> set[tuple[int, int]]:
    """``(id, start)`` of the repeated strings by the steps of ``remove_repeats``, run in this
    process, where limits set by a test hold. Batches are of ``parts`` rows."""
    def by_part(batches, *columns):
        table = pa.Table.from_batches(batches).sort_by([("part", "ascending")])
        return table.select(columns).to_batches(max_chunksize=parts) if columns else table.to_batches(max_chunksize=parts)

    minimizers = by_part([b for k in range(0, len(rows), parts) for b in repeats._minimizer_rows(
        iter([pa.RecordBatch.from_pydict({"doc": [r[0] for r in rows[k : k + parts]], "text": [r[1] for r in rows[k : k + parts]]})]), length)])
    crowds = {m for b in repeats._crowded_rows(iter(minimizers), length) for m in b.column(0).to_pylist()}
    wanted: dict[int, set] = {}
    for b in repeats._repeated_rows(iter(minimizers)):
        for doc, m in zip(*b.to_pydict().values(), strict=True):
            wanted.setdefault(doc, set()).add(m)
    docs = [(k, k, 0, t, list(wanted[k]), list(wanted[k] & crowds)) for k, t in rows if k in wanted]
    blocks = []
    for k in range(0, len(docs), parts):
        names = ("doc", "id", "tie", "text", "repeated", "crowded")
        blocks += repeats._block_rows(iter([pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*docs[k : k + parts], strict=True)), strict=True)))]), length)
    spans = [r for b in repeats._span_rows(iter(by_part(blocks)), length) for r in b.to_pylist()]
    assert crowds
    return {(r["id"], k) for r in spans for k in range(r["start"], r["stop"])}


@pytest.mark.parametrize("length", [12, 30])
@pytest.mark.parametrize("parts", [1, 7, 1000])
def test_a_line_in_most_documents_is_never_held_whole(monkeypatch, length, parts):
    """Its edge blocks differ in every document; no suffix array may grow with them."""
    monkeypatch.setattr(repeats, "_SUFFIXES", 500)
    draw = random.Random(8)
    line = bytes(draw.choice(b"abcdefgh ") for _ in range(60))
    own = lambda: bytes(draw.choice(b"abcdefgh ") for _ in range(40))
    rows = [(k, own() + line + own() if k % 3 else own() + b"\n" + line) for k in range(200)]
    real, sizes = repeats._repeated_spans, []
    monkeypatch.setattr(repeats, "_repeated_spans", lambda blocks, n: sizes.append(sum(len(t) + 1 for _, t in blocks)) or real(blocks, n))
    seen, want = set(), set()
    for k, text in rows:
        for at in range(len(text) - length + 1):
            if text[at : at + length] in seen:
                want.add((k, at))
            seen.add(text[at : at + length])
    assert in_process(rows, length, parts) == want
    assert max(sizes, default=0) <= 5 * repeats._SUFFIXES


def test_a_crowd_at_the_limits_that_hold(spark):
    """More distinct edge blocks of one line than a suffix array takes."""
    draw = random.Random(3)
    line = "".join(draw.choice("abcdefgh ") for _ in range(130))
    rows = [(k, "".join(draw.choice("abcdefgh ") for _ in range(60)) + line, None, None, None) for k in range(repeats._crowd(100) + 500)]
    got, want = both(spark, documents(spark, rows), 100)
    assert got == want


def test_crowded_minimizers_are_cut_into_strings():
    """Blocks of a crowded minimizer leave as digests by string, equal strings met on the way."""
    draw = random.Random(4)
    line = bytes(draw.choice(b"abcdefgh ") for _ in range(150))
    texts = [bytes(draw.choice(b"abcdefgh ") for _ in range(90)) + line for _ in range(40)]
    finder = repeats.Minimizers(100)
    prints = [np.concatenate([found for found, _, _ in finder.blocks(t)]).view(np.int64).tolist() for t in texts]
    columns = {"doc": range(40), "id": range(40), "tie": range(40), "text": texts, "repeated": prints, "crowded": prints}
    batch = pa.RecordBatch.from_pydict({k: list(v) for k, v in columns.items()})
    out = [r for b in repeats._block_rows(iter([batch]), 100) for r in b.to_pylist()]
    whole = [r for r in out if r["block"] is not None]
    assert all(len(r["block"]) == 16 and r["stop"] - r["start"] == 1 for r in whole)
    assert len(whole) == len({t[k : k + 100] for t in texts for k in range(len(t) - 99)})
    assert sum(r["stop"] - r["start"] for r in out) == sum(len(t) - 99 for t in texts)


def test_distinct_blocks_are_counted():
    """Equal blocks count once where they are looked at together, and a crowd is found by its sum."""
    draw = random.Random(6)
    line = bytes(draw.choice(b"abcdefgh ") for _ in range(200))
    texts = [bytes(draw.choice(b"abcdefgh ") for _ in range(90)) + line for _ in range(30)]
    batch = pa.RecordBatch.from_pydict({"doc": list(range(30)), "text": texts})
    (rows,) = repeats._minimizer_rows(iter([batch]), 100)
    got = {r["part"]: r["kind"] for r in rows.to_pylist() if r["kind"] > 0}
    finder, want = repeats.Minimizers(100), {}
    for t in texts:
        for found, starts, stops in finder.blocks(t):
            for m, a, b in zip(found.view(np.int64).tolist(), starts, stops, strict=True):
                want.setdefault(m, []).append(t[a : b + 99])
    assert got == {m: len(set(v)) for m, v in want.items() if len(v) > 1}
    assert max(got.values()) > 5 and min(got.values()) == 1


def test_no_rows(spark):
    assert repeats.report(documents(spark, [])).collect() == []


def test_text_stage_keeps_columns_and_nulls(spark):
    df = documents(spark).withColumns({"n_spans": F.lit("own"), "kept": F.lit(1), "spans": F.lit(2), "copy": F.lit(3)})
    out = repeats.without_repeats(df.drop("kept"), 20)
    assert out.columns == df.drop("kept").columns
    rows = out.collect()
    assert len(rows) == len(corpus())
    assert all(r["n_spans"] == "own" for r in rows)
    assert sum(r["text"] is None for r in rows) == sum(r[1] is None for r in corpus())
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in rows)


def test_blocks_follow_the_content():
    """Blocks are long, cover each string once, and move with the text they are cut from."""
    draw = random.Random(9)
    finder = repeats.Minimizers(100)
    text = bytes(draw.choice(b"abcdefgh ") for _ in range(6000))
    (prints, starts, stops), = finder.blocks(text)
    assert starts[0] == 0 and stops[-1] == 6000 - 99 and (starts[1:] == stops[:-1]).all()
    assert 25 < (stops - starts).mean() < 45
    (moved, _, _), = finder.blocks(b"something else before " + text)
    assert len(set(prints.tolist()) - set(moved.tolist())) <= 1
