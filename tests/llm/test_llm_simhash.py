from __future__ import annotations

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.cases import SCHEMA, corpus, documents, words
from tripmill.llm import components as components_module
from tripmill.llm import simhash
from tripmill.llm.common import written
from tripmill.llm.components import components

ASCII = {c: c + 32 for c in range(65, 91)}


def brute_print(text: str | None) -> int:
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] * bool(w)
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << k for k in range(64) if hashes and 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_components(prints: list[int], ids: list[int | None]) -> list[int | None]:
    left, out = set(range(len(prints))), {}
    while left:
        todo = [left.pop()]
        group = set(todo)
        while todo:
            here = todo.pop()
            near = {k for k in left if (prints[k] ^ prints[here]).bit_count() <= 2}
            left -= near
            group |= near
            todo += near
        least = min((ids[k] for k in group if ids[k] is not None), default=None)
        out |= dict.fromkeys(group, least)
    return [out[k] for k in range(len(prints))]


def expected(rows: list[tuple]) -> list[tuple]:
    prints = [brute_print(r[1]) for r in rows]
    return sorted(zip([r[0] for r in rows], prints, brute_components(prints, [r[0] for r in rows]), strict=True), key=repr)


def found(df) -> list[tuple]:
    return sorted(((r[0], r[2] % (1 << 64), r[3]) for r in df.collect()), key=repr)


def test_documents_of_all_kinds(spark):
    assert found(simhash.near_duplicates(documents(spark))) == expected(corpus())


def test_no_rows(spark):
    assert simhash.near_duplicates(documents(spark, [])).collect() == []
    assert simhash.keep_one(documents(spark, [])).collect() == []


def family(draw: random.Random, n: int) -> list[int]:
    out = {draw.getrandbits(64)}
    while len(out) < n:
        v = draw.choice(sorted(out))
        for _ in range(draw.randint(1, 5)):
            v ^= 1 << draw.randrange(64)
        out.add(v)
    return sorted(out)


@pytest.mark.parametrize("shard_rows", [1, 6, 4000])
@pytest.mark.parametrize("radius", [0, 1, 2])
def test_links_join_what_lies_within_the_radius(spark, shard_rows, radius):
    draw = random.Random(shard_rows)
    values = sorted({v for n in (1, 2, 40, 5) for v in family(draw, n)} | {0, (1 << 64) - 1, 1 << 63})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    got: dict[int, set] = {}
    for print_, name in simhash.families(df, radius, shard_rows).collect():
        got.setdefault(name, set()).add(print_ % (1 << 64))
    left, want = set(values), []
    while left:
        group = {left.pop()}
        while more := {v for v in left if any((v ^ g).bit_count() <= radius for g in group)}:
            group |= more
            left -= more
        want.append(group)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want))


def test_tree_search_finds_all_within_the_radius():
    import numpy as np

    draw = random.Random(3)
    values = np.array(family(draw, 200), np.uint64)
    pairs = {(n, int(q)) for n, near in simhash.BKTree(values).search(values, 2) for q in near}
    assert pairs == {(a, b) for a in range(200) for b in range(200) if int(values[a] ^ values[b]).bit_count() <= 2}


def test_keep_one_of_each_group(spark):
    rows = corpus()
    clash = documents(spark).withColumns({"fingerprint": F.lit("x"), "component_id": F.lit(1), "tie": F.lit(2.5), "family": F.lit(None)})
    kept = simhash.keep_one(clash)
    assert kept.columns == clash.columns
    ids = [r["doc_id"] for r in kept.collect()]
    groups = {c for _, _, c in expected(rows)}
    # An id with two texts may stay twice, if each stands for a group of its own.
    assert set(ids) == groups
    texts = kept.select("doc_id", "text").collect()
    assert len(texts) == len(set(texts))


def test_unlike_texts_of_one_id_all_stay(spark):
    texts = [words(random.Random(k), 30, 5000) for k in range(3)]
    rows = [(1, texts[0], None, None, 0), (1, texts[1], None, None, 0), (2, texts[2], None, None, 0)]
    kept = simhash.keep_one(documents(spark, rows)).select("doc_id", "text").collect()
    assert sorted(map(tuple, kept)) == sorted((r[0], r[1]) for r in rows)


def test_near_copies_without_ids_leave_one(spark):
    base = words(random.Random(4), 1000, 5000)
    more = [f"{base} tail{k}" for k in range(60)]
    near = [t for t in more if 1 <= (brute_print(t) ^ brute_print(base)).bit_count() <= 2][:3]
    assert len(near) == 3
    rows = [(None, t, "en", None, 0) for t in (base, *near)] + [(None, words(random.Random(5), 40), None, None, 0)]
    kept = simhash.keep_one(documents(spark, rows))
    assert kept.where("lang = 'en'").count() == 1 and kept.count() == 2


def test_columns_of_any_name_stay(spark):
    odd = documents(spark).withColumns({c: F.lit("x") for c in ("none", "id", "tie", "whole", "row", "__id", "__tie", "__none")})
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns and kept.where("whole = 'x' and none = 'x' and tie = 'x'").count() == kept.count() > 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(7, 7), (100, 101), (101, 100), (None, 3)], "a long, b long")
    got = dict(components(edges).collect())
    assert got == dict.fromkeys(range(41), 0) | {100: 100, 101: 100}


def test_components_take_no_round_over_stars(spark, monkeypatch):
    names = []
    monkeypatch.setattr(components_module, "written", lambda df, name: names.append(name) or written(df, name))
    stars = spark.createDataFrame([(k, 0) for k in range(1, 6)] + [(11, 10), (10, 11), (20, 20)], "a long, b long")
    assert dict(components(stars).collect()) == dict.fromkeys(range(6), 0) | {10: 10, 11: 10, 20: 20}
    assert len(names) == 1
    for edges in ([(3, 2), (3, 1)], [(3, 2), (2, 1)]):
        got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
        assert got == {1: 1, 2: 1, 3: 1}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_null_ids_alone(spark):
    rows = [(None, "one two three four", None, None, None)] * 2 + [(None, "something else entirely here", None, None, None)]
    assert {r["component_id"] for r in simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()} == {None}
    assert simhash.keep_one(spark.createDataFrame(rows, SCHEMA)).count() == 2
