from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import SCHEMA, corpus, documents, words
from tripmill.llm import metric_join

ASCII = {c: c + 32 for c in range(65, 91)}


def shingles(text: str | None) -> frozenset:
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII))
    return frozenset(" ".join(w[i : i + 3]) for i in range(len(w) - 2)) if len(w) > 2 else frozenset([" ".join(w)] * bool(w))


def grouped(sets: list[frozenset], percent: int) -> list[list[int]]:
    left, out = set(range(len(sets))), []
    while left:
        group = todo = [left.pop()]
        group, todo = set(group), list(todo)
        while todo:
            here = sets[todo.pop()]
            near = {k for k in left if here and 100 * len(here & sets[k]) >= percent * len(here | sets[k])}
            left -= near
            group |= near
            todo += near
        out.append(sorted(group))
    return sorted(out)


def brute(rows: list[tuple], percent: int = 90) -> list[tuple]:
    sets = [shingles(r[1]) for r in rows]
    out = []
    for group in grouped(sets, percent):
        least = min((rows[k][0] for k in group if rows[k][0] is not None), default=None)
        out += [(rows[k][0], len(sets[k]), least) for k in group]
    return sorted(out, key=repr)


def found(df) -> list[tuple]:
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=repr)


def near_copies(draw: random.Random, families: int, copies: int) -> list[tuple]:
    rows = []
    for _ in range(families):
        base = words(draw, draw.choice([9, 12, 30, 80, 200]), 300).split()
        for _ in range(copies):
            own = list(base)
            for _ in range(draw.randint(0, max(1, len(base) // 25))):
                own[draw.randrange(len(own))] = f"x{draw.randrange(10**6)}"
            rows.append((draw.randrange(10**6), " ".join(own[: len(own) - draw.randint(0, 2)]), None, None, 0))
    return rows


def test_documents_of_all_kinds(spark):
    assert found(metric_join.join(documents(spark))) == brute(corpus())


@pytest.mark.parametrize(("percent", "limit", "pivots"), [(90, 2_000_000, 8), (90, 400, 3), (60, 400, 3), (100, 2_000_000, 8)])
def test_near_copies_against_brute_force(spark, percent, limit, pivots):
    rows = near_copies(random.Random(percent), 12, 14)
    df = documents(spark, rows).repartition(3)
    assert found(metric_join.join(df, percent=percent, limit=limit, pivots=pivots)) == brute(rows, percent)


def test_linked_sets_share_a_region():
    draw = random.Random(7)
    for percent in (60, 80, 90, 95):
        for _ in range(400):
            size = draw.choice([7, 8, 9, 10, 11, 18, 25, 39, 40, 41, 92, 200])
            space = draw.choice([1 << 64, 1 << 60, 1 << 34])  # low numbers leave most slices empty
            own = draw.sample(range(space), size) if space < 1 << 62 else [draw.getrandbits(64) for _ in range(size)]
            a = np.unique(np.array(own, np.uint64))
            change = metric_join.may_differ(len(a), percent)
            gone = draw.randint(0, change)
            b = np.unique(np.append(a[gone:], np.array([draw.getrandbits(64) for _ in range(change - gone)], np.uint64)))
            same = len(np.intersect1d(a, b))
            if 100 * same >= percent * (len(a) + len(b) - same) and len(a) != same:
                assert np.intersect1d(metric_join.regions_of(a, percent), metric_join.regions_of(b, percent)).size


def test_leaf_joins_exactly():
    draw = random.Random(9)
    for percent in (50, 75, 90):
        for _ in range(40):
            base = draw.sample(range(1000), 60)
            sets = [frozenset(draw.sample(base, draw.randint(40, 60)) + draw.sample(range(1000, 9000), draw.randint(0, 6))) for _ in range(25)]
            group = list(range(25))
            for i, j in metric_join.leaf_links([np.array(sorted(s), np.uint64) for s in sets], percent):
                assert 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
                group = [group[i] if g == group[j] else g for g in group]
            assert sorted([k for k in range(25) if group[k] == g] for g in set(group)) == grouped(sets, percent)


def test_dense_families_are_joined_in_blocks(spark):
    draw = random.Random(4)
    rows = [(k, words(draw, 100, 40) if k < 3 else None, None, None, 0) for k in range(3)]
    base = words(draw, 120, 5000).split()
    for k in range(60):  # alike, but most pairs are not alike enough
        own = list(base)
        for at in draw.sample(range(120), draw.randint(1, 6)):
            own[at] = f"y{draw.randrange(10**6)}"
        rows.append((100 + k, " ".join(own), None, None, 0))
    assert found(metric_join.join(documents(spark, rows), limit=600, pivots=2)) == brute(rows)


def test_odd_tables(spark):
    assert metric_join.join(documents(spark, [])).collect() == []
    assert found(metric_join.join(documents(spark, [(5, None, None, None, 0), (5, "", None, None, 0), (4, " ", None, None, 0)]))) == [(4, 0, 4), (5, 0, 5), (5, 0, 5)]
    clash = documents(spark).withColumns({c: F.lit("x") for c in ("key", "n", "high", "low", "node", "family", "set", "regions", "component_id")})
    assert found(metric_join.join(clash)) == brute(corpus())


def test_rows_without_ids(spark):
    rows = [(None, "a b c d e f g h i j", None, None, 0)] * 2 + [(None, "other words than those", None, None, 0)]
    assert found(metric_join.join(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_a_very_long_text(spark):
    draw = random.Random(5)
    long = words(draw, 100_000, 5000).split()
    rows = [(3, " ".join(long), None, None, 0), (1, " ".join(["z", *long[:-200]]), None, None, 0), (2, " ".join(long[:50_000]), None, None, 0)]
    assert found(metric_join.join(documents(spark, rows))) == brute(rows)
