"""Sharding, license digests, benchmark phrases and URL rules on small cases."""

from __future__ import annotations

import hashlib
import re
import textwrap
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tests.llm.cases import corpus, documents, words
from tripmill.llm import decontamination, licenses, sharding, url_rules

ASCII = {c: c + 32 for c in range(65, 91)}


# --- sharding -------------------------------------------------------------------
@pytest.mark.parametrize("limit", [200, 3000, 1 << 20])
def test_shards_fit_and_follow_the_bits(spark, limit):
    clash = documents(spark).withColumns({"shard": F.lit(7), "part": F.lit("x"), "depth": F.lit(None), "h": F.lit(1)})
    rows = sharding.assign(clash, limit).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in corpus())
    sizes, counts, keys = Counter(), Counter(), {}
    for r in rows:
        digest = hashlib.md5((r["text"] or "").encode()).hexdigest()
        text = f"{'' if r['doc_id'] is None else r['doc_id']}:{digest}"
        bits = f"{int(hashlib.md5(text.encode()).hexdigest()[:15], 16):060b}"
        assert bits.startswith(r["shard"]) and len(r["shard"]) == r["depth"]
        assert r["n_bytes"] == len((r["text"] or "").encode())
        sizes[r["shard"], r["part"]] += r["n_bytes"]
        counts[r["shard"], r["part"]] += 1
        keys.setdefault(r["shard"], []).append((bits, r["n_bytes"]))
    assert all(size <= limit or counts[k] == 1 for k, size in sizes.items())
    for shard in keys:  # split only where the bucket above was too large
        if shard:
            above = sum(n for s, own in keys.items() for b, n in own if b.startswith(shard[:-1]))
            assert above > limit
    for a in keys:
        assert not any(b != a and b.startswith(a) for b in keys)


def test_repeated_rows_over_the_limit_are_dealt(spark):
    rows = [(5, "same text " * 10, None, None, None)] * 25
    out = sharding.assign(documents(spark, rows), 350).collect()
    assert all(n <= 3 for n in Counter((r["shard"], r["part"]) for r in out).values())
    assert len(out) == 25


def test_sharding_no_rows(spark):
    assert sharding.assign(documents(spark, [])).collect() == []


def test_written_shards_hold_all_rows(spark, tmp_path):
    placed = sharding.assign(documents(spark), 3000)
    sharding.write_shards(placed, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == len(corpus())


# --- licenses -------------------------------------------------------------------
def test_spellings_case_and_copyright_lines_do_not_matter(spark):
    rows = [
        (1, "Copyright (c) 2020 A. Name\nReleased under the  MIT Licence!", None, None, None),
        (2, "Some words.\nLICENSED UNDER THE APACHE LICENSE, VER. 2.0\nAll rights reserved", None, None, None),
        (3, "We say all rights reserved here", None, None, None),
        (4, None, None, None, None),
        (5, "", None, None, None),
        (5, "", None, None, None),
        (None, "All Rights Reserved.", None, None, None),
    ]
    clash = documents(spark, rows).withColumns({"whole_license": F.lit(1), "digest": F.lit("x"), "license": F.lit("y")})
    out = licenses.scan(clash)
    got = sorted(((r["doc_id"], r["whole_license"], r["line_licenses"], r["n_license_lines"]) for r in out.collect()), key=repr)
    assert got == sorted(
        [
            (1, "MIT", "MIT", 1),
            (2, None, "Apache-2.0,proprietary", 2),
            (3, None, "", 0),
            (4, None, "", 0),
            (5, None, "", 0),
            (5, None, "", 0),
            (None, "proprietary", "proprietary", 1),
        ],
        key=repr,
    )


def test_whole_text_of_a_known_license(spark):
    text = licenses.KNOWN[-1][1]
    spelled = "Copyright 2001 Someone\n\n" + text.upper().replace("SUBLICENSE", "SUBLICENCE").replace(", ", " ,\n  ")
    assert licenses.scan(documents(spark, [(1, spelled, None, None, None)])).first()["whole_license"] == "MIT"


def test_complete_wrapped_texts(spark):
    """Real texts under a title and a copyright line, wrapped anywhere; "copyright" begins lines."""
    texts = {p.stem: p.read_text() for p in licenses.WHOLE_TEXTS.glob("*.txt") if "~" not in p.stem}
    assert {"MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-3.0", "GPL-2.0", "LGPL-3.0", "MPL-2.0"} <= set(texts)
    rows, want = [], {}
    for name, text in sorted(texts.items()):
        plain = name not in licenses.TITLES  # their copyright lines lie between others
        for wide in (None,) if plain else (None, 30, 61, 79, 10_000):
            body = text if wide is None else "\n\n".join(textwrap.fill(p, wide) for p in text.split("\n\n"))
            for head in ("",) if plain else ("", "Copyright (c) 2020 A. Name\n\n", licenses.TITLES[name][0] + "\n\nCopyright A. Name and others\n"):
                rows.append((len(rows), head + body, None, None, None))
                want[len(rows) - 1] = name
    for k, cut in enumerate((texts["MIT"][:-40], texts["ISC"].replace("copyright notice", "notice"), "copyright notice and this")):
        rows.append((1000 + k, cut, None, None, None))
        want[1000 + k] = None
    rows.append((2000, texts["Apache-2.0"].split(licenses.END_OF_TERMS)[0].upper(), None, None, None))
    want[2000] = "Apache-2.0"
    filled = texts["Apache-2.0"].replace("Copyright [yyyy] [name of copyright owner]", "Copyright 2019 The Authors")
    rows.append((2001, filled, None, None, None))
    want[2001] = "Apache-2.0"
    assert filled != texts["Apache-2.0"]
    assert any(line.startswith("copyright") for r in rows for line in r[1].splitlines())
    got = {r["doc_id"]: r["whole_license"] for r in licenses.scan(documents(spark, rows)).collect()}
    assert got == want


def in_comments(text: str, style: str) -> str:
    if style == "/*":
        return "/*\n" + "\n".join(f" * {line}" for line in text.split("\n")) + "\n */"
    return "\n".join(f"{style} {line}" for line in text.split("\n"))


def test_texts_as_they_are_found(spark):
    """Notices over them, comment marks before them, other numbering, an SPDX line on top."""
    texts = {p.stem: p.read_text() for p in licenses.WHOLE_TEXTS.glob("*.txt")}
    notice = "Copyright (c) 2012-2020, Some One <one@example.org>\nAll rights reserved.\n\n"
    cases = [
        (notice + texts["BSD-3-Clause"], "BSD-3-Clause", ""),
        (notice.replace("\n", "\r\n") + texts["BSD-2-Clause"].replace("\n", "\r\n"), "BSD-2-Clause", ""),
        (notice + re.sub(r"(?m)^[0-9][.] ", "* ", texts["BSD-3-Clause"]), "BSD-3-Clause", ""),
        (texts["BSD-3-Clause~regents"], "BSD-3-Clause", ""),
        (in_comments(notice + texts["BSD-3-Clause"], "/*"), "BSD-3-Clause", ""),
        (in_comments("MIT License\n\nCopyright (c) 2020 A. Name\n\n" + texts["MIT"], "#"), "MIT", ""),
        (in_comments("Copyright © A. Name\n" + texts["ISC"], "//"), "ISC", ""),
        (in_comments(texts["GPL-2.0"], ";"), "GPL-2.0", None),
        ("SPDX-License-Identifier: MIT\n\n" + texts["MIT"], "MIT", "MIT"),
        ("SPDX-License-Identifier: MIT", "MIT", "MIT"),
        (texts["LGPL-2.1"], "LGPL-2.1", None),
        (texts["MPL-2.0"].upper(), "MPL-2.0", None),
        (texts["Unlicense"], "Unlicense", None),
        ("All rights reserved.\n" + texts["MIT"], None, "proprietary"),
        ("words\nCopyright 2020 X\n\nAll rights reserved", None, "proprietary"),  # not right behind the notice
        (texts["MIT"] + " more words", None, None),
        ("a\n" * 20_000 + notice, None, ""),
    ]
    rows = [(k, text, None, None, None) for k, (text, _, _) in enumerate(cases)]
    got = {r["doc_id"]: r for r in licenses.scan(documents(spark, [*rows, rows[0], rows[9]])).collect()}
    for k, (_, whole, line) in enumerate(cases):
        assert got[k]["whole_license"] == whole, k
        assert line is None or got[k]["line_licenses"] == line, k
    assert (got[9]["n_license_lines"], got[0]["n_license_lines"]) == (1, 0)


def test_whole_licenses_agree_with_sql(spark, tmp_path):
    import duckdb

    from tripmill.llm.oracle import ORACLE

    texts = {p.stem: p.read_text() for p in licenses.WHOLE_TEXTS.glob("*.txt")}
    notice = "Copyright (c) 2012 Some One\nAll rights reserved.\n\n"
    rows = [(k, head + in_comments(text, style), None, None, None) for k, (text, head, style) in enumerate(
        (text, head, style) for text in texts.values() for head in ("", notice) for style in ("", "#"))]
    rows += [(1000 + k, r[1], None, None, None) for k, r in enumerate(corpus())]
    path = f"{tmp_path}/documents.parquet"
    documents(spark, rows).coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    want = sorted(con.sql(ORACLE["op3_license_scan"]).fetchall(), key=repr)
    got = licenses.scan(spark.read.parquet(path)).select("doc_id", "whole_license", "line_licenses", "n_license_lines")
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert sum(r[1] is not None for r in want) >= 4 * len(texts) - 2


def test_licenses_no_rows_and_none_known(spark):
    assert licenses.scan(documents(spark, [])).collect() == []
    none = spark.createDataFrame([], licenses.KNOWN_SCHEMA)
    assert licenses.scan(documents(spark), none).where("n_license_lines > 0 or whole_license is not null").isEmpty()


# --- benchmark phrases ----------------------------------------------------------
def brute_report(rows: list[tuple], items: list[tuple], window: int) -> list[tuple]:
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(ASCII))
    phrases: dict[tuple, set] = {}
    for item_id, text in items:
        w = cut(text)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            phrases.setdefault(tuple(w[k : k + n]), set()).add("" if item_id is None else str(item_id))
    out = []
    for doc_id, text, *_ in rows:
        w, hit, ids = cut(text), set(), set()
        for n in {len(p) for p in phrases}:
            for k in range(len(w) - n + 1):
                if (found := phrases.get(tuple(w[k : k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    ids |= found
        out.append((doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def phrase_cases() -> tuple[list[tuple], list[tuple]]:
    import random

    draw = random.Random(12)
    item = words(draw, 30)
    parts = item.split()
    items = [
        (10, item), (9, " ".join(parts[5:25])), (2, "short item ÉA"), (3, "solo"), (4, None), (5, "... !"), (10, item), (10, "other text of ten " + item),
        (None, "ha " * 12), (7, "x y " * 8), (8, "ΟΔΟΣ. one two three four five six seven eight nine"),
    ]
    rows = [
        (1, f"before {item.upper()} after", None, None, None),
        (2, " ".join(parts[:9]), None, None, None),
        (3, " ".join(parts[3:20]) + ", " + " ".join(parts[10:30]), None, None, None),
        (4, "a SHORT, item Éa! and short item éa", None, None, None),
        (5, "ha-" * 40, None, None, None),
        (6, "x y " * 20 + "solo", None, None, None),
        (7, item + " " + item, None, None, None),
        (7, "another", None, None, None),
        (None, item, None, None, None),
        (8, "ΟΔΟΣ one two three four five six seven eight nine", None, None, None),
        *corpus(),
    ]
    return rows, items


@pytest.mark.parametrize("window", [1, 3, 10])
def test_phrases_equal_brute_force(spark, window):
    rows, items = phrase_cases()
    docs = documents(spark, rows).withColumns({"item_id": F.lit(3), "spans": F.lit("x"), "words": F.lit(0)})
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = sorted((tuple(r) for r in decontamination.report(docs, bench, window).collect()), key=repr)
    assert got == brute_report(rows, items, window)


def test_contaminated_rows_go(spark):
    rows, items = phrase_cases()
    docs = documents(spark, rows).withColumn("spans", F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = decontamination.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r[0] for r in brute_report(rows, items, 10) if not r[-1])


def test_proximity_finds_copies_with_changes(spark):
    rows, items = phrase_cases()
    w = items[0][1].split()
    loose = " ".join(x for k, x in enumerate(w) if k % 6 != 5)  # every sixth word left out
    docs = documents(spark, [*rows, (99, loose, None, None, None)])
    bench = spark.createDataFrame([(1, items[0][1]), (2, "nothing like it in any row at all of this table")], "item_id long, text string")
    near = {(r["doc_id"], r["item_id"]) for r in decontamination.proximity_matches(docs, bench).collect()}
    assert (99, "1") in near and (1, "1") in near
    assert not any(item == "2" for _, item in near)
    assert decontamination.report(docs, bench).where("doc_id = 99 and contaminated").isEmpty()


def brute_near(rows: list[tuple], items: list[tuple], window: int = 10, slop: int = 5, least: int = 3) -> list[tuple]:
    cut = lambda t: [w.lower() for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(ASCII))]
    counts = Counter(w for r in rows for w in cut(r[1]))
    out = []
    for item_id, text in set(items):
        w = cut(text)
        rare = lambda places: sorted((k for k in places if counts[w[k]]), key=lambda k: (counts[w[k]], k))
        size = min(window, len(w))
        chosen = set(rare(range(len(w)))[: least + 2]).union(*(rare(range(k, k + size))[:2] for k in range(len(w) - size + 1)))
        need = min(least, len(w))
        for doc_id, body in {(r[0], r[1] or "") for r in rows}:
            met = [(p - k, k) for p, word in enumerate(cut(body)) for k in chosen if w[k] == word]
            groups = [[m for m in met if low <= m[0] <= low + slop] for low, _ in met]
            most = max((min(len({k for _, k in g}), len({o + k for o, k in g})) for g in groups), default=0)
            if need and most >= need:
                out.append((doc_id, None if item_id is None else str(item_id), most))
    return sorted(out, key=repr)


def test_proximity_equals_brute_force(spark):
    rows, items = phrase_cases()
    rows = [*rows, (60, "one word two w1 w2 w3 more", None, None, None), (61, "ha", None, None, None), (62, "short " + "x " * 9 + "item ÉA", None, None, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for window, slop, least in ((10, 5, 3), (4, 0, 2), (10, 2, 1)):
        got = decontamination.proximity_matches(documents(spark, rows), bench, window, slop, least)
        assert sorted(map(tuple, got.collect()), key=repr) == brute_near(rows, items, window, slop, least)


def test_proximity_of_short_items_and_unseen_words(spark):
    rows = [
        (1, "he said alpha beta gamma delta epsilon zeta to her", None, None, None),
        (2, "alpha and nothing else of it", None, None, None),
        (3, "k0 k1 k2 k3 k4 changed k6 k7 k8 k9 k10 k11", None, None, None),
        (4, "pair here", None, None, None),
        (5, "ha", None, None, None),
    ]
    items = [
        (1, "alpha beta gamma delta epsilon zeta"),  # one window, an exact copy
        (2, "alpha beta unseen delta epsilon zeta"),  # a word that no document has
        (3, " ".join(f"k{k}" for k in range(12))),  # the copy's changed word is in every window
        (4, "Pair, here!"),  # fewer than three words
        (5, "ha ha ha"),  # one word cannot stand for three
        (6, "none of these"),
        (7, "missing everywhere"),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.proximity_matches(documents(spark, rows), bench).collect()}
    assert {(1, "1"), (1, "2"), (3, "3"), (4, "4")} <= got
    assert not got & {(2, "1"), (2, "2"), (5, "5")} and not any(item == "7" for _, item in got)


def test_phrases_empty_tables(spark):
    rows, items = phrase_cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert decontamination.report(documents(spark, []), bench).collect() == []
    none = decontamination.report(documents(spark, rows), bench.limit(0))
    assert none.count() == len(rows) and none.where("contaminated").isEmpty()


def test_native_paths_run_no_python(spark):
    rows, items = phrase_cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    for df in (
        sharding.assign(documents(spark)),
        url_rules.judge(pages, url_rules.contract_rules(spark)),
        decontamination.report(documents(spark, rows), bench),
    ):
        assert not re.search(r"Python|Arrow|Pandas|Cartesian|NestedLoop", plan_of(df))


# --- url rules ------------------------------------------------------------------
def brute_verdict(url: str | None, rules: list[tuple]) -> tuple:
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.translate(ASCII)
    fits = [
        (len(h + p), len(h), v, h + p)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


URLS = [
    None, "", "no scheme", "http://", "http://org", "http://ORG/", "https://www.Example.org/es/1?x#y", "http://example.org/en/12", "http://example.org/en/2",
    "http://notexample.org/es/", "ftp://a.b.com/fr/x", "http://com/de/", "http://x.com/de", "http://x.com:80/de/", "a://b://c/d", "http://a..com/fr/",
    "http://x.com?u=/fr/", "http://x.com#/fr/", "//x.com/fr/", "http://x.com/fr/é/\U0010ffff", "http://example.org/en/1\n2",
]


@pytest.mark.parametrize("rows_per_sweep", [1, 3, 200_000])
def test_rules_equal_brute_force(spark, rows_per_sweep):
    rules = [
        *url_rules.RULES, ("com", "/fr/a", "block"), ("com", "/fr/a/b", "allow"), ("x.com", "/fr", "block"), ("a.b.com", "", "block"),
        ("com", "/", "allow"), ("com", "/", "block"), ("example.org", "/en/1", "block"),
    ]
    urls = URLS + [f"http://{h}{p}" for h in ("com", "x.com", "a.b.com", "b.com", "example.org") for p in ("", "/", "/fr", "/fr/", "/fr/a", "/fr/a/b/c", "/fr/b", "/de/1", "/en/1/2")]
    rows = [(k // 2, u) for k, u in enumerate([*urls, *urls[:9]])] + [(None, urls[6])] * 3
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({"host": F.lit(1), "rule": F.lit("r"), "key": F.lit(2), "part": F.lit(3)})
    out = url_rules.judge(pages, spark.createDataFrame(rules, url_rules.RULE_SCHEMA), rows_per_sweep=rows_per_sweep).collect()
    got = sorted((repr(r["page_id"]), r["host"], r["path"], repr(r["rule"]), r["verdict"]) for r in out)
    want = []
    for page_id, url in rows:
        host, path, rule, verdict = brute_verdict(url, rules)
        want.append((repr(page_id), host, path, repr(rule), verdict))
    assert got == sorted(want)


def test_rules_empty_tables(spark):
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(URLS)], "page_id long, url string")
    none = spark.createDataFrame([], url_rules.RULE_SCHEMA)
    assert url_rules.judge(pages, none).where("verdict <> 'allow' or rule is not null").isEmpty()
    assert url_rules.judge(pages, none).count() == len(URLS)
    assert url_rules.judge(pages.limit(0), url_rules.contract_rules(spark)).collect() == []
