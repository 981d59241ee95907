"""Very long texts, empty tables and clashing names, where the operators' own tests have none."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.conftest import plan_of
from tests.llm.cases import corpus, documents, words
from tests.llm.test_llm_simhash import brute_print
from tripmill.llm import decontamination, packing, repeats, sharding, simhash, url_rules

ITEM = "item_id long, text string"


@pytest.fixture(scope="module")
def long_text():
    return words(random.Random(11), 120_000, 3000)


def test_fingerprint_of_a_long_text(spark, long_text):
    found = simhash.near_duplicates(documents(spark, [(1, long_text, None, None, 0), (2, "short", None, None, 0)]))
    assert {r["doc_id"]: r["fingerprint"] % (1 << 64) for r in found.collect()} == {1: brute_print(long_text), 2: brute_print("short")}


def test_a_long_text_is_a_shard_of_its_own(spark, long_text):
    rows = [(k, long_text if k == 1 else "short", None, None, 0) for k in range(3)]
    got = {r["doc_id"]: (r["n_bytes"], r["shard_bytes"]) for r in sharding.assign(documents(spark, rows), 1000).collect()}
    assert got[1] == (len(long_text), len(long_text))


def test_shards_with_clashing_names(spark):
    clash = documents(spark).withColumns({"n_bytes": F.lit("x"), "shard_bytes": F.lit("y")})
    plain = sharding.assign(documents(spark), 3000).select("doc_id", "n_bytes", "depth", "shard", "shard_bytes")
    odd = sharding.assign(clash, 3000).select("doc_id", "n_bytes", "depth", "shard", "shard_bytes")
    assert sorted(map(tuple, odd.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_repeats_of_a_long_text(spark, long_text):
    tail = " " + words(random.Random(12), 40, 5000)
    rows = [(1, long_text, None, None, 0), (2, long_text + tail, None, None, 0), (3, "ab" * 300_000, None, None, 0)]
    got = {r["doc_id"]: r for r in repeats.report(documents(spark, rows)).collect()}
    assert (got[1]["n_removed"], got[2]["n_removed"]) == (0, len(long_text))
    assert got[2]["kept_sha256"] == hashlib.sha256(tail.encode()).hexdigest()
    assert (got[3]["n_removed"], got[3]["n_spans"]) == (600_000 - 2, 1)


def test_repeats_with_columns_of_any_name(spark):
    odd = documents(spark).withColumns({c: F.lit(k) for k, c in enumerate(("none", "own", "row", "n_bytes", "kept", "__none", "__own_n_bytes", "a.b"))})
    kept = repeats.without_repeats(odd)
    plain = repeats.without_repeats(documents(spark))
    assert kept.columns == odd.columns
    assert kept.where("none = 0 and own = 1 and n_bytes = 3 and `a.b` = 7").count() == len(corpus())
    assert sorted(map(tuple, kept.select("doc_id", "text").collect()), key=repr) == sorted(map(tuple, plain.select("doc_id", "text").collect()), key=repr)


def test_packing_of_a_long_text(spark, long_text):
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.pack_documents(documents(spark, [(1, long_text, None, None, 0)]), path).collect()
    n = len(Tokenizer.from_file(path).encode(long_text, add_special_tokens=False).ids) + 1
    assert sum(p["length"] for p in pieces) == n
    assert sorted(p["length"] for p in pieces)[1:] == [1024] * (len(pieces) - 1)


def test_phrases_in_a_long_text_of_copies(spark, long_text):
    item = words(random.Random(13), 30, 100_000)
    rows = [(1, f"{item} " * 700, None, None, 0), (2, f"{long_text} {item}", None, None, 0), (3, long_text, None, None, 0)]
    benchmark = spark.createDataFrame([(5, item)], ITEM)
    got = {r["doc_id"]: (r["n_words"], r["n_hit"]) for r in decontamination.report(documents(spark, rows), benchmark).collect()}
    assert got == {1: (21_000, 21_000), 2: (120_030, 30), 3: (120_000, 0)}
    near = decontamination.proximity_matches(documents(spark, rows), benchmark).collect()
    assert {r["doc_id"] for r in near} == {1, 2}


def test_words_are_cut_once(spark, tmp_path):
    """No text is cut inside a join's condition or a lambda, and no join is forced."""
    documents(spark).write.parquet(f"{tmp_path}/docs")
    benchmark = spark.createDataFrame([(5, corpus()[0][1])], ITEM)
    plan = plan_of(decontamination.matches(spark.read.parquet(f"{tmp_path}/docs"), benchmark)).split("== Initial Plan")[0]
    for line in plan.split("\n"):
        assert "split" not in line or "Join" not in line
        assert line.count("split(") <= 1


def test_drop_contaminated_keeps_columns_of_any_name(spark):
    benchmark = spark.createDataFrame([(5, corpus()[0][1])], ITEM)
    odd = documents(spark).withColumns({c: F.lit("x") for c in ("whole", "id", "hash", "tie", "__id", "__tie", "bit", "word", "bits")})
    kept = decontamination.drop_contaminated(odd, benchmark)
    plain = decontamination.drop_contaminated(documents(spark), benchmark)
    assert kept.columns == odd.columns and 0 < kept.count() == plain.count() < len(corpus())


def test_proximity_of_odd_tables(spark):
    benchmark = spark.createDataFrame([(5, corpus()[0][1]), (6, None), (None, "")], ITEM)
    names = {c: F.lit("x") for c in ("item", "item_id", "words", "tie", "need", "met")}
    plain = decontamination.proximity_matches(documents(spark), benchmark)
    odd = decontamination.proximity_matches(documents(spark).withColumns(names), benchmark.withColumn("doc_id", F.lit(1)))
    assert sorted(map(tuple, odd.collect())) == sorted(map(tuple, plain.collect())) != []
    assert decontamination.proximity_matches(documents(spark, []), benchmark).collect() == []
    assert decontamination.proximity_matches(documents(spark), spark.createDataFrame([], ITEM)).collect() == []


def test_long_urls_and_clashing_names(spark):
    path = "/es/" + "x" * 200_000
    pages = spark.createDataFrame([(1, f"http://a.example.org{path}?q"), (2, "http://" + "b." * 3000 + "com/fr/"), (3, None)], "page_id long, url string")
    clash = pages.withColumns({"path": F.lit(1), "verdict": F.lit(2), "host": F.lit(3), "rule": F.lit(4), "key": F.lit(5), "stack": F.lit(6)})
    got = {r["page_id"]: r for r in url_rules.judge(clash, url_rules.contract_rules(spark)).collect()}
    assert (got[1]["path"], got[1]["rule"], got[1]["verdict"]) == (path, "example.org/es/", "block")
    assert (got[2]["rule"], got[2]["verdict"]) == ("com/fr/", "allow")
    assert (got[3]["host"], got[3]["rule"], got[3]["verdict"]) == ("", None, "allow")
