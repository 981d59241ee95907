"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import (
    alignment,
    decontamination,
    licenses,
    metric_join,
    packing,
    quality_network,
    quality_rules,
    ranking,
    repeats,
    sharding,
    simhash,
    toxicity,
    url_rules,
)
from tripmill.llm.common import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    REGISTRY[function.__name__] = function
    return function


@query
def op2_extendible_shards(spark, sf_dir):
    return sharding.assign(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "depth", "shard", "part", "shard_bytes"
    )


@query
def op3_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "whole_license", "line_licenses", "n_license_lines"
    )


@query
def op9_url_rules(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge(pages, url_rules.contract_rules(spark)).select("page_id", "host", "path", "rule", "verdict")


@query
def op5_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)


@query
def op10_quality_rules(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_quality_network(spark, sf_dir):
    return quality_network.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_toxicity_network(spark, sf_dir):
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op1_simhash_components(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal(F.col("fingerprint")).alias("fingerprint"), "component_id")


@query
def op7_benchmark_phrases(spark, sf_dir):
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op7_benchmark_proximity(spark, sf_dir):
    """Changed copies, apart from the exact phrases, whose columns their SQL counterpart fixes."""
    return decontamination.proximity_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_suffix_array_dedup(spark, sf_dir):
    return repeats.report(table(spark, sf_dir, "documents"))


@query
def op12_ranked_search(spark, sf_dir):
    return ranking.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_tokenizer_alignment(spark, sf_dir):
    return alignment.align(table(spark, sf_dir, "documents"), TOKENIZER, public_tokenizers.path("piece_bpe_32k.model"))


@query
def op11_jaccard_components(spark, sf_dir):
    return metric_join.join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
