"""A training corpus from raw documents: five stages, each written and read again.

Every stage takes all that the stage before it kept. All but the last return the columns of
documents; the last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tripmill.llm import decontamination, packing, repeats, simhash, toxicity
from tripmill.llm.common import table, written

# Removed bytes, near duplicates and hit windows are settled across stages by their own input,
# so no SQL expresses the whole.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity network rejects go.

    Rows with null and empty texts are scored like any other, repeated rows alike; columns stay
    as they are. No rows give no rows.
    """
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id.

    Groups are those of ``op1``: fingerprints of three-word shingles within two bits. Texts
    without words, null ones among them, are one group; of repeated rows one stays; unlike
    texts that share an id are apart. No rows give no rows.
    """
    return simhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes stay where they come first. Emptied documents stay as empty.

    Null and short texts stay as they are; of repeated rows all but one are emptied as far as
    whole strings reach. Every row is returned; no rows give no rows.
    """
    return repeats.without_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of a benchmark item go.

    Null and empty texts stay, repeated rows go or stay together, an empty benchmark drops
    nothing. No rows give no rows.
    """
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces in sequences of 1024 tokens.

    Null and empty texts are their end token alone; repeated rows are packed as often as they
    occur. No rows give no rows.
    """
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
