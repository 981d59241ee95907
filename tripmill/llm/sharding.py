"""Sharding by extendible hashing: only buckets over the byte limit split on another bit.

The directory maps a prefix of the hash's bits to a shard. A pass looks ahead ``STEP`` bits:
the rows of oversized buckets are summed per prefix, and the sums of the shorter prefixes
follow from those. The first prefix that fits is a shard; prefixes that still do not fit go
on to the next pass. The directory stays a DataFrame and holds one row per shard.

Only DataFrame functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import written

BITS = 60
STEP = 10
SHARD_BYTES = 1 << 20


def key_hash(*columns: Column) -> Column:
    """The first 60 bits of the MD5 of the columns' texts, as a non-negative long."""
    text = F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("long")


def _prefix(hash_: str, depth: str) -> Column:
    return F.expr(f"shiftright({hash_}, {BITS} - {depth})")


def directory(rows: DataFrame, limit_bytes: int) -> DataFrame:
    """``depth, prefix, bytes, n_rows`` of each shard of ``rows(h, n_bytes)``.

    A bucket that no bit can split, because all its rows share one hash, stays over the limit
    at the full depth.
    """
    sums = (F.sum("bytes").alias("bytes"), F.sum("n_rows").alias("n_rows"))
    active = rows.select("h", F.col("n_bytes").alias("bytes"), F.lit(1).cast("long").alias("n_rows")).groupBy("h").agg(*sums)
    shards = []
    for depth in range(0, BITS, STEP):
        deep = min(BITS, depth + STEP)
        first = depth if depth == 0 else depth + 1
        levels = (
            active.groupBy(_prefix("h", str(deep)).alias("finest"))
            .agg(*sums)
            .withColumn("depth", F.explode(F.sequence(F.lit(first), F.lit(deep))))
            .groupBy("depth", F.expr(f"shiftright(finest, {deep} - depth)").alias("prefix"))
            .agg(*sums)
        )
        levels = written(levels, "directory")
        over = levels.where(F.col("bytes") > limit_bytes)
        # A fitting bucket is a shard if the bucket above it does not fit.
        parents = over.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        leaf = (F.col("bytes") <= limit_bytes) | (F.col("depth") == BITS)
        below = levels.where(leaf).withColumn("parent", F.expr("shiftright(prefix, 1)"))
        top = below.where(F.col("depth") == first).drop("parent")
        rest = below.where(F.col("depth") > first).join(parents, ["depth", "parent"], "left_semi").drop("parent")
        shards.append(top.unionByName(rest.select(top.columns)))
        open_ = over.where(F.col("depth") == deep).select("prefix")
        if deep == BITS or open_.isEmpty():
            break
        active = active.withColumn("prefix", _prefix("h", str(deep))).join(open_, "prefix", "left_semi").drop("prefix")
    return written(reduce(DataFrame.unionByName, shards), "shards")


def assign(docs: DataFrame, limit_bytes: int = SHARD_BYTES) -> DataFrame:
    """Each document with the shard it belongs to.

    Adds ``n_bytes``, ``depth``, ``shard`` (the shard's hash bits as text, empty for a single
    shard), ``part`` and ``shard_bytes``, replacing input columns of those names. A null text
    has no bytes and a null id counts as empty text. Rows that repeat id and text share all
    their bits; a shard of such rows that is over the limit is dealt into numbered parts that
    fit. One row larger than the limit is a shard, or part, of its own. No rows give no rows.
    """
    added = ("n_bytes", "depth", "shard", "part", "shard_bytes")
    sized = docs.select(*[c for c in docs.columns if c not in added]).withColumns(
        {
            "n_bytes": F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"),
            "__h": key_hash(F.col("doc_id"), F.md5(F.coalesce("text", F.lit("")))),
        }
    )
    rows = written(sized.select(F.col("__h").alias("h"), "n_bytes"), "sizes")
    shards = directory(rows, limit_bytes)
    depths = [r["depth"] for r in shards.select("depth").distinct().collect()]  # at most 61 numbers
    places = (
        rows.select("h")
        .distinct()
        .withColumn("depth", F.explode(F.array(*[F.lit(d) for d in sorted(depths)])) if depths else F.lit(0))
        .withColumn("prefix", _prefix("h", "depth"))
        .join(shards, ["depth", "prefix"])
        .select(
            F.col("h").alias("__h"),
            "depth",
            F.expr("if(depth = 0, '', lpad(bin(prefix), depth, '0'))").alias("shard"),
            F.col("bytes").alias("shard_bytes"),
        )
    )
    placed = sized.join(places, "__h")
    if shards.where((F.col("bytes") > limit_bytes) & (F.col("n_rows") > 1)).isEmpty():
        placed = placed.withColumn("part", F.lit(0).cast("long"))
    else:
        copies = Window.partitionBy("__h").orderBy(F.lit(0))
        number = F.when(F.col("shard_bytes") > limit_bytes, F.row_number().over(copies) - 1).otherwise(0)
        each = F.greatest(F.lit(1), F.floor(F.lit(limit_bytes) / F.greatest("n_bytes", F.lit(1))))
        placed = placed.withColumn("part", F.floor(number / each).cast("long"))
    return placed.drop("__h")


def write_shards(placed: DataFrame, path: str) -> None:
    """The documents as one folder per shard and part, each written by one task."""
    placed.repartition("shard", "part").write.partitionBy("depth", "shard", "part").parquet(path)
