"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.session import work_folder

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named(column: str, of: str = "") -> Column:
    """A column by its own name, dots and all, or such a member of a struct."""
    return F.col(f"{of}.`{column}`" if of else f"`{column}`")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone; other letters stay as they are."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is divisible by 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, kept as Parquet under the cluster's shared folder, with their lineage cut."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(batch: pa.RecordBatch, column: str = "text") -> Iterator[bytes]:
    """The UTF-8 bytes of a binary or string column; null counts as empty."""
    values = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    for value in values:
        yield value.as_py() or b""


def training_rows(docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_chars: int) -> list[tuple[str, int, float]]:
    """Labelled texts to fit on, as ``(text, label, rows it stands for)``.

    At most ``per_class`` of each label, none of them held out. The third value makes the
    sample weigh as the labels do among all rows that may be learnt from.

    The choice follows a hash of the id and so does not depend on how rows are split. Rows
    without a label, an id or a text, and texts over ``max_chars``, are not learnt from; an
    id labelled twice counts once, with its larger label. Both bounds keep the sample, which
    is all that reaches the driver, at a fixed size whatever the corpus.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("__label"))
        .where(~held_out(F.col("doc_id")))
    )
    totals = {r["__label"]: r["n"] for r in known.groupBy("__label").agg(F.count("*").alias("n")).collect()}
    short = docs.select("doc_id", "text").where(F.col("text").isNotNull() & (F.length("text") <= max_chars))
    out = []
    for value, total in sorted(totals.items()):
        # Twice as many ids as texts wanted, as some texts are too long to be learnt from.
        ids = known.where(F.col("__label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * per_class)
        part = short.join(F.broadcast(ids), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(per_class)
        found = [r["text"] for r in part.select("text").collect()]
        out += [(text, value, total / len(found)) for text in found]
    return out
