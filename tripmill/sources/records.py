"""Stream records: JSON text in a base64 envelope (recordId, data)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F



# Envelope columns.
RECORD_SCHEMA = "recordId string, data string"


def read_envelopes(spark: SparkSession, path: str, streaming: bool = False, max_files: int | None = None) -> DataFrame:
    """Envelopes stored as JSON lines."""
    reader = spark.readStream if streaming else spark.read
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.schema(RECORD_SCHEMA).json(path)


def decode(data: Column) -> Column:
    """Text inside an envelope, trimmed; NULL if it is not base64 of UTF-8 text."""
    text = F.try_validate_utf8(F.try_to_binary(data, F.lit("base64")).cast("string"))
    return F.btrim(text, F.lit(" \t\r\n\x0b\x0c"))


def encode(json: Column) -> Column:
    """One JSON line as envelope data."""
    return F.base64(F.encode(F.concat(json, F.lit("\n")), "utf-8"))
