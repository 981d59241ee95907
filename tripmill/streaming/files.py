"""Landed Parquet files as a stream of whole files, each decoded for itself."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tripmill.session import conf_set

FILE = "path string, modificationTime timestamp, length bigint, content binary"
#: How a decoded file is told from its rows.
MARKS = "source_file string, modified_at timestamp, reason string, is_file boolean"


def whole_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """New Parquet files of a folder with their bytes, each once. For files a task can hold."""
    reader = spark.readStream.format("binaryFile").schema(FILE).option("pathGlobFilter", "*.parquet")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select("path", "modificationTime", "content")


def read_whole(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.format("binaryFile").schema(FILE).load(paths).select("path", "modificationTime", "content")


def decoded(files: DataFrame, schema: StructType) -> DataFrame:
    """The rows of whole files, and a row with ``is_file`` for each file.

    A file is decoded where its bytes are, so one that cannot be read, or whose values do not
    fit the schema, fails alone: it gives its own row with a ``reason`` and none of its rows.
    Columns a file lacks are null, others it has are left out. Every row group is decoded
    before the first row leaves, one at a time, so that no file is loaded by half.
    """
    fields = to_arrow_schema(schema)
    marks = pa.schema([("source_file", pa.string()), ("modified_at", pa.timestamp("us", "UTC")), ("reason", pa.string()), ("is_file", pa.bool_())])
    out = pa.schema([*fields, *marks])

    def groups(content: bytes) -> Iterator[pa.Table]:
        file = pq.ParquetFile(io.BytesIO(content))
        for k in range(file.num_row_groups):
            table = file.read_row_group(k)
            table = table.rename_columns([n if n in fields.names else n.lower() for n in table.column_names])
            columns = [table[f.name].cast(f.type) if f.name in table.column_names else pa.nulls(len(table), f.type) for f in fields]
            yield pa.table(columns, schema=fields)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, modified, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                reason = None
                try:
                    for _ in groups(content):
                        pass
                except Exception as error:  # noqa: BLE001 - whatever ails a file must not stop the others
                    reason = f"{type(error).__name__}: {error}".splitlines()[0][:300]
                if reason is None:
                    for table in groups(content):
                        n = len(table)
                        more = [pa.array([path] * n, pa.string()), pa.array([modified] * n, marks.field(1).type), pa.nulls(n, pa.string()), pa.array([False] * n)]
                        whole = pa.table([*table.columns, *more], schema=out)
                        yield from whole.combine_chunks().to_batches()
                none = [pa.nulls(1, f.type) for f in fields]
                yield pa.RecordBatch.from_arrays([*none, pa.array([path]), pa.array([modified], marks.field(1).type), pa.array([reason], pa.string()), pa.array([True])], schema=out)

    return files.mapInArrow(rows_of, StructType([*schema.fields, *StructType.fromDDL(MARKS).fields]))


def decode_now(files: DataFrame, schema: StructType) -> DataFrame:
    """``decoded``, kept by Spark; files reach the tasks one at a time."""
    rows = decoded(files, schema).persist()
    with conf_set(files.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch="1"):
        rows.agg(F.count("*")).first()
    return rows
