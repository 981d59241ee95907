"""Streaming loads into Parquet sinks that survive replays and restarts.

foreachBatch may run a batch again after a failure. All that a batch writes becomes visible
with its commit (``commits``), and a batch that was committed is not run again, so a repeat
adds nothing, whether or not its rows have keys. The stream's id lives in its checkpoint, so a
stream started afresh is another stream; its rows are known by their keys.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tripmill.functions.times import as_of_column
from tripmill.operators.load import ledger_entries
from tripmill.schema import STREAM_PARTITIONS, STREAM_TYPES
from tripmill.streaming.cleanse import cleanse, failed_rows, good_rows
from tripmill.streaming.commits import Batch, CommittedSink, Load
from tripmill.streaming.files import decode_now, read_whole


def start(writer, checkpoint: str, once: bool) -> StreamingQuery:
    """Run until the input is drained, or keep running."""
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def start_batches(
    writer, function: Callable[[DataFrame, Batch], None], checkpoint: str, once: bool
) -> StreamingQuery:
    """Run a function per micro-batch; it gets the rows and the batch's name."""
    known = threading.Event()
    stream: list[str] = []

    def each(rows: DataFrame, batch_id: int) -> None:
        known.wait()
        function(rows, Batch(stream[0], batch_id))

    query = start(writer.foreachBatch(each), checkpoint, once)
    stream.append(str(query.id))
    known.set()
    return query


def run_stream(
    raw_stream: DataFrame,
    sink: str,
    bad_sink: str,
    checkpoint: str,
    keys: Sequence[str] = ("trip_id",),
    received_at=None,
    inserted_at=None,
    key_fixes_partition: bool = False,
    once: bool = True,
) -> StreamingQuery:
    """Cleanse envelopes; good rows to the keyed trip sink, failures to the dead-letter sink."""
    trips = CommittedSink(raw_stream.sparkSession, sink, keys, STREAM_PARTITIONS, key_fixes_partition)

    def each(rows: DataFrame, batch: Batch) -> None:
        with trips.load(batch) as load:
            if load is None:
                return
            records = cleanse(rows, received_at).drop("record").persist()
            try:
                good = good_rows(records).withColumn("inserted_at", as_of_column(inserted_at))
                load.add_new(good.select(*STREAM_TYPES))
                load.beside(failed_rows(records), bad_sink)
            finally:
                records.unpersist()

    return start_batches(raw_stream.writeStream, each, checkpoint, once)


def run_keyed_load(
    stream: DataFrame,
    sink: str,
    checkpoint: str,
    keys: Sequence[str] = ("trip_id",),
    partitions: Sequence[str] = STREAM_PARTITIONS,
    key_fixes_partition: bool = False,
    once: bool = True,
) -> StreamingQuery:
    """Append stream rows whose key was never loaded, checked against all that was.

    Reads the buckets of the key index that the batch's keys fall into, or with
    ``key_fixes_partition`` the partitions of the sink that the batch touches. ``dedup_within``
    does without either for rows whose repeats come within a bounded delay.
    """
    trips = CommittedSink(stream.sparkSession, sink, keys, partitions, key_fixes_partition)

    def each(rows: DataFrame, batch: Batch) -> None:
        with trips.load(batch) as load:
            if load is not None:
                load.add_new(rows)

    return start_batches(stream.writeStream, each, checkpoint, once)


def dedup_within(
    stream: DataFrame, keys: Sequence[str] = ("trip_id",), event_col: str = "event_time", delay: str = "1 hour"
) -> DataFrame:
    """First row per key among rows less than ``delay`` apart; state is bounded by the delay."""
    timed = stream.withColumn(event_col, F.col(event_col).cast("timestamp")).withWatermark(event_col, delay)
    return timed.dropDuplicatesWithinWatermark(list(keys))


def file_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """New Parquet files of a folder, each once; the file name comes along as ``source_file``."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).select("*", F.col("_metadata.file_path").alias("source_file"))


def run_file_load(
    files: DataFrame,
    sink: str,
    ledger: str,
    checkpoint: str,
    keys: Sequence[str] = ("trip_id",),
    partitions: Sequence[str] = STREAM_PARTITIONS,
    dataset_name: str = "streaming_trips",
    key_fixes_partition: bool = False,
    once: bool = True,
) -> StreamingQuery:
    """Load landed Parquet files and record each in the ledger, with the rows that it brought."""
    trips = CommittedSink(files.sparkSession, sink, keys, partitions, key_fixes_partition)

    def each(rows: DataFrame, batch: Batch) -> None:
        with trips.load(batch) as load:
            if load is not None:
                load.add_new(rows.drop("source_file"))
                loaded = rows.select(F.col("source_file").alias("key")).distinct()
                load.beside(ledger_entries(loaded, "streaming", dataset_name), ledger)

    return start_batches(files.writeStream, each, checkpoint, once)


def run_tolerant_file_load(
    files: DataFrame,
    schema: StructType,
    sink: str,
    ledger: str,
    failures: str,
    checkpoint: str,
    keys: Sequence[str] = ("trip_id",),
    partitions: Sequence[str] = STREAM_PARTITIONS,
    dataset_name: str = "streaming_trips",
    lookback: str = "1 day",
    retries: int = 100,
    once: bool = True,
) -> StreamingQuery:
    """``run_file_load`` that goes on without files it cannot load, and tries them again later.

    ``files`` come from ``files.whole_files``. Tasks decode each file for itself, in one job for
    all files of a batch. One that fails stays out of the ledger and is listed under
    ``failures`` with the reason. A batch, and the start of a run, takes listed files along that
    the ledger still lacks, at most ``retries`` of them, the oldest first, until they have not
    changed for ``lookback``.
    """
    spark = files.sparkSession
    trips = CommittedSink(spark, sink, keys, partitions)

    def pending() -> list[str]:
        listed = trips.read(failures)
        if listed is None:
            return []
        recent = F.col("modified_at") >= F.current_timestamp() - F.expr(f"INTERVAL {lookback}")
        left = listed.where(recent).groupBy("key").agg(F.max("modified_at").alias("modified_at"))
        if (done := trips.read(ledger)) is not None:
            left = left.join(done.select(F.col("pipeline_id").alias("key")), "key", "left_anti")
        names = [r.key for r in left.orderBy("modified_at", "key").limit(retries).collect()]
        return [n for n in names if exists(spark, n)]

    def load_files(found: DataFrame, load: Load) -> None:
        load.add_new(found.where(~F.col("is_file")).select(*schema.names))
        of_files = found.where("is_file").withColumn("key", F.col("source_file"))
        load.beside(ledger_entries(of_files.where("reason IS NULL"), "streaming", dataset_name), ledger)
        load.beside(of_files.where("reason IS NOT NULL").select("key", "modified_at", "reason"), failures)

    def each(rows: DataFrame | None, batch: Batch) -> None:
        names = pending()
        if rows is None and not names:
            return
        with trips.load(batch) as load:
            if load is None:
                return
            again = read_whole(spark, names) if names else None
            given = again if rows is None else rows if again is None else again.unionByName(rows).dropDuplicates(["path"])
            found = decode_now(given, schema)
            try:
                load_files(found, load)
            finally:
                found.unpersist()

    each(None, Batch(f"retry-{uuid.uuid4()}", 0))  # no new file need come for a listed one to be tried again
    return start_batches(files.writeStream, each, checkpoint, once)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def run_late_split(
    stream: DataFrame,
    sink: str,
    late_sink: str,
    checkpoint: str,
    event_col: str = "event_time",
    delay: str = "1 hour",
    partitions: Sequence[str] = STREAM_PARTITIONS,
    once: bool = True,
) -> StreamingQuery:
    """Send rows older than the newest earlier event by more than ``delay`` to a side sink.

    Nothing is dropped. The newest event time of a batch goes into its commit; a run looks it
    up once and carries it from batch to batch. Both sinks are laid out by ``partitions``.
    """
    spark = stream.sparkSession
    on_time = CommittedSink(spark, sink, partitions=partitions)
    seen: list = []

    def newest_before(batch: Batch):
        commits = on_time.commits.read()
        if commits is None:
            return None
        same = (F.col("stream_id") == batch.stream_id) & (F.col("batch_id") < batch.batch_id)
        return commits.where(same).agg(F.max("newest")).first()[0]

    def each(rows: DataFrame, batch: Batch) -> None:
        with on_time.load(batch) as load:
            if load is None:
                return
            if not seen:
                seen.append(newest_before(batch))
            bound = F.lit(None if seen[0] is None else str(seen[0])).cast("timestamp_ntz")
            late = F.coalesce(F.col(event_col) < bound - F.expr(f"INTERVAL {delay}"), F.lit(False))
            marked = rows.withColumn("late", late).persist()
            try:
                load.add(marked.where(~F.col("late")).drop("late"))
                load.add(marked.where("late").drop("late"), late_sink)
                newest = marked.agg(F.max(event_col)).first()[0]
            finally:
                marked.unpersist()
            newest = max((n for n in (newest, seen[0]) if n is not None), default=None)
            load.facts["newest"] = F.lit(None if newest is None else str(newest)).cast("timestamp_ntz")
        seen[:] = [newest]

    return start_batches(stream.writeStream, each, checkpoint, once)
