"""Sinks whose micro-batches become visible as a whole.

Every row that a micro-batch writes carries the id of its load. The last thing a batch writes
is its commit, one row with that id, and readers take rows of committed loads alone: trips,
dead letters and ledger entries of a batch appear together, and what a crashed attempt left
behind is never seen. A batch that is run again after its commit does nothing.

What was loaded is known from an index of keys, dealt to buckets by their hash. A batch reads
the buckets of its own keys, not the sink.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.operators.load import drop_repeats, has_null, in_partitions_of, insert_new, read_if_exists
from tripmill.operators.sinks import write_lake
from tripmill.schema import STREAM_PARTITIONS

BATCH_COLUMNS = ("stream_id", "batch_id")
LOAD_ID = "load_id"
BUCKETS = 256
COMPACT_EVERY = 64


class Batch(NamedTuple):
    """What names a micro-batch across restarts."""

    stream_id: str
    batch_id: int


def write_batch(df: DataFrame, path: str, batch: Batch) -> None:
    """Write one micro-batch under its own partition, replacing an earlier attempt."""
    named = df.withColumns({name: F.lit(value) for name, value in zip(BATCH_COLUMNS, batch, strict=True)})
    write_lake(named, path, partitions=BATCH_COLUMNS, layout="none")


def folders(spark: SparkSession, path: str, depth: int = 1) -> list[str]:
    """Partition folders under a path, ``depth`` levels down. Only names are listed."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    found = [s.getPath() for s in files.listStatus(place) if s.isDirectory() and "=" in s.getPath().getName()]
    if depth == 1:
        return [p.toString() for p in found]
    return [f for p in found for f in folders(spark, p.toString(), depth - 1)]


def remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


class Log:
    """Rows that micro-batches add to a folder, beside a snapshot of the earlier ones.

    Now and then the snapshot and the batches since are merged to a new snapshot. Merging must
    not mind rows it meets twice, as a batch stays for one more round after it went into a
    snapshot: whoever reads meanwhile finds all files of what they began with. Reading
    costs one snapshot and a bounded number of batches, however many there were. One stream
    writes a log at a time.
    """

    def __init__(self, spark: SparkSession, path: str, partitions: Sequence[str] = ()):
        self.spark, self.path, self.partitions = spark, path, tuple(partitions)

    def add(self, df: DataFrame, batch: Batch) -> None:
        write_batch(df, f"{self.path}/deltas", batch)

    def versions(self) -> dict[int, str]:
        return {int(p.rpartition("=")[2]): p for p in folders(self.spark, f"{self.path}/snapshots")}

    def read(self) -> DataFrame | None:
        """All rows; those of the snapshot may come again from batches."""
        parts = []
        if snapshots := self.versions():
            parts.append(self.spark.read.parquet(snapshots[max(snapshots)]))
        if (deltas := read_if_exists(self.spark, f"{self.path}/deltas")) is not None:
            parts.append(deltas)
        return parts[0].unionByName(parts[1], allowMissingColumns=True) if len(parts) == 2 else parts[0] if parts else None

    def compact(self, merge: Callable[[DataFrame], DataFrame]) -> None:
        """Write a snapshot of all that was added, and drop what the snapshot before it holds."""
        before, batches = self.versions(), folders(self.spark, f"{self.path}/deltas", 2)
        rows = self.read()
        if rows is None:
            return
        last = max(before, default=0)
        named = merge(rows).withColumn("version", F.lit(last + 1))
        write_lake(named, f"{self.path}/snapshots", partitions=("version", *self.partitions))
        held = read_if_exists(self.spark, f"{self.path}/merged/version={last}")
        old = {r.batch for r in held.collect()} if held is not None else set()  # no more than two rounds of batches
        now = self.spark.createDataFrame([(b,) for b in batches if b not in old], "batch string")
        now.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/merged/version={last + 1}")
        gone = [path for v, path in before.items() if v < last]
        for path in [*gone, *(p.replace("/snapshots/", "/merged/") for p in gone), *sorted(old)]:
            remove(self.spark, path)


class Load:
    """One attempt at a micro-batch."""

    def __init__(self, sink: CommittedSink, batch: Batch):
        self.sink, self.batch, self.load_id = sink, batch, uuid.uuid4().hex
        self.facts: dict[str, Column] = {}

    def _named(self, df: DataFrame) -> DataFrame:
        return df.withColumn(LOAD_ID, F.lit(self.load_id))

    def add(self, rows: DataFrame, path: str | None = None) -> None:
        """Append rows as they are to the sink, or to a folder laid out alike."""
        write_lake(self._named(rows), path or self.sink.path, mode="append", partitions=self.sink.partitions)

    def add_new(self, rows: DataFrame) -> None:
        """Append rows whose key was never loaded; repeats inside the batch go too. Rows
        without a complete key are all appended."""
        fresh = drop_repeats(rows, self.sink.keys).persist()
        try:
            known = self.sink.known(fresh)
            new = fresh if known is None else insert_new(fresh, known, self.sink.keys)
            new = new.persist()
            try:
                self.add(new)
                if not self.sink.key_fixes_partition:
                    self.sink.index.add(self._named(self.sink.keyed(new)), self.batch)
            finally:
                new.unpersist()
        finally:
            fresh.unpersist()

    def beside(self, df: DataFrame, path: str) -> None:
        """Write rows that go with the batch to a folder of batches; ``CommittedSink.read`` reads it."""
        write_batch(self._named(df), path, self.batch)


class CommittedSink:
    """A folder of rows laid out by partition columns, filled by micro-batches.

    ``key_fixes_partition`` is the caller's word that rows of one key always fall into one
    partition; then no index is kept, and the batch's partitions are read instead.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str] = ("trip_id",),
        partitions: Sequence[str] = STREAM_PARTITIONS,
        key_fixes_partition: bool = False,
        buckets: int = BUCKETS,
        compact_every: int = COMPACT_EVERY,
    ):
        self.spark, self.path, self.keys, self.partitions = spark, path, list(keys), tuple(partitions)
        self.key_fixes_partition, self.buckets, self.compact_every = key_fixes_partition, buckets, compact_every
        self.commits, self.index = Log(spark, f"{path}.commits"), Log(spark, f"{path}.keys", ["bucket"])
        self.started: set[str] = set()

    def committed(self, df: DataFrame) -> DataFrame:
        """Rows of committed loads, without the columns that name load and batch."""
        commits = self.commits.read()
        if commits is None:
            return df.drop(LOAD_ID, *BATCH_COLUMNS).limit(0)
        return df.join(commits.select(LOAD_ID).distinct(), LOAD_ID, "left_semi").drop(LOAD_ID, *BATCH_COLUMNS)

    def read(self, path: str | None = None) -> DataFrame | None:
        """What committed batches wrote to the sink, or to a folder beside it."""
        df = read_if_exists(self.spark, path or self.path)
        return None if df is None else self.committed(df)

    def is_committed(self, batch: Batch) -> bool:
        commits = self.commits.read()
        same = (F.col("stream_id") == batch.stream_id) & (F.col("batch_id") == batch.batch_id)
        return commits is not None and not commits.where(same).isEmpty()

    @contextmanager
    def load(self, batch: Batch) -> Iterator[Load | None]:
        """An attempt at a batch, committed when the block ends; None if the batch is in already.

        Only the first batch of a run can be a repeated one.
        """
        repeated = batch.stream_id not in self.started and self.is_committed(batch)
        self.started.add(batch.stream_id)
        if repeated:
            yield None
            return
        attempt = Load(self, batch)
        yield attempt
        self.commits.add(self.spark.range(1).select(F.lit(attempt.load_id).alias(LOAD_ID), *[c.alias(n) for n, c in attempt.facts.items()]), batch)
        if (batch.batch_id + 1) % self.compact_every == 0:
            self.compact()

    def compact(self) -> None:
        self.commits.compact(lambda df: df.dropDuplicates([LOAD_ID]))
        self.index.compact(lambda df: self._settled(df).dropDuplicates(self.keys))

    def _settled(self, index: DataFrame) -> DataFrame:
        """Keys that are in the sink; those of a snapshot are, and name no load."""
        if LOAD_ID not in index.columns:
            return index.select("bucket", *self.keys)
        known = index.where(F.col(LOAD_ID).isNull()).select("bucket", *self.keys)
        return known.unionByName(self.committed(index.where(F.col(LOAD_ID).isNotNull())).select("bucket", *self.keys))

    def keyed(self, rows: DataFrame) -> DataFrame:
        """The complete keys of rows, with their buckets."""
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        return rows.where(~has_null(self.keys)).select(bucket.alias("bucket"), *self.keys)

    def known(self, rows: DataFrame) -> DataFrame | None:
        """Loaded keys among which those of ``rows`` are, if they were loaded."""
        if self.key_fixes_partition:
            held = self.read()
            return None if held is None else in_partitions_of(rows, held, self.partitions)
        index = self.index.read()
        if index is None and (held := self.read()) is not None:  # filled before it had an index
            index = self.keyed(held)
        if index is None:
            return None
        # At most as many values as there are buckets; as literals they prune files.
        touched = [r[0] for r in self.keyed(rows).select("bucket").distinct().collect()]
        return self._settled(index.where(F.col("bucket").isin(touched)))

    def remove_left_overs(self) -> int:
        """Delete files that attempts without a commit left in the sink; returns their number.

        For a time when no stream fills it. Each file is written by one attempt.
        """
        held = read_if_exists(self.spark, self.path)
        if held is None:
            return 0
        named = held.select(LOAD_ID, F.col("_metadata.file_path").alias("file")).distinct()
        commits = self.commits.read()
        left = named if commits is None else named.join(commits.select(LOAD_ID), LOAD_ID, "left_anti")
        files = [r[0] for r in left.select("file").distinct().collect()]
        for file in files:
            remove(self.spark, file)
        return len(files)
