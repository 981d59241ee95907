"""Hourly and minute figures over a trip stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripmill.plans.dashboards import zone_aggregates
from tripmill.streaming.commits import BATCH_COLUMNS, COMPACT_EVERY, Batch, Log
from tripmill.streaming.load import start_batches


def stream_hourly(stream: DataFrame, event_col: str = "pickup_at", delay: str | None = None) -> DataFrame:
    """Trips, fares and mean passengers per hour.

    With a ``delay`` rows later than it are left out and append mode emits an hour once
    it is final; without, every row counts and the query runs in update or complete mode.
    """
    timed = stream.withColumn("event_at", F.col(event_col).cast("timestamp"))
    if delay:
        timed = timed.withWatermark("event_at", delay)
    figures = timed.groupBy(F.window("event_at", "1 hour")).agg(
        F.count("*").alias("trips"),
        F.sum("fare_amount").alias("fare_total"),
        F.avg(F.nullif(F.col("passenger_count"), F.lit(0))).alias("avg_passenger_count"),
    )
    return figures.select(
        F.col("window.start").cast("timestamp_ntz").alias("hour"), "trips", "fare_total", "avg_passenger_count"
    )


def stream_minutes(enriched: DataFrame, delay: str | None = None) -> DataFrame:
    """Figures per minute and zone of enriched stream trips (``dashboards.minute_figures``).

    With a ``delay`` the state of minutes older than it goes, and rows later than it are left out.
    """
    timed = enriched.withColumn("event_at", F.col("event_time").cast("timestamp"))
    if delay:
        timed = timed.withWatermark("event_at", delay)
    figures = timed.groupBy(F.window("event_at", "1 minute"), "pickup_zone").agg(*zone_aggregates())
    return figures.select(F.col("window.start").cast("timestamp_ntz").alias("minute"), *[c for c in figures.columns if c != "window"])


def run_updates(
    figures: DataFrame, keys: Sequence[str], sink: str, checkpoint: str, once: bool = True, compact_every: int = COMPACT_EVERY
) -> StreamingQuery:
    """Keep the changed figures of each batch; ``read_figures`` reads the newest state.

    Each update carries the time it was written, so that a stream started afresh over the
    same sink goes on from there. Every ``compact_every`` batches the newest figures of all
    keys go into a snapshot, so reading follows the number of keys, not of batches.
    """
    writer = figures.writeStream.outputMode("update")
    log = Log(figures.sparkSession, sink)

    def keep(rows: DataFrame, batch: Batch) -> None:
        log.add(rows.withColumn("written_at", F.current_timestamp()), batch)
        if (batch.batch_id + 1) % compact_every == 0:
            log.compact(lambda updates: newest_updates(updates, keys))

    return start_batches(writer, keep, checkpoint, once)


def newest_updates(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest update of each key."""
    rest = [c for c in updates.columns if c not in keys]
    newest = updates.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("written_at", "batch_id")).alias("last"))
    return newest.select(*keys, "last.*")


def read_figures(spark: SparkSession, sink: str, keys: Sequence[str]) -> DataFrame | None:
    """The figures of each key as they stand; None before the first batch."""
    updates = Log(spark, sink).read()
    return None if updates is None else newest_updates(updates, keys).drop("written_at", *BATCH_COLUMNS)


def run_hourly(hours: DataFrame, sink: str, checkpoint: str, once: bool = True, compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Keep ``stream_hourly`` up to date; ``read_hours`` reads it."""
    return run_updates(hours, ("hour",), sink, checkpoint, once, compact_every)


def read_hours(spark: SparkSession, sink: str) -> DataFrame | None:
    return read_figures(spark, sink, ("hour",))


def run_minutes(minutes: DataFrame, sink: str, checkpoint: str, once: bool = True, compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Keep ``stream_minutes`` up to date; ``read_minutes`` reads it."""
    return run_updates(minutes, ("minute", "pickup_zone"), sink, checkpoint, once, compact_every)


def read_minutes(spark: SparkSession, sink: str) -> DataFrame | None:
    return read_figures(spark, sink, ("minute", "pickup_zone"))
