"""Enriched trips: staged trips with their pickup zone and derived time columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.times import (
    boundary_minutes,
    boundary_seconds,
    delay_minutes,
    elapsed_minutes,
    month_label,
    month_start,
    within_days,
)

TRIP_COLUMNS = (
    "vendor_id", "pickup_at", "dropoff_at", "pickup_location_id", "dropoff_location_id",
    "passenger_count", "trip_distance", "fare_amount", "tip_amount", "total_amount", "cab_type",
)

# Pickup year, month and day as the lake and the stream sink are partitioned by. Models carry
# them along, so that a filter on the pickup date can be met by whole partitions.
PARTS = ("part_year", "part_month", "part_day")


def parts_of(df: DataFrame) -> list[str]:
    return [c for c in PARTS if c in df.columns]


def part_date() -> Column:
    return F.make_date(*PARTS)


def on_day(trips: DataFrame, day: Column) -> DataFrame:
    """Enriched trips of one pickup day, which may be a subquery's value.

    Where the trips carry their partition columns, partitions of other days are not read.
    """
    kept = trips.where(F.col("pickup_date") == day)
    for name, part in zip(PARTS, (F.year, F.month, F.dayofmonth), strict=True):
        if name in trips.columns:
            kept = kept.where(F.col(name) == part(day))
    return kept


def with_pickup_zone(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Left join to the zone dimension; trips without a known zone keep NULL.

    No broadcast is forced. Spark compares the zone table's size with
    spark.sql.autoBroadcastJoinThreshold and broadcasts it below that; above, it sorts
    and merges, and AQE splits a zone that holds much of the trips.
    """
    names = zones.select(
        F.col("location_id").cast("bigint").alias("__zone_id"),
        F.col("zone").alias("pickup_zone"),
        F.col("borough").alias("pickup_borough"),
    )
    return trips.join(names, F.col("pickup_location_id") == F.col("__zone_id"), "left").drop("__zone_id")


def pickup_parts(ts: Column) -> list[Column]:
    return [
        F.to_date(ts).alias("pickup_date"),
        month_start(ts).alias("pickup_month"),
        month_label(ts).alias("pickup_month_ym"),
        F.hour(ts).alias("pickup_hour"),
    ]


def trip_zone(trips: DataFrame, zones: DataFrame, minutes: str = "elapsed") -> DataFrame:
    """Staged trips that end no earlier than they start, with zone and time parts.

    ``minutes`` picks the duration: ``elapsed`` whole minutes, or ``boundary`` crossings.
    """
    duration = {"elapsed": elapsed_minutes, "boundary": boundary_minutes}[minutes]
    pickup, dropoff = F.col("pickup_at"), F.col("dropoff_at")
    staged = {"pickup_year": "part_year", "pickup_month": "part_month", "pickup_day": "part_day"}
    parts = [F.col(c).alias(name) for c, name in staged.items() if c in trips.columns]
    kept = trips.select(*TRIP_COLUMNS, *parts).where(dropoff >= pickup)
    return with_pickup_zone(kept, zones).select(
        *TRIP_COLUMNS,
        *parts_of(kept),
        "pickup_zone",
        "pickup_borough",
        *pickup_parts(pickup),
        duration(pickup, dropoff).alias("trip_duration_min"),
    )


def streaming_enriched(stream: DataFrame, zones: DataFrame, as_of=None, days_back: int | None = 1) -> DataFrame:
    """Staged stream trips of the trailing days with zone, time parts and ingest lag.

    Works on a static or a streaming frame. ``days_back=None`` keeps all days, for a
    streaming frame whose trailing filter belongs to its readers.
    """
    pickup, dropoff = F.col("pickup_at"), F.col("dropoff_at")
    received, inserted = F.col("lambda_received_time"), F.col("inserted_at")
    kept = stream.where(dropoff >= pickup)
    if days_back is not None:
        kept = kept.where(within_days(pickup, as_of, days_back))
        if parts_of(stream):
            kept = kept.where(within_days(part_date().cast("timestamp_ntz"), as_of, days_back))
    return with_pickup_zone(kept, zones).select(
        "trip_id",
        "pickup_at",
        "dropoff_at",
        "pickup_location_id",
        "dropoff_location_id",
        "pickup_zone",
        "pickup_borough",
        "passenger_count",
        "fare_amount",
        "payment_type",
        "event_time",
        "lambda_received_time",
        "inserted_at",
        *pickup_parts(pickup),
        boundary_minutes(pickup, dropoff).alias("trip_duration_min"),
        boundary_seconds(received, inserted).alias("delay_time_seconds"),
        delay_minutes(received, inserted).alias("delay_time_minutes"),
    )


def live_trips(enriched: DataFrame) -> DataFrame:
    """The columns live dashboards read."""
    return enriched.select(
        "event_time", "trip_id", "pickup_zone", "delay_time_minutes", "fare_amount", "passenger_count"
    )
