"""Staging models: stable names and types over the sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stg_trips(df: DataFrame) -> DataFrame:
    """Trip lake columns under their model names. Lineage columns are typed NULLs."""
    return df.select(
        F.col("vendorid").alias("vendor_id"),
        F.col("pickup_datetime").alias("pickup_at"),
        F.col("dropoff_datetime").alias("dropoff_at"),
        "store_and_fwd_flag",
        "ratecodeid",
        F.col("pulocationid").cast("bigint").alias("pickup_location_id"),
        F.col("dolocationid").cast("bigint").alias("dropoff_location_id"),
        "passenger_count",
        "trip_distance",
        "fare_amount",
        "extra",
        "mta_tax",
        "tip_amount",
        "tolls_amount",
        "ehail_fee",
        "improvement_surcharge",
        "total_amount",
        "payment_type",
        "trip_type",
        "congestion_surcharge",
        "airport_fee",
        "cab_type",
        F.col("year").alias("pickup_year"),
        F.col("month").alias("pickup_month"),
        F.col("day").alias("pickup_day"),
        F.lit(None).cast("string").alias("filename_loaded"),
        F.lit(None).cast("timestamp_ntz").alias("load_timestamp"),
    )


def stg_zones(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("locationid").alias("location_id"),
        "borough",
        "zone",
        "service_zone",
        F.lit(None).cast("string").alias("filename_loaded"),
    )


def stg_stream(df: DataFrame) -> DataFrame:
    """Stream trips under their model names, with the sink's partition columns where it has them."""
    parts = [F.col(c).alias(f"part_{c}") for c in ("year", "month", "day") if c in df.columns]
    return df.select(
        "trip_id",
        F.col("pickup_datetime").alias("pickup_at"),
        F.col("dropoff_datetime").alias("dropoff_at"),
        F.col("pulocationid").alias("pickup_location_id"),
        F.col("dolocationid").alias("dropoff_location_id"),
        "passenger_count",
        "fare_amount",
        "payment_type",
        "event_time",
        "lambda_received_time",
        "inserted_at",
        *parts,
    )
