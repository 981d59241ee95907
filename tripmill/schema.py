"""Canonical schemas and the fixed values of the trip data model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
CAB_TYPES = ("yellow", "green", "fhv")
PARTITION_COLUMNS = ("cab_type", "year", "month", "day")

# Raw time columns by cab type.
TIME_COLUMNS = {
    "yellow": {
        "tpep_pickup_datetime": "pickup_datetime",
        "tpep_dropoff_datetime": "dropoff_datetime",
    },
    "green": {
        "lpep_pickup_datetime": "pickup_datetime",
        "lpep_dropoff_datetime": "dropoff_datetime",
    },
    "fhv": {},
}

# Columns an fhv file may lack.
FHV_FILL = {"trip_distance": "double", "fare_amount": "double", "passenger_count": "bigint"}

METADATA_COLUMNS = ("_metadata", "_spark_metadata")

# The trip lake.
TRIP_TYPES = {
    "vendorid": "int",
    "pickup_datetime": "timestamp_ntz",
    "dropoff_datetime": "timestamp_ntz",
    "store_and_fwd_flag": "string",
    "ratecodeid": "bigint",
    "pulocationid": "int",
    "dolocationid": "int",
    "passenger_count": "bigint",
    "trip_distance": "double",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "ehail_fee": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "payment_type": "bigint",
    "trip_type": "bigint",
    "congestion_surcharge": "double",
    "airport_fee": "double",
    "cab_type": "string",
    "year": "int",
    "month": "int",
    "day": "int",
}

# Columns of a staged file that go to the final trip table, in load order.
LOAD_BASE_COLUMNS = (
    "vendorid", "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag", "ratecodeid",
    "pulocationid", "dolocationid", "passenger_count", "trip_distance", "fare_amount",
    "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "payment_type", "congestion_surcharge",
)
LOAD_EXTRA_COLUMNS = ("ehail_fee", "trip_type", "airport_fee")
# Of the extras, those a cab type brings itself; the others are loaded as NULL.
LOAD_OWN_EXTRAS = {"yellow": (), "green": ("ehail_fee", "trip_type")}
TRIP_KEY = ("vendorid", "pickup_datetime", "pulocationid", "dolocationid")

# Stream records.
REQUIRED_RECORD_KEYS = (
    "trip_id", "pickup_datetime", "dropoff_datetime",
    "passenger_count", "fare_amount", "payment_type",
)
STREAM_TYPES = {
    "trip_id": "string",
    "pickup_datetime": "timestamp_ntz",
    "dropoff_datetime": "timestamp_ntz",
    "pulocationid": "int",
    "dolocationid": "int",
    "passenger_count": "int",
    "fare_amount": "double",
    "payment_type": "int",
    "event_time": "timestamp_ntz",
    "lambda_received_time": "timestamp_ntz",
    "inserted_at": "timestamp_ntz",
    "year": "int",
    "month": "int",
    "day": "int",
    "hour": "int",
}
STREAM_PARTITIONS = ("year", "month", "day", "hour")
REPLAY_DEFAULTS = {
    "passenger_count": 1,
    "fare_amount": 0,
    "payment_type": 1,
    "pulocationid": 0,
    "dolocationid": 0,
}

NEW_YORK = "America/New_York"
COLOR_DOWN = "#e74c3c"
COLOR_UP = "#2ecc71"
CREDIT_PRICE_USD = "2.0000"
RPU_HOUR_PRICE_USD = "0.375"
# --- end of fixed values ----------------------------------------------------


# Stage events of the run audit, and the ledger of loaded files.
AUDIT_TYPES = {
    "pipeline_id": "string",
    "stage": "string",
    "pipeline_name": "string",
    "pipeline_type": "string",
    "executor": "string",
    "status": "string",
    "timestamp": "timestamp_ntz",
    "record_count": "bigint",
    "s3_input": "string",
    "s3_output": "string",
    "db_table": "string",
    "details": "string",
}
LEDGER_TYPES = {
    "pipeline_id": "string",
    "pipeline_type": "string",
    "dataset_name": "string",
    "s3_uri": "string",
    "status": "string",
    "copied_at": "timestamp_ntz",
    "notes": "string",
}


def ddl(types: dict[str, str]) -> str:
    """Schema string for readers and createDataFrame."""
    return ", ".join(f"`{name}` {kind}" for name, kind in types.items())


def conform(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the columns named in ``types``; leave others as they are.

    Files of different months disagree on physical types (a count may be a double), so
    the casts happen here once and not in every query. A cast to the type a column has
    already is dropped by Catalyst and does not block pushdown.
    """
    return df.select(
        *[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns]
    )
