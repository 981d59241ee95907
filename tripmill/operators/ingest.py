"""Raw month to lake rows."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.functions.times import month_range
from tripmill.operators.sinks import write_lake
from tripmill.schema import (
    FHV_FILL,
    LOAD_BASE_COLUMNS,
    LOAD_EXTRA_COLUMNS,
    LOAD_OWN_EXTRAS,
    METADATA_COLUMNS,
    REPLAY_DEFAULTS,
    TIME_COLUMNS,
    TRIP_TYPES,
    conform,
)
from tripmill.sources.landing import check_month_arguments, read_month


def lower_columns(df: DataFrame) -> DataFrame:
    lowered = [c.lower() for c in df.columns]
    clash = sorted(name for name, n in Counter(lowered).items() if n > 1)
    if clash:
        raise ValueError(f"columns differ only in case: {', '.join(clash)}")
    return df.toDF(*lowered)


def standardize(df: DataFrame, cab_type: str) -> DataFrame:
    """Canonical names and types: time columns, lower case, fhv fill, no metadata columns."""
    df = lower_columns(df.withColumnsRenamed(TIME_COLUMNS[cab_type]).drop(*METADATA_COLUMNS))
    if cab_type == "fhv":
        missing = {c: F.lit(None).cast(t) for c, t in FHV_FILL.items() if c not in df.columns}
        if missing:
            df = df.withColumns(missing)
    if "pickup_datetime" not in df.columns:
        raise ValueError("no pickup_datetime column after standardization")
    return conform(df, TRIP_TYPES)


def restrict_month(df: DataFrame, year: int, month: int, column: str = "pickup_datetime") -> DataFrame:
    """Rows of one month; NULL and out-of-month pickups go."""
    return df.where(month_range(F.col(column), year, month))


def add_partitions(df: DataFrame, cab_type: str, year: int, month: int) -> DataFrame:
    return df.withColumns(
        {
            "cab_type": F.lit(cab_type),
            "year": F.lit(int(year)),
            "month": F.lit(int(month)),
            "day": F.dayofmonth("pickup_datetime"),
        }
    )


def monthly_rows(df: DataFrame, cab_type: str, year: int, month: int) -> DataFrame:
    cab_type, year, month = check_month_arguments(cab_type, year, month)
    return add_partitions(restrict_month(standardize(df, cab_type), year, month), cab_type, year, month)


def ingest_month(
    spark: SparkSession,
    prefix: str,
    lake: str,
    cab_type: str,
    year: int,
    month: int,
    mode: str = "overwrite_partitions",
    layout: str = "balanced",
    num_files: int | None = None,
) -> None:
    """Read one raw month and write its day partitions. A re-run replaces them."""
    raw = read_month(spark, prefix, cab_type, year, month)
    write_lake(monthly_rows(raw, cab_type, year, month), lake, mode, layout, num_files)


def align_for_load(df: DataFrame, cab_type: str) -> DataFrame:
    """Columns of the final trip table; extras a cab type does not bring are NULL."""
    if cab_type not in LOAD_OWN_EXTRAS:
        raise ValueError(f"unsupported cab_type: {cab_type}")
    own = LOAD_OWN_EXTRAS[cab_type]
    extras = [
        F.col(c) if c in own else F.lit(None).cast(TRIP_TYPES[c]).alias(c) for c in LOAD_EXTRA_COLUMNS
    ]
    return df.select(*LOAD_BASE_COLUMNS, *extras, F.lit(cab_type).alias("cab_type"))


def fill_defaults(trips: DataFrame) -> DataFrame:
    """Defaults for missing values; a column keeps its type."""
    present = {c: v for c, v in REPLAY_DEFAULTS.items() if c in trips.columns}
    return trips.fillna(present)
