"""The partitioned trip lake and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Logical source names and the catalog tables behind them.
SOURCES = {
    "trip_data": "trip_data",
    "taxi_zone_lookup": "taxi_zone_lookup",
    "taxi_streaming_trips": "taxi_streaming_trips",
}


def lake_slice(
    df: DataFrame,
    cab_type: str | None = None,
    year: int | None = None,
    month: int | None = None,
    day: int | None = None,
) -> DataFrame:
    """Literal predicates on partition columns, which Spark answers by pruning folders."""
    wanted = {"cab_type": cab_type, "year": year, "month": month, "day": day}
    for name, value in wanted.items():
        if value is not None:
            df = df.where(F.col(name) == F.lit(value))
    return df


def read_day(spark: SparkSession, root: str, cab_type: str, year: int, month: int, day: int) -> DataFrame:
    return lake_slice(spark.read.parquet(root), cab_type, year, month, day)


def source_table(spark: SparkSession, name: str, tables: dict[str, str] | None = None) -> DataFrame:
    """A catalog table by logical name."""
    known = {**SOURCES, **(tables or {})}
    if name not in known:
        raise KeyError(f"unknown source {name}; known: {', '.join(sorted(known))}")
    return spark.table(known[name])
