"""Monthly raw files: naming, reading and discovery."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.functions.times import as_of_column
from tripmill.schema import CAB_TYPES, TRIP_TYPES, conform

# Fixed name format of a landed monthly file.
LANDING_KEY = r"^raw/(yellow|green|fhv)_tripdata_(\d{4})-(\d{2})\.parquet$"


def check_month_arguments(cab_type: str, year: int, month: int) -> tuple[str, int, int]:
    cab_type = cab_type.lower()
    if cab_type not in CAB_TYPES:
        raise ValueError(f"cab_type must be one of {', '.join(CAB_TYPES)}: {cab_type}")
    if not 1 <= int(month) <= 12:
        raise ValueError(f"month must be between 1 and 12: {month}")
    return cab_type, int(year), int(month)


def month_path(prefix: str, cab_type: str, year: int, month: int) -> str:
    return f"{prefix}{cab_type}_tripdata_{year}-{month:02d}.parquet"


def read_month(spark: SparkSession, prefix: str, cab_type: str, year: int, month: int) -> DataFrame:
    """One raw month, with the column types of its own footer."""
    cab_type, year, month = check_month_arguments(cab_type, year, month)
    return spark.read.parquet(month_path(prefix, cab_type, year, month))


def read_staging(spark: SparkSession, *paths: str) -> DataFrame:
    """Files to load, cast to the canonical types."""
    return conform(spark.read.parquet(*paths), TRIP_TYPES)


def parse_landing_keys(df: DataFrame, key_col: str = "key") -> DataFrame:
    """Split object keys into cab type, year and month; every input row comes back.

    ``valid`` follows the name pattern alone, which admits months 00 and 13 to 99;
    ``month_in_range`` tells those apart.
    """
    key = F.col(key_col)
    part = [F.nullif(F.regexp_extract(key, LANDING_KEY, i), F.lit("")) for i in (1, 2, 3)]
    parsed = df.select(
        "*",
        part[0].alias("cab_type"),
        part[1].alias("year"),
        part[2].alias("month"),
    ).withColumn("valid", F.col("cab_type").isNotNull())
    name = F.concat(F.col("cab_type"), F.lit("_tripdata_"), F.col("year"), F.lit("-"), F.col("month"))
    return parsed.select(
        "*",
        F.when(F.col("valid"), name)
        .otherwise(F.concat(F.lit("invalid_filename_"), F.coalesce(key, F.lit(""))))
        .alias("pipeline_id"),
        F.coalesce(F.col("month").cast("int").between(1, 12), F.lit(False)).alias("month_in_range"),
    )


def list_files(spark: SparkSession, path: str, modified_after: str | None = None) -> DataFrame:
    """Files under a folder with their modification time. File contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.load(path).select(
        F.col("path").alias("key"), F.col("modificationTime").cast("timestamp_ntz").alias("modified_at")
    )


def new_files(files: DataFrame, ledger: DataFrame, as_of=None, lookback_minutes: int = 5) -> DataFrame:
    """Parquet files changed within the lookback that the ledger does not hold."""
    cutoff = as_of_column(as_of) - F.expr(f"INTERVAL {int(lookback_minutes)} MINUTES")
    recent = files.where(F.col("key").endswith(".parquet") & (F.col("modified_at") >= cutoff))
    done = ledger.select(F.col("pipeline_id").alias("key")).distinct()
    return recent.join(done, "key", "left_anti")
