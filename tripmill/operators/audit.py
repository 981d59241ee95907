"""Run audit: stage events, latest status, failure reports."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.schema import AUDIT_TYPES, ddl


def audit_event(
    spark: SparkSession,
    pipeline_id: str,
    stage: str,
    pipeline_name: str,
    pipeline_type: str,
    executor: str,
    status: str,
    timestamp: dt.datetime,
    record_count=None,
    s3_input: str | None = None,
    s3_output: str | None = None,
    db_table: str | None = None,
    details: dict | None = None,
) -> DataFrame:
    """One stage event. Empty optional fields become NULL; a bad record count becomes 0."""
    if record_count is not None:
        try:
            record_count = int(record_count)
        except (TypeError, ValueError):
            record_count = 0
    row = (
        pipeline_id, stage, pipeline_name, pipeline_type, executor, status, timestamp, record_count,
        s3_input or None, s3_output or None, db_table or None,
        json.dumps(details) if details else None,
    )
    return spark.createDataFrame([row], ddl(AUDIT_TYPES))


def append_audit(events: DataFrame, path: str) -> None:
    events.write.mode("append").parquet(path)


def latest_status(audit: DataFrame) -> DataFrame:
    """Newest status of each stage of each run; of events at one instant, the greater status."""
    order = F.struct("timestamp", "status")
    return audit.groupBy("pipeline_id", "stage").agg(
        F.max_by("status", order).alias("status"), F.max("timestamp").alias("timestamp")
    )


def failed_runs(audit: DataFrame) -> DataFrame:
    """Stages whose newest event is a failure."""
    return latest_status(audit).where(F.col("status") == "FAILED")


def stage_report(audit: DataFrame) -> DataFrame:
    """One notice per event: subject, run, month, cab type; details only for failures."""
    run = r"^([a-z]+)_tripdata_(\d{4})-(\d{2})$"
    pid = F.col("pipeline_id")

    def part(i: int):
        return F.coalesce(F.nullif(F.regexp_extract(pid, run, i), F.lit("")), F.lit("N/A"))

    return audit.select(
        F.concat(F.lit("["), F.col("status"), F.lit("] "), pid, F.lit(" at "), F.col("stage")).alias("subject"),
        pid,
        "status",
        F.concat(part(2), F.lit("-"), part(3)).alias("month"),
        part(1).alias("cab_type"),
        F.when(F.col("status") == "FAILED", F.col("details")).alias("details"),
        "timestamp",
    )
