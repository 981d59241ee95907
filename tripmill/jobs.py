"""Batch jobs: one month into the lake, one staged file into the final table.

    spark-submit tripmill/jobs.py --cab_type yellow --year 2024 --month 1 \
        --raw_prefix <folder>/ --dest_prefix <lake>/ [--audit <folder>]

Each job writes its stage events to the audit folder if one is given.
"""

from __future__ import annotations

import argparse
import datetime as dt
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.operators.audit import append_audit, audit_event
from tripmill.operators.ingest import ingest_month
from tripmill.operators.load import LoadReport, staged_load
from tripmill.operators.sinks import register_partitions
from tripmill.schema import AUDIT_TYPES, CAB_TYPES, PARTITION_COLUMNS
from tripmill.session import get_session
from tripmill.sources.lake import lake_slice
from tripmill.sources.landing import check_month_arguments, month_path

PIPELINE = "monthly_batch"


@contextmanager
def stage(spark: SparkSession, audit: str | None, pipeline_id: str, name: str) -> Iterator[dict]:
    """Log the start of a stage, then its success or failure.

    The block may put optional audit fields (record_count, s3_output, …) into the yielded
    dict. A failure is logged and raised again.
    """
    outcome: dict = {}

    def log(status: str, **more) -> None:
        if audit:
            now = dt.datetime.now(dt.UTC).replace(tzinfo=None)
            append_audit(audit_event(spark, pipeline_id, name, PIPELINE, "batch", "spark", status, now, **more), audit)

    log("STARTED")
    try:
        yield outcome
    except Exception as error:
        log("FAILED", details={"error": str(error)})
        raise
    log("SUCCEEDED", **outcome)


def monthly_job(
    spark: SparkSession,
    raw_prefix: str,
    lake: str,
    cab_type: str,
    year: int,
    month: int,
    audit: str | None = None,
    table: str | None = None,
    layout: str = "balanced",
    num_files: int | None = None,
) -> int:
    """Ingest one month, register its partitions if a table is named, return its row count.

    The count comes from the footers of the files written, so no row is worked out twice.
    """
    cab_type, year, month = check_month_arguments(cab_type, year, month)
    with stage(spark, audit, f"{cab_type}_tripdata_{year}-{month:02d}", "transform") as outcome:
        ingest_month(spark, raw_prefix, lake, cab_type, year, month, layout=layout, num_files=num_files)
        if table:
            register_partitions(spark, table)
        rows = lake_slice(spark.read.parquet(lake), cab_type, year, month).count()
        outcome.update(
            record_count=rows,
            s3_input=month_path(raw_prefix, cab_type, year, month),
            s3_output=lake,
            details={"partition_by": list(PARTITION_COLUMNS)},
        )
    return rows


def load_job(
    spark: SparkSession, source: str, target: str, cab_type: str, pipeline_id: str, audit: str | None = None
) -> LoadReport:
    with stage(spark, audit, pipeline_id, "load") as outcome:
        report = staged_load(spark, source, target, cab_type)
        outcome.update(record_count=report.staging_rows, s3_input=source, db_table=target)
    return report


def upload_events(parsed: DataFrame, timestamp: dt.datetime) -> DataFrame:
    """Audit rows for parsed landing keys: STARTED for valid names, FAILED for others."""
    valid = F.col("valid")
    known = {
        "pipeline_id": F.col("pipeline_id"),
        "stage": F.lit("transform_start"),
        "pipeline_name": F.lit(PIPELINE),
        "pipeline_type": F.lit("batch"),
        "executor": F.lit("spark"),
        "status": F.when(valid, "STARTED").otherwise("FAILED"),
        "timestamp": F.lit(str(timestamp)),
        "s3_input": F.col("key"),
        "details": F.when(valid, '{"trigger": "file landed"}').otherwise('{"error": "Invalid file name pattern"}'),
    }
    return parsed.select(*[known.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in AUDIT_TYPES.items()])


def parse_arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Ingest one month of trips.")
    parser.add_argument("--cab_type", required=True, type=str.lower, choices=CAB_TYPES)
    parser.add_argument("--year", required=True, type=int)
    parser.add_argument("--month", required=True, type=int)
    parser.add_argument("--raw_prefix", required=True)
    parser.add_argument("--dest_prefix", required=True)
    parser.add_argument("--coalesce", type=int, help="write with so many key-hashed tasks instead of balancing")
    parser.add_argument("--audit")
    parser.add_argument("--table")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse_arguments(argv)
    spark = get_session(f"monthly_{args.cab_type}_{args.year}_{args.month:02d}")
    began = time.time()
    rows = monthly_job(
        spark, args.raw_prefix, args.dest_prefix, args.cab_type, args.year, args.month, args.audit, args.table,
        layout="hash" if args.coalesce else "balanced", num_files=args.coalesce,
    )
    print(f"{rows} rows in {time.time() - began:.3f} seconds")


if __name__ == "__main__":
    main()
