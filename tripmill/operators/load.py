"""Loading new rows into a final table, and the ledger of loaded files."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.operators.ingest import align_for_load
from tripmill.operators.sinks import write_lake
from tripmill.schema import LEDGER_TYPES, TRIP_KEY, ddl
from tripmill.sources.landing import read_staging


@dataclass(frozen=True)
class LoadReport:
    staging_rows: int
    final_row_count: int


class EmptyStagingError(RuntimeError):
    """Nothing was staged."""


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def has_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def drop_repeats(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per complete key; rows with a NULL in the key are all kept.

    Incomplete rows get a number of their own as a further key, so they neither meet each
    other nor crowd into one task.
    """
    own = F.when(has_null(keys), F.monotonically_increasing_id())
    return batch.withColumn("__own", own).dropDuplicates([*keys, "__own"]).drop("__own")


def insert_new(
    batch: DataFrame,
    target: DataFrame,
    keys: Sequence[str] = TRIP_KEY,
    null_safe: bool = False,
    dedupe_batch: bool = False,
) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target``.

    By default a key with a NULL matches nothing, so such rows always come back, and
    repeats inside the batch stay.

    Only key columns of the target are read, and they are first cut to keys the batch has
    and to one row per key. So a key that fills a third of the target meets the batch as
    one row, and AQE splits such a key on the batch side. Nothing is forced: where the
    batch's keys are small in bytes, Spark sends them to the scan of the target, and the
    history is not shuffled at all.
    """
    keys = list(keys)
    if dedupe_batch:
        batch = drop_repeats(batch, keys)
    wanted, known = batch.select(*keys).distinct(), target.select(*keys)
    if not null_safe:
        wanted, known = wanted.where(~has_null(keys)), known.where(~has_null(keys))
    wanted = wanted.toDF(*[f"__wanted_{k}" for k in keys])
    met = known.join(
        wanted,
        same_keys(keys, "__wanted_", null_safe),
        "left_semi",
    ).distinct()
    if not null_safe:
        return batch.join(met, keys, "left_anti")
    met = met.toDF(*[f"__met_{k}" for k in keys])
    return batch.join(met, same_keys(keys, "__met_", null_safe), "left_anti")


def same_keys(keys: Sequence[str], prefix: str, null_safe: bool) -> Column:
    def same(key: str) -> Column:
        other = F.col(f"{prefix}{key}")
        return F.col(key).eqNullSafe(other) if null_safe else F.col(key) == other

    return reduce(lambda a, b: a & b, [same(k) for k in keys])


def in_partitions_of(batch: DataFrame, known: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """The part of a sink whose partitions the batch touches, one by one.

    The sink is joined with the batch's distinct partition values, which Spark turns into
    dynamic partition pruning. The first and last value of each column go along as literals:
    they prune as well, and they tell the optimizer that the values select. Rows of partitions
    without a value are compared if the batch has such rows.
    """
    ends = batch.agg(*[F.struct(F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in partitions]).first()
    unknown = has_null(partitions)
    if all(ends[c].low is None for c in partitions):
        return known.where(unknown)
    inside = F.lit(True)
    for c in partitions:
        if ends[c].low is not None:
            inside = inside & F.col(c).between(ends[c].low, ends[c].high)
    touched = batch.select(*partitions).where(inside).distinct()
    met = known.where(inside).join(touched, list(partitions), "left_semi")
    return met.unionByName(known.where(unknown))


def pickup_months_of(target: DataFrame, batch: DataFrame) -> DataFrame:
    """The part of the final table that can hold keys of the batch: its pickup months.

    The pickup time is part of the key and fixes the partition. The batch's distinct months
    are joined with the target, which prunes its partitions one by one, so that a stray old
    pickup adds one month and not all between. First and last pickup prune row groups.
    """
    pickup = F.col("pickup_datetime")
    parts = {"pickup_year": F.year(pickup), "pickup_month": F.month(pickup)}
    months = batch.select(*[c.alias(name) for name, c in parts.items()]).distinct()
    low, high = batch.agg(F.min("pickup_datetime"), F.max("pickup_datetime")).first()
    if low is None:
        return target.limit(0)
    first, last = (F.lit(str(t)).cast("timestamp_ntz") for t in (low, high))
    years = F.col("pickup_year").between(low.year, high.year)
    return target.where(pickup.between(first, last) & years).join(months.where(years), list(parts), "left_semi")


def data_files(spark: SparkSession, folders: Sequence[str]) -> set[str]:
    """Names of the Parquet files in folders; nothing is opened."""
    out = set()
    for folder in folders:
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(place):
            out |= {s.getPath().toString() for s in files.listStatus(place) if s.getPath().getName().endswith(".parquet")}
    return out


def staged_load(spark: SparkSession, source_path: str, target_path: str, cab_type: str) -> LoadReport:
    """Load one staged file into the final table, inserting only new trips.

    The target is laid out by pickup year and month. A load counts the rows of the files it
    wrote from their footers, so a retried task cannot count twice, and keeps that figure
    beside the table: the table's size is the sum of the loads'. One load at a time fills it.
    """
    staging = read_staging(spark, source_path)
    staging_rows = staging.count()
    if staging_rows == 0:
        raise EmptyStagingError(f"no rows staged from {source_path}")
    aligned = align_for_load(staging, cab_type)
    target, counts = read_if_exists(spark, target_path), f"{target_path}.counts"
    before = read_if_exists(spark, counts)
    if before is not None:
        held = before.agg(F.sum("rows")).first()[0]
    else:  # a table that was filled in another way is counted once
        held = 0 if target is None else target.count()
    if target is not None:
        aligned = insert_new(aligned, pickup_months_of(target, aligned), TRIP_KEY)
    pickup = F.col("pickup_datetime")
    rows = aligned.withColumns({"pickup_year": F.year(pickup), "pickup_month": F.month(pickup)})
    months = staging.select(F.year(pickup).alias("y"), F.month(pickup).alias("m")).distinct().collect()
    none = "__HIVE_DEFAULT_PARTITION__"
    touched = [f"{target_path}/pickup_year={r.y if r.y is not None else none}/pickup_month={r.m if r.m is not None else none}" for r in months]
    known = data_files(spark, touched)
    write_lake(rows, target_path, mode="append", partitions=("pickup_year", "pickup_month"))
    files = sorted(data_files(spark, touched) - known)
    written = spark.read.parquet(*files).count() if files else 0
    first = before is None
    added = spark.createDataFrame([(held,), (written,)] if first else [(written,)], "rows bigint")
    added.coalesce(1).write.mode("append").parquet(counts)
    return LoadReport(staging_rows, held + written)


def stream_load_rows(staging: DataFrame, target: DataFrame) -> DataFrame:
    """Staged stream trips not yet loaded, with date parts taken from the pickup time.

    Arrival columns the models read (event, receive and insert times) are carried along.
    """
    pickup = F.col("pickup_datetime")
    return insert_new(staging, target, ["trip_id"]).withColumns(
        {
            "year": F.year(pickup),
            "month": F.month(pickup),
            "day": F.dayofmonth(pickup),
            "hour": F.hour(pickup),
        }
    )


def ledger_entries(files: DataFrame, pipeline_type: str, dataset_name: str, copied_at=None) -> DataFrame:
    """Ledger rows that mark files (column ``key``) as loaded."""
    now = F.localtimestamp() if copied_at is None else F.lit(str(copied_at)).cast("timestamp_ntz")
    return files.select(
        F.col("key").alias("pipeline_id"),
        F.lit(pipeline_type).alias("pipeline_type"),
        F.lit(dataset_name).alias("dataset_name"),
        F.col("key").alias("s3_uri"),
        F.lit("success").alias("status"),
        now.alias("copied_at"),
        F.lit("Loaded").alias("notes"),
    )


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    ledger = read_if_exists(spark, path)
    return spark.createDataFrame([], ddl(LEDGER_TYPES)) if ledger is None else ledger.select(*LEDGER_TYPES)
