from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import at, plan_of, rows
from tripmill.operators import load
from tripmill.schema import TRIP_TYPES, ddl
from tripmill.session import conf_set, work_folder

KEYED = "vendorid int, pickup_datetime timestamp_ntz, pulocationid int, dolocationid int, n int"


def keyed(spark, *data):
    return spark.createDataFrame([(v, at(p), pu, do, n) for v, p, pu, do, n in data], KEYED)


def staged(spark, n, vendor=1, start="2024-01-05 00:00:00"):
    """Staged trips, a minute apart."""
    data = [(vendor, at(start) + dt.timedelta(minutes=i), i % 5, i % 3, float(i)) for i in range(n)]
    some = spark.createDataFrame(
        data, "vendorid int, pickup_datetime timestamp_ntz, pulocationid int, dolocationid int, fare_amount double"
    )
    return spark.createDataFrame([], ddl(TRIP_TYPES)).drop("cab_type", "year", "month", "day").unionByName(
        some, allowMissingColumns=True
    )


def test_insert_new_plain_equality(spark):
    target = keyed(spark, (1, "10:00:00", 1, 1, 0), (1, "10:00:00", 1, 1, 0), (None, "10:00:00", 2, 2, 0))
    batch = keyed(
        spark,
        (1, "10:00:00", 1, 1, 1),  # known
        (1, "10:00:00", 1, 2, 2),  # another dropoff
        (None, "10:00:00", 2, 2, 3),  # a NULL matches nothing
        (2, "10:00:00", 1, 1, 4),
        (2, "10:00:00", 1, 1, 5),  # repeats inside the batch stay
    )
    assert [r[-1] for r in rows(load.insert_new(batch, target).select("n"))] == [2, 3, 4, 5]
    assert [r[-1] for r in rows(load.insert_new(batch, target, null_safe=True).select("n"))] == [2, 4, 5]
    assert load.insert_new(batch, target, dedupe_batch=True).count() == 3


def test_drop_repeats_keeps_rows_without_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "trip_id string, n int")
    kept = rows(load.drop_repeats(df, ["trip_id"]))
    assert len(kept) == 3
    assert [r for r in kept if r[0] is None] == [(None, 3), (None, 4)]


def test_insert_new_meets_each_known_key_once(spark):
    """A key that fills the target reaches the join as one row per task."""
    target = keyed(spark, *[(1, "10:00:00", 1, 1, i) for i in range(50)])
    batch = keyed(spark, (1, "10:00:00", 1, 1, 1), (1, "10:00:00", 1, 2, 1))
    new = load.insert_new(batch, target)
    assert new.count() == 1
    plan = plan_of(new)
    assert "LeftAnti" in plan and "LeftSemi" in plan and "NestedLoop" not in plan
    # Spark chooses by size: nothing is sent to all executors that it holds for large.
    with conf_set(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        new = load.insert_new(batch, target)
        assert "Broadcast" not in plan_of(new) and "SortMergeJoin" in plan_of(new)
        assert new.count() == 1


def test_staged_load_twice(spark, tmp_path):
    source, final = f"{tmp_path}/staged", work_folder(spark, "final")
    staged(spark, 40).write.parquet(source)
    first = load.staged_load(spark, source, final, "green")
    assert (first.staging_rows, first.final_row_count) == (40, 40)
    assert load.staged_load(spark, source, final, "green") == first
    more = f"{tmp_path}/more"
    staged(spark, 60).write.parquet(more)
    assert load.staged_load(spark, more, final, "yellow") == load.LoadReport(60, 60)
    assert rows(spark.read.parquet(final).groupBy("cab_type").count()) == [("green", 40), ("yellow", 20)]


def test_staged_load_without_pickup_times(spark, tmp_path):
    source, final = f"{tmp_path}/staged", work_folder(spark, "final")
    staged(spark, 4).withColumn("pickup_datetime", F.lit(None).cast("timestamp_ntz")).write.parquet(source)
    assert load.staged_load(spark, source, final, "green").final_row_count == 4
    assert load.staged_load(spark, source, final, "green").final_row_count == 8


def test_staged_load_refuses_nothing(spark, tmp_path):
    source = f"{tmp_path}/staged"
    staged(spark, 0).write.parquet(source)
    with pytest.raises(load.EmptyStagingError):
        load.staged_load(spark, source, work_folder(spark, "final"), "green")


def test_target_is_cut_to_the_batchs_months(spark, tmp_path):
    source, final = f"{tmp_path}/staged", work_folder(spark, "final")
    staged(spark, 10).write.parquet(source)
    load.staged_load(spark, source, final, "green")
    stray = staged(spark, 1).withColumn("pickup_datetime", F.lit("2002-03-04 05:06:07").cast("timestamp_ntz"))
    batch = staged(spark, 3).unionByName(stray)
    target = spark.read.parquet(final)
    other = target.withColumns({"pickup_datetime": F.lit("2011-01-01").cast("timestamp_ntz"), "pickup_year": F.lit(2011), "pickup_month": F.lit(1)})
    other.write.mode("append").partitionBy("pickup_year", "pickup_month").parquet(final)
    known = load.pickup_months_of(spark.read.parquet(final), batch)
    assert {r.pickup_year for r in known.select("pickup_year").collect()} == {2024}
    plan = plan_of(known)
    assert "dynamicpruning" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(pickup_datetime,2002-03-04T05:06:07)" in plan


def test_ledger(spark):
    files = spark.createDataFrame([("x.parquet",)], "key string")
    path = work_folder(spark, "ledger")
    assert load.read_ledger(spark, path).count() == 0
    load.ledger_entries(files, "streaming", "trips", at("10:00:00")).write.parquet(path)
    entry = load.read_ledger(spark, path).first()
    assert (entry.pipeline_id, entry.status, entry.copied_at) == ("x.parquet", "success", at("10:00:00"))
