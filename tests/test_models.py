from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import at, plan_of, rows
from tripmill.plans import dashboards, marts, models, staging
from tripmill.session import conf_set
from tripmill.workload import queries as q
from tripmill.workload import tables as t

HOURLY = "series string, hour int, trips bigint, fare_total double"


def live(spark, *data):
    return spark.createDataFrame(
        [(at(e), i, z, d, f, p) for e, i, z, d, f, p in data],
        "event_time timestamp_ntz, trip_id string, pickup_zone string, delay_time_minutes double, fare_amount double, passenger_count int",
    )


def test_busiest_keeps_ties_and_null_zone(spark):
    data = [(dt.date(2024, m, 1), z) for m, z in [(1, "A"), (1, "B"), (1, None), (2, "A"), (2, None), (2, None)]]
    tz = spark.createDataFrame(data, "pickup_month date, pickup_zone string")
    got = rows(marts.busiest_zone(tz).select("grain", "pickup_zone", "total_trips", "rnk"))
    assert got == sorted(
        [("overall", None, 3, 1), ("by_month", "A", 1, 1), ("by_month", "B", 1, 1), ("by_month", None, 1, 1), ("by_month", None, 2, 1)],
        key=repr,
    )
    known = rows(marts.busiest_zone(tz, drop_unmatched=True).select("grain", "pickup_zone", "total_trips"))
    assert ("overall", "A", 2) in known and all(z is not None for _, z, _ in known)


def test_busiest_scans_trips_once(spark, folder):
    result = marts.busiest_zone(q.enriched_orders(spark, folder))
    result.collect()
    final = plan_of(result).split("== Initial Plan ==")[0]
    assert "WindowGroupLimit" in final
    assert final.count("lineitem.parquet") == 1 and final.count("ReusedExchange") == 1


def test_zone_join_without_broadcast(spark, folder):
    """A zone table above the threshold is sorted and merged, with the same rows."""
    expected = rows(marts.avg_fare_by_zone(q.enriched_trips(spark, folder)).selectExpr("pickup_zone", "round(avg_fare, 6)"))
    with conf_set(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1"):
        tz = q.enriched_trips(spark, folder)
        assert "SortMergeJoin" in plan_of(tz) and "Broadcast" not in plan_of(tz)
        assert rows(marts.avg_fare_by_zone(tz).selectExpr("pickup_zone", "round(avg_fare, 6)")) == expected
    assert "BroadcastHashJoin" in plan_of(q.enriched_trips(spark, folder))


def test_trip_zone_totals(spark, folder):
    tz = q.enriched_trips(spark, folder)
    assert tz.where("dropoff_at < pickup_at").isEmpty()
    assert marts.monthly_cab_counts(tz).selectExpr("sum(trip_count)").first()[0] == tz.count()


def test_baseline_of_given_day_is_pushed_down(spark, tmp_path):
    lake = f"{tmp_path}/trips"
    t.staged_trips(spark, "/root/testdata/sf0.001").write.parquet(lake)
    tz = models.trip_zone(spark.read.parquet(lake), t.zones(spark, "/root/testdata/sf0.001"))
    plan = plan_of(marts.baseline_hourly(tz, "2024-01-15"))
    assert "GreaterThanOrEqual(pickup_at,2024-01-15T00:00)" in plan
    assert "LessThan(pickup_at,2024-01-16T00:00)" in plan
    assert "tip_amount" not in plan.split("ReadSchema")[1].split(">")[0]


def filters_of(df) -> list[str]:
    """The partition filters of each scan."""
    return [scan.split("]")[0] for scan in plan_of(df).split("PartitionFilters: [")[1:]]


def test_date_bound_marts_read_their_partitions_only(spark, tmp_path):
    small = "/root/testdata/sf0.001"
    lake, sink = f"{tmp_path}/lake", f"{tmp_path}/sink"
    t.trips(spark, small).write.partitionBy("cab_type", "year", "month", "day").parquet(lake)
    t.stream_trips(spark, small).write.partitionBy("year", "month", "day", "hour").parquet(sink)
    tz = models.trip_zone(staging.stg_trips(spark.read.parquet(lake)), t.zones(spark, small))
    whole = q.enriched_trips(spark, small)
    newest = marts.latest_day(whole).first()[0]
    days = marts.partition_days(staging.stg_trips(spark.read.parquet(lake)))
    assert [scan.split(">")[0] for scan in plan_of(days).split("ReadSchema: struct<")[1:]] == [""]
    chosen = marts.top_traffic_day(tz)
    stream = staging.stg_stream(spark.read.parquet(sink))
    for df in (
        marts.baseline_hourly(tz, "2024-01-15"),
        marts.baseline_hourly(tz, newest),
        marts.baseline_hourly(tz),
        marts.baseline_hourly(tz, days=days),
        dashboards.day_trips(tz, chosen),
        dashboards.simulate_today(tz, chosen, "2024-02-01"),
    ):
        assert any(all(part in scan for part in ("year#", "month#", "day#")) for scan in filters_of(df))
    trailing = models.streaming_enriched(stream, t.zones(spark, small), "2024-01-31", 3)
    assert any("make_date" in scan for scan in filters_of(trailing))
    figures = ["hour", "trips", "round(fare_total, 4)"]
    for day in (None, newest, "2024-01-15"):
        assert rows(marts.baseline_hourly(tz, day).selectExpr(*figures)) == rows(marts.baseline_hourly(whole, day).selectExpr(*figures))
    assert trailing.count() == models.streaming_enriched(t.staged_stream(spark, small).drop(*models.PARTS), t.zones(spark, small), "2024-01-31", 3).count()


def test_the_latest_day_reads_the_files_of_one_day(spark, tmp_path):
    """All files of other days are broken, yet the mart is right."""
    small, lake = "/root/testdata/sf0.001", f"{tmp_path}/lake"
    zones = t.zones(spark, small)
    t.trips(spark, small).write.partitionBy("cab_type", "year", "month", "day").parquet(lake)
    table = spark.read.parquet(lake)
    stg = staging.stg_trips(table)
    newest = table.agg(F.max(F.make_date("year", "month", "day"))).first()[0]
    figures = ["hour", "trips", "round(fare_total, 4)"]
    want = rows(marts.baseline_hourly(models.trip_zone(stg, zones)).selectExpr(*figures))
    files = [r[0] for r in table.where(F.make_date("year", "month", "day") < F.lit(newest)).select("_metadata.file_path").distinct().collect()]
    for file in files:
        path = Path(file.removeprefix("file://").removeprefix("file:"))
        raw = path.read_bytes()
        path.write_bytes(raw[:4] + bytes(len(raw) - 4 - int.from_bytes(raw[-8:-4], "little") - 8) + raw[-int.from_bytes(raw[-8:-4], "little") - 8 :])
        (path.parent / f".{path.name}.crc").unlink()
    found = marts.baseline_hourly(models.trip_zone(stg, zones), days=marts.partition_days(stg))
    assert rows(found.selectExpr(*figures)) == want


def test_a_newest_day_without_valid_trips_is_passed_over(spark, tmp_path):
    small, lake = "/root/testdata/sf0.001", f"{tmp_path}/lake"
    trips = t.trips(spark, small)
    last = trips.agg(F.max("pickup_datetime")).first()[0]
    wrong = trips.limit(3).withColumns({
        "pickup_datetime": F.lit(str(last)).cast("timestamp_ntz") + F.expr("INTERVAL 3 DAYS"),
        "dropoff_datetime": F.lit(str(last)).cast("timestamp_ntz"),
    }).withColumns({n: f("pickup_datetime") for n, f in (("year", F.year), ("month", F.month), ("day", F.dayofmonth))})
    trips.unionByName(wrong).write.partitionBy("cab_type", "year", "month", "day").parquet(lake)
    stg = staging.stg_trips(spark.read.parquet(lake))
    tz = models.trip_zone(stg, t.zones(spark, small))
    figures = ["hour", "trips", "round(fare_total, 4)"]
    found = marts.baseline_hourly(tz, days=marts.partition_days(stg)).selectExpr(*figures)
    assert rows(found) == rows(marts.baseline_hourly(tz).selectExpr(*figures)) != []


def test_hourly_marts_sort_once(spark):
    from tripmill.workload.queries import REGISTRY

    assert plan_of(REGISTRY["stream_vs_baseline"](spark, "/root/testdata/sf0.001")).count("Sort [") <= 1


def test_streaming_enriched_has_no_upper_bound(spark):
    stream = spark.createDataFrame(
        [(str(i), at(p), at(p), 1, 1, 1, 1.0, 1, at(p), at(p), at(p)) for i, p in
         enumerate(["2024-01-28 23:59:59", "2024-01-29 00:00:00", "2024-02-05 00:00:00"])],
        "trip_id string, pickup_at timestamp_ntz, dropoff_at timestamp_ntz, pickup_location_id int, dropoff_location_id int, "
        "passenger_count int, fare_amount double, payment_type int, event_time timestamp_ntz, lambda_received_time timestamp_ntz, "
        "inserted_at timestamp_ntz",
    )
    zones = spark.createDataFrame([(2, "Z", "B")], "location_id bigint, zone string, borough string")
    kept = models.streaming_enriched(stream, zones, "2024-01-30 15:00:00", 1)
    assert [(r.trip_id, r.pickup_zone) for r in kept.orderBy("trip_id").collect()] == [("1", None), ("2", None)]
    assert models.streaming_enriched(stream, zones, days_back=None).count() == 3


def test_pivot_refuses_repeated_cells(spark):
    df = spark.createDataFrame([("stream", 1, 5, 1.0), ("stream", 1, 6, 1.0)], HOURLY)
    with pytest.raises(PySparkException, match="several rows"):
        dashboards.pivot_series(df, "trips").collect()
    assert rows(dashboards.pivot_series(df, "trips", repeats="sum")) == [(1, None, 11)]


def test_difference_with_missing_series(spark):
    df = spark.createDataFrame([("stream", 1, 5, 1.0), ("stream", 2, 1, 1.0)], HOURLY)
    assert rows(dashboards.hour_difference(df)) == [(1, 0, 5, 5, "#2ecc71"), (2, 0, 1, 1, "#2ecc71")]
    down = spark.createDataFrame([("baseline", 1, 5, 1.0)], HOURLY)
    assert rows(dashboards.hour_difference(down)) == [(1, 5, 0, -5, "#e74c3c")]
    both = df.unionByName(down)
    wide = dashboards.pivot_series(both, "trips").selectExpr("sum(baseline)", "sum(stream)").first()
    totals = {r.series: r.trips for r in dashboards.series_totals(both).collect()}
    assert (wide[0], wide[1]) == (totals["baseline"], totals["stream"])


def test_kpi_deltas_without_baseline(spark):
    only = spark.createDataFrame([("stream", 1, 5, 10.0)], HOURLY)
    row = dashboards.kpi_deltas(only).first()
    assert (row.trips_stream, row.trips_baseline, row.trips_change_text, row.trips_delta, row.trips_delta_text) == (5, 0, "N/A", None, "N/A")


def test_live_kpis(spark):
    df = live(
        spark,
        ("10:00:00", "1", "B", 1.0, 10.0, 2), ("10:01:00", "2", "A", 2.0, 5.0, None), ("10:02:00", "3", None, None, None, 1),
        ("07:00:00", "0", "C", 9.0, 99.0, 9),
    )
    row = dashboards.live_kpis(df, at("10:02:00")).first()
    assert tuple(row) == (3, 1.5, "A", 15.0, 3, 5.0, 1.5)
    assert tuple(dashboards.live_kpis(df, at("10:02:00"), zone="B").first()) == (1, 1.0, "B", 10.0, 2, 5.0, 0.0)
    assert dashboards.live_kpis(df, at("10:02:00"), zone="All").first().total_trips == 3
    assert tuple(dashboards.live_kpis(df, at("23:00:00")).first()) == (0, 0.0, "N/A", 0.0, 0, 0.0, 0.0)
    assert dashboards.live_kpis(df.where("pickup_zone IS NULL"), at("10:02:00")).first().busiest_zone is None


def test_recent_and_last_hours(spark):
    df = live(spark, *[(f"10:{i:02d}:00", str(i), "Z", 0.0, 0.0, 0) for i in range(30)])
    assert [r.trip_id for r in dashboards.recent(df, 3).collect()] == ["29", "28", "27"]
    assert dashboards.recent(df, 1000, as_of=at("10:29:00"), minutes=10).count() == 11
    hours = spark.createDataFrame([(s, at(f"{h:02d}:00:00"), h) for h in range(5) for s in ("a", "b")], "series string, hour timestamp_ntz, n int")
    assert [(r.n, r.series) for r in dashboards.last_hours(hours, 3).collect()] == [(3, "b"), (4, "a"), (4, "b")]
    assert "TakeOrderedAndProject" in plan_of(dashboards.recent(df, 3))


def test_simulated_today_keeps_the_clock(spark, folder):
    tz = q.enriched_trips(spark, folder)
    day = marts.top_traffic_day(tz)
    moved = dashboards.simulate_today(tz, day, "2024-06-03 12:00:00")
    assert {r[0] for r in moved.selectExpr("to_date(pickup_datetime)").distinct().collect()} == {dt.date(2024, 6, 3)}
    assert moved.count() == day.first().trips
    assert rows(dashboards.day_trips(tz, day).selectExpr("hour(pickup_datetime)", "fare_amount")) == rows(
        moved.selectExpr("hour(pickup_datetime)", "fare_amount")
    )


@pytest.mark.parametrize(("as_of", "zone"), [("2024-01-20 12:00:00", None), ("2024-01-20 12:00:59", "NATION_3"), ("2024-01-20 12:00:00.000001", None)])
def test_kpis_from_minutes(spark, as_of, zone):
    small = "/root/testdata/sf0.001"
    trips = q.live(spark, small)
    figures = dashboards.minute_figures(trips)
    for minutes in (3, 600, 15_000):
        want = dashboards.live_kpis(trips, as_of, minutes, zone)
        assert rows(dashboards.live_kpis_of_minutes(figures, trips, as_of, minutes, zone)) == rows(want)
    assert rows(dashboards.cumulative_of_minutes(figures)) == rows(dashboards.cumulative_trips(trips))
