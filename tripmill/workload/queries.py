"""The registered queries. Each reads whole tables of a folder and returns a DataFrame.

Doubles are rounded here, and only here, so that sums taken in another order compare equal.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.functions.numbers import money, safe_decimal
from tripmill.functions.times import (
    boundary_minutes as boundary,
    elapsed_minutes as elapsed,
    month_label as label_of,
    parse_event_time,
)
from tripmill.jobs import upload_events
from tripmill.operators import audit, ingest, load, quality, reconcile
from tripmill.operators.sinks import create_lake_table, describe_table, insert_lake, register_partitions, table_summary, write_lake
from tripmill.plans import cost, dashboards, marts, models, project, staging
from tripmill.session import configure, work_folder
from tripmill.sources.lake import lake_slice
from tripmill.sources.landing import check_month_arguments, month_path, new_files, parse_landing_keys
from tripmill.streaming import cleanse as cleansing
from tripmill.streaming import hourly
from tripmill.streaming import load as streams
from tripmill.streaming.commits import CommittedSink
from tripmill.streaming.files import whole_files
from tripmill.workload import tables as t
from tripmill.workload.tables import AS_OF

REGISTRY = {}
MONTH_DAYS = 30
LANDED_FILES = 4
MID_MINUTE = "2024-01-31 00:00:42"
NOON_AS_OF = "2024-01-31 18:30:00"


def query(function):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(configure(spark), folder)

    REGISTRY[function.__name__] = run
    return run


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


def enriched_trips(spark, folder, **options):
    return models.trip_zone(t.staged_trips(spark, folder), t.zones(spark, folder), **options)


def enriched_orders(spark, folder):
    return models.trip_zone(t.order_trips(spark, folder), t.zones(spark, folder))


def enriched_stream(spark, folder, days_back=MONTH_DAYS):
    return models.streaming_enriched(t.staged_stream(spark, folder), t.zones(spark, folder), AS_OF, days_back)


# --- staging and models --------------------------------------------------------
@query
def staged_trips(spark, folder):
    return rounded(t.staged_trips(spark, folder), trip_distance=6)


@query
def staged_stream(spark, folder):
    return t.staged_stream(spark, folder).drop(*models.PARTS)


@query
def trip_zone(spark, folder):
    return rounded(enriched_trips(spark, folder).drop(*models.PARTS), trip_distance=6)


@query
def trip_zone_boundary(spark, folder):
    return rounded(enriched_trips(spark, folder, minutes="boundary").drop(*models.PARTS), trip_distance=6)


@query
def order_trip_zone(spark, folder):
    return enriched_orders(spark, folder).select(
        "pickup_at", "dropoff_at", "pickup_location_id", "pickup_zone", "pickup_borough", "cab_type",
        "fare_amount", "pickup_date", "pickup_month", "pickup_month_ym", "pickup_hour", "trip_duration_min",
    )


@query
def streaming_enriched(spark, folder):
    return enriched_stream(spark, folder)


@query
def live_view(spark, folder):
    return models.live_trips(enriched_stream(spark, folder))


@query
def ingest_lag(spark, folder):
    return enriched_stream(spark, folder).groupBy("pickup_date").agg(
        F.round(F.avg("delay_time_seconds"), 6).alias("avg_delay_seconds"),
        F.round(F.avg("delay_time_minutes"), 6).alias("avg_delay_minutes"),
        F.max("delay_time_seconds").alias("max_delay_seconds"),
    )


# --- marts -----------------------------------------------------------------------
@query
def avg_fare_by_zone(spark, folder):
    return rounded(marts.avg_fare_by_zone(enriched_trips(spark, folder)), avg_fare=6)


@query
def avg_fare_by_zone_orders(spark, folder):
    return rounded(marts.avg_fare_by_zone(enriched_orders(spark, folder)), avg_fare=4)


@query
def avg_passengers_by_cab(spark, folder):
    return rounded(marts.avg_passengers_by_cab(enriched_trips(spark, folder)), avg_passenger_count=6)


@query
def avg_duration_by_cab_month(spark, folder):
    return rounded(marts.avg_duration_by_cab_month(enriched_orders(spark, folder)), avg_trip_duration_min=4)


@query
def monthly_cab_counts(spark, folder):
    return marts.monthly_cab_counts(enriched_orders(spark, folder))


@query
def busiest_zone(spark, folder):
    return marts.busiest_zone(enriched_trips(spark, folder))


@query
def busiest_zone_orders(spark, folder):
    return marts.busiest_zone(enriched_orders(spark, folder))


@query
def busiest_known_zone(spark, folder):
    return marts.busiest_zone(enriched_orders(spark, folder), drop_unmatched=True)


def trip_days(spark, folder):
    return marts.partition_days(t.staged_trips(spark, folder))


def hours(df):
    return rounded(df, fare_total=2, avg_passenger_count=6)


@query
def streaming_hourly(spark, folder):
    return hours(marts.hourly(enriched_stream(spark, folder))).orderBy("hour")


@query
def baseline_hourly(spark, folder):
    tz = enriched_trips(spark, folder)
    return hours(marts.baseline_hourly(tz, days=trip_days(spark, folder))).orderBy("hour")


@query
def baseline_hourly_param(spark, folder):
    return hours(marts.baseline_hourly(enriched_trips(spark, folder), "2024-01-15")).orderBy("hour")


def both_hourly(spark, folder):
    tz = enriched_trips(spark, folder)
    return marts.stream_vs_baseline(
        marts.hourly(enriched_stream(spark, folder)), marts.baseline_hourly(tz, days=trip_days(spark, folder))
    )


@query
def stream_vs_baseline(spark, folder):
    return hours(both_hourly(spark, folder)).orderBy("hour", "series")


@query
def daily_streaming_trips(spark, folder):
    return rounded(marts.daily_streaming_trips(enriched_stream(spark, folder)), fare_total=2)


@query
def top_traffic_day(spark, folder):
    return marts.top_traffic_day(enriched_trips(spark, folder))


def source_views(spark, folder) -> dict[str, str]:
    """The tables as catalog sources; logical names and the views behind them."""
    zone = t.zones(spark, folder).withColumnRenamed("location_id", "locationid")
    sources = {
        "trip_data": t.trips(spark, folder),
        "taxi_zone_lookup": zone,
        "taxi_streaming_trips": t.stream_trips(spark, folder),
    }
    for name, df in sources.items():
        df.createOrReplaceTempView(f"source_{name}")
    return {name: f"source_{name}" for name in sources}


@query
def published_marts(spark, folder):
    """All models published over catalog sources, and a mart read by SQL."""
    project.build(spark, source_views(spark, folder), AS_OF, MONTH_DAYS)
    return spark.sql(
        "SELECT series, hour, trips, round(fare_total, 2) AS fare_total FROM mart_stream_vs_baseline ORDER BY hour, series"
    )


# --- dashboards --------------------------------------------------------------------
def hour_of_day_series(spark, folder, days_back=MONTH_DAYS):
    stream = marts.daily_streaming_trips(enriched_stream(spark, folder, days_back))
    return dashboards.hour_series(stream, marts.baseline_hourly(enriched_trips(spark, folder)))


@query
def hour_compare_pivot(spark, folder):
    return dashboards.pivot_series(both_hourly(spark, folder), "trips").orderBy("hour")


@query
def fare_pivot(spark, folder):
    wide = dashboards.pivot_series(both_hourly(spark, folder), "fare_total")
    return rounded(wide, baseline=2, stream=2).orderBy("hour")


@query
def newest_hours(spark, folder):
    return hours(dashboards.recent(both_hourly(spark, folder), 10, "hour", ("series",)))


@query
def stream_series(spark, folder):
    return rounded(dashboards.one_series(hour_of_day_series(spark, folder), "stream"), fare_total=2)


@query
def hour_difference_color(spark, folder):
    return dashboards.hour_difference(hour_of_day_series(spark, folder), repeats="sum").orderBy("hour")


@query
def hour_difference_last_day(spark, folder):
    return dashboards.hour_difference(hour_of_day_series(spark, folder, days_back=1)).orderBy("hour")


@query
def kpi_deltas(spark, folder):
    return rounded(
        dashboards.kpi_deltas(hour_of_day_series(spark, folder)),
        fare_stream=2, fare_baseline=2, trips_change_pct=4, fare_change_pct=4,
    )


@query
def series_totals(spark, folder):
    return rounded(dashboards.series_totals(hour_of_day_series(spark, folder)), fare_total=2)


def live(spark, folder):
    return models.live_trips(enriched_stream(spark, folder))


@query
def live_kpis(spark, folder):
    return dashboards.live_kpis(live(spark, folder), AS_OF)


@query
def live_kpis_month(spark, folder):
    return dashboards.live_kpis(live(spark, folder), AS_OF, minutes=MONTH_DAYS * 1440)


@query
def live_kpis_zone(spark, folder):
    return dashboards.live_kpis(live(spark, folder), AS_OF, minutes=MONTH_DAYS * 1440, zone="NATION_3")


def kept_minutes(spark, folder):
    """Figures per minute and zone as the stream keeps them."""
    sink = work_folder(spark, "minutes")
    stream = staging.stg_stream(t.as_stream_trips(t.events_stream(spark, folder)))
    rows = models.streaming_enriched(stream, t.zones(spark, folder), days_back=None)
    hourly.run_minutes(hourly.stream_minutes(rows), sink, work_folder(spark, "checkpoint")).awaitTermination()
    return hourly.read_minutes(spark, sink)


@query
def live_kpis_of_minutes(spark, folder):
    """A window that begins inside a minute."""
    return dashboards.live_kpis_of_minutes(kept_minutes(spark, folder), live(spark, folder), MID_MINUTE, minutes=20 * 1440)


@query
def cumulative_of_minutes(spark, folder):
    return dashboards.cumulative_of_minutes(kept_minutes(spark, folder))


@query
def cumulative_per_minute(spark, folder):
    return dashboards.cumulative_trips(live(spark, folder))


@query
def recent_trips(spark, folder):
    return dashboards.recent(live(spark, folder), 10)


@query
def recent_trips_1000(spark, folder):
    return dashboards.recent(live(spark, folder), 1000, as_of=AS_OF, minutes=7 * 1440)


@query
def last_48_hours(spark, folder):
    return hours(dashboards.last_hours(both_hourly(spark, folder)))


@query
def zone_list(spark, folder):
    return dashboards.zone_list(live(spark, folder))


def two_days(spark, folder):
    """The busiest day moved to the date of ``NOON_AS_OF``, and the same day as it was."""
    tz = enriched_trips(spark, folder)
    day = marts.top_traffic_day(tz)
    return dashboards.simulate_today(tz, day, NOON_AS_OF), dashboards.day_trips(tz, day)


@query
def simulated_today(spark, folder):
    return two_days(spark, folder)[0]


@query
def local_hour_compare(spark, folder):
    today, baseline = two_days(spark, folder)
    return rounded(
        dashboards.local_hour_compare(today, baseline, NOON_AS_OF), fare_total_today=2, fare_total_baseline=2
    )


@query
def current_hour_kpis(spark, folder):
    today, baseline = two_days(spark, folder)
    return rounded(
        dashboards.current_hour_kpis(today, baseline, NOON_AS_OF),
        today_fare=2, baseline_fare=2, today_passengers=6, baseline_passengers=6,
    )


# --- ingest and load ------------------------------------------------------------------
def lake_columns(df):
    return df.drop("trip_id", "k", "event_type")


@query
def month_filter(spark, folder):
    return ingest.restrict_month(t.order_trips(spark, folder), 1998, 3, "pickup_at").select(
        "pickup_at", "dropoff_at", "fare_amount", "cab_type"
    )


def raw_month(spark, folder, cab_type):
    """Trips of one cab type in the shape of a raw file: its own time columns, mixed case."""
    rows = lake_columns(t.trips(spark, folder)).where(F.col("cab_type") == cab_type)
    rows = rows.drop("cab_type", "year", "month", "day").withColumnsRenamed(
        {"vendorid": "VendorID", "pulocationid": "PULocationID", "dolocationid": "DOLocationID"}
    )
    prefix = {"yellow": "tpep_", "green": "lpep_"}.get(cab_type, "")
    return rows.withColumnsRenamed(
        {c: f"{prefix}{c}" for c in ("pickup_datetime", "dropoff_datetime")}
    )


def monthly(spark, folder):
    fhv = raw_month(spark, folder, "fhv").drop("trip_distance", "fare_amount", "passenger_count")
    raw = {
        "yellow": raw_month(spark, folder, "yellow"),
        "green": raw_month(spark, folder, "green"),
        "fhv": fhv,
    }
    yellow, green, other = (ingest.monthly_rows(df, cab, 2024, 1) for cab, df in raw.items())
    return yellow.unionByName(green).unionByName(other)


@query
def partition_columns(spark, folder):
    return rounded(ingest.monthly_rows(raw_month(spark, folder, "yellow"), "yellow", 2024, 1), trip_distance=6)


@query
def fhv_null_fill(spark, folder):
    raw = raw_month(spark, folder, "fhv").drop("trip_distance", "fare_amount", "passenger_count")
    return ingest.standardize(raw, "fhv")


@query
def schema_align(spark, folder):
    trips = t.trips(spark, folder)
    aligned = [
        ingest.align_for_load(trips.where(F.col("cab_type") == cab), cab) for cab in ("yellow", "green")
    ]
    return rounded(aligned[0].unionByName(aligned[1]), trip_distance=6)


@query
def month_job(spark, folder):
    """A raw month file, found by its name and written as a lake with a fixed number of tasks."""
    prefix, lake = f"{work_folder(spark, 'raw')}/", work_folder(spark, "lake")
    raw = raw_month(spark, folder, "yellow").withColumn("_spark_metadata", F.lit("x"))
    raw.write.parquet(month_path(prefix, "yellow", 2024, 1))
    ingest.ingest_month(spark, prefix, lake, "Yellow", 2024, 1, layout="hash", num_files=4)
    rows = spark.read.parquet(lake)
    return rows.groupBy("cab_type", "year", "month", "day").agg(F.count("*").alias("trips")).withColumn(
        "columns", F.lit(",".join(sorted(rows.columns)))
    )


@query
def repaired_partitions(spark, folder):
    """Partitions of a lake written past the catalog, once the table has been repaired."""
    lake, table = work_folder(spark, "lake"), f"lake_{uuid.uuid4().hex}"
    write_lake(monthly(spark, folder), lake)
    create_lake_table(spark, table, lake)
    try:
        known = [r[0] for r in register_partitions(spark, table).collect()]  # one a day and cab type
        kinds = describe_table(spark, table).where("col_name = 'Type'").first()["data_type"]
    finally:
        spark.sql(f"DROP TABLE {table}")
    return spark.createDataFrame([(p, kinds) for p in known], "partition string, kind string")


@query
def inserted_partitions(spark, folder):
    """A lake filled through its table, the first half of the month twice; nothing is repaired."""
    lake, table = work_folder(spark, "lake"), f"lake_{uuid.uuid4().hex}"
    create_lake_table(spark, table, lake)
    try:
        rows = monthly(spark, folder)
        for part in (rows.where(F.col("day") <= 15), rows):
            insert_lake(part, table)
        summary = table_summary(spark, table).first()
        found = spark.read.parquet(lake).groupBy("cab_type", "day").agg(F.count("*").alias("trips"))
    finally:
        spark.sql(f"DROP TABLE {table}")
    return found.select("*", F.lit(summary["kind"]).alias("kind"), F.lit(summary["n_partitions"]).cast("bigint").alias("n_partitions"))


@query
def lake_days(spark, folder):
    """All months' rows written as a lake; its files per partition, read back."""
    lake = work_folder(spark, "lake")
    write_lake(monthly(spark, folder), lake)
    return spark.read.parquet(lake).groupBy("cab_type", "year", "month", "day").agg(
        F.count("*").alias("trips"), F.round(F.sum("fare_amount"), 2).alias("fare_total")
    )


@query
def lake_rerun(spark, folder):
    """A repeated monthly write leaves the lake as it was; one cab type read by pruning."""
    lake = work_folder(spark, "lake")
    for _ in range(2):
        write_lake(monthly(spark, folder), lake)
    rows = lake_slice(spark.read.parquet(lake), "green", 2024, 1)
    return rounded(rows.select("pickup_datetime", "dropoff_datetime", "fare_amount", "trip_distance", "day"), trip_distance=6)


@query
def default_fill(spark, folder):
    filled = ingest.fill_defaults(t.trips(spark, folder))
    return filled.select("trip_id", "passenger_count", "fare_amount", "payment_type", "pulocationid", "dolocationid")


def load_sides(df, time_col="pickup_datetime"):
    """Rows loaded up to the 20th, and a batch that starts on the 15th."""
    cut, first = (F.lit(f"2024-01-{d} 00:00:00").cast("timestamp_ntz") for d in (20, 15))
    return df.where(F.col(time_col) < cut), df.where(F.col(time_col) >= first)


@query
def dedup_load_composite(spark, folder):
    """Some batch rows lack a vendor, so they match nothing and are inserted."""
    target, batch = load_sides(t.trips(spark, folder))
    batch = batch.withColumn("vendorid", F.when(F.col("event_type") != "signup", F.col("vendorid")))
    return load.insert_new(batch, target).select("trip_id", "vendorid", "pickup_datetime", "pulocationid", "dolocationid")


@query
def dedup_load_null_safe(spark, folder):
    target, batch = load_sides(t.trips(spark, folder))
    vendor = F.when(F.col("event_type") != "signup", F.col("vendorid"))
    target, batch = target.withColumn("vendorid", vendor), batch.withColumn("vendorid", vendor)
    return load.insert_new(batch, target, null_safe=True).select("trip_id", "vendorid", "pickup_datetime")


@query
def dedup_load_trip_id(spark, folder):
    target, batch = load_sides(t.stream_trips(spark, folder))
    return load.stream_load_rows(batch, target)


@query
def staged_load(spark, folder):
    """Two overlapping stagings loaded in turn; the final table."""
    final = work_folder(spark, "final")
    yellow = lake_columns(t.trips(spark, folder)).where(F.col("cab_type") == "yellow")
    for part in load_sides(yellow):
        staging_path = work_folder(spark, "staging")
        part.write.parquet(staging_path)
        load.staged_load(spark, staging_path, final, "yellow")
    return spark.read.parquet(final).groupBy("vendorid", F.to_date("pickup_datetime").alias("pickup_date")).agg(
        F.count("*").alias("trips"), F.round(F.sum("fare_amount"), 2).alias("fare_total")
    )


@query
def load_report(spark, folder):
    """What each load reports; a staging without rows is refused."""
    final, reports = work_folder(spark, "final"), []
    yellow = lake_columns(t.trips(spark, folder)).where(F.col("cab_type") == "yellow")
    for step, part in enumerate([*load_sides(yellow), yellow.limit(0)]):
        path = work_folder(spark, "staging")
        part.write.parquet(path)
        try:
            report = load.staged_load(spark, path, final, "yellow")
            reports.append((step, report.staging_rows, report.final_row_count, False))
        except load.EmptyStagingError:
            reports.append((step, 0, None, True))
    return spark.createDataFrame(reports, "step int, staging_rows bigint, final_row_count bigint, refused boolean")


REFUSALS = {
    "month 13": lambda spark, raw: check_month_arguments("yellow", 2024, 13),
    "unknown cab type": lambda spark, raw: check_month_arguments("boat", 2024, 1),
    "no pickup column": lambda spark, raw: ingest.standardize(raw.drop("tpep_pickup_datetime"), "yellow"),
    "columns alike": lambda spark, raw: ingest.lower_columns(raw.select("*", F.lit(1).alias("TRIP_distance"))),
    "empty staging": lambda spark, raw: refused_staging(spark, raw.limit(0)),
    "no refusal": lambda spark, raw: ingest.standardize(raw, "yellow"),
}


def refused_staging(spark, raw):
    path = work_folder(spark, "staging")
    ingest.standardize(raw, "yellow").write.parquet(path)
    return load.staged_load(spark, path, work_folder(spark, "final"), "yellow")


@query
def refused_input(spark, folder):
    """Inputs that a load refuses, by the kind of error, beside the rows that each was given."""
    raw = raw_month(spark, folder, "yellow")
    refused = []
    for name, attempt in REFUSALS.items():
        try:
            attempt(spark, raw)
            refused.append((name, None))
        except (ValueError, load.EmptyStagingError) as error:
            refused.append((name, type(error).__name__))
    cases = spark.createDataFrame(refused, "input string, error string")
    return cases.select("*", raw.agg(F.count("*")).scalar().alias("rows"))


@query
def filename_parse(spark, folder):
    """Object keys named after orders, with wrong prefixes, cab types, months and endings."""
    cab = F.when(F.col("o_orderstatus") == "O", "yellow").when(F.col("o_orderstatus") == "F", "green").otherwise("fhv")
    priority, day = F.substring("o_orderpriority", 1, 1), F.col("o_orderdate")
    month = F.lpad((F.month(day) + F.when(priority == "2", 12).otherwise(0)).cast("string"), 2, "0")
    key = F.concat(
        F.when(priority == "1", "in/").otherwise("raw/"), cab, F.lit("_tripdata_"), F.year(day).cast("string"),
        F.lit("-"), month, F.when(priority == "3", ".csv").otherwise(".parquet"),
    )
    return parse_landing_keys(t.table(spark, folder, "orders").select("o_orderkey", key.alias("key")))


@query
def upload_audit(spark, folder):
    """Audit rows for the landed file names."""
    return upload_events(filename_parse(spark, folder), AS_OF).select("pipeline_id", "stage", "status", "timestamp", "s3_input", "details")


@query
def new_files_ledger(spark, folder):
    """Events as landed files; views are in the ledger already, errors are no Parquet."""
    ending = F.when(F.col("event_type") == "error", ".json").otherwise(".parquet")
    key = F.concat(F.lit("landing/part-"), F.col("event_id"), ending)
    files = t.table(spark, folder, "events").select(key.alias("key"), F.col("ts").alias("modified_at"), "event_type")
    loaded = files.where(F.col("event_type") == "view").select("key")
    ledger = load.ledger_entries(loaded, "streaming", "streaming_trips", AS_OF)
    return new_files(files.drop("event_type"), ledger, AS_OF, lookback_minutes=20 * 1440)


# --- checks and audit -----------------------------------------------------------------
@query
def quality_not_null(spark, folder):
    trips = t.staged_trips(spark, folder)
    return quality.run_checks(trips, [quality.NotNull(c) for c in ("pickup_at", "dropoff_at", "passenger_count", "fare_amount")])


@query
def quality_accepted(spark, folder):
    trips = t.staged_trips(spark, folder)
    return quality.run_checks(
        trips, [quality.Accepted("store_and_fwd_flag", ("Y", "N")), quality.Accepted("cab_type", ("yellow", "green"))]
    )


@query
def quality_unique(spark, folder):
    stream = t.staged_stream(spark, folder)
    return quality.run_checks(stream, [quality.Unique(c) for c in ("trip_id", "event_time", "pickup_location_id")])


@query
def quality_relationships(spark, folder):
    zones = t.zones(spark, folder)
    columns = ("pickup_location_id", "dropoff_location_id")
    return quality.run_checks(t.staged_trips(spark, folder), [quality.Relationship(c, zones, "location_id") for c in columns])


@query
def quality_trips(spark, folder):
    return quality.run_checks(t.staged_trips(spark, folder), quality.trip_checks(t.zones(spark, folder)))


@query
def quality_stream(spark, folder):
    return quality.run_checks(t.staged_stream(spark, folder), quality.stream_checks(t.zones(spark, folder)))


@query
def quality_zones(spark, folder):
    return quality.run_checks(t.zones(spark, folder), quality.zone_checks())


@query
def quality_enriched(spark, folder):
    return quality.run_checks(enriched_trips(spark, folder), quality.enriched_checks())


@query
def quality_marts(spark, folder):
    """The value checks of all marts over orders, some of which have no zone."""
    tz = enriched_orders(spark, folder)
    frames = [
        marts.avg_fare_by_zone(tz),
        marts.monthly_cab_counts(tz),
        marts.avg_passengers_by_cab(enriched_trips(spark, folder)),
        marts.avg_duration_by_cab_month(tz),
    ]
    checked = [
        quality.run_checks(mart, quality.mart_checks(name)).withColumn("mart", F.lit(name))
        for name, mart in zip(quality.MART_COLUMNS, frames, strict=True)
    ]
    return reduce(DataFrame.unionByName, checked)


@query
def quality_busiest(spark, folder):
    return quality.run_checks(marts.busiest_zone(enriched_orders(spark, folder)), quality.busiest_checks())


@query
def quality_refreshed(spark, folder):
    """Checks kept by day: the month without its 15th, then that day alone; failures as of then."""
    path, zones = work_folder(spark, "checks"), t.zones(spark, folder)
    trips = t.staged_trips(spark, folder)
    days = ["pickup_year", "pickup_month", "pickup_day"]
    late = F.col("pickup_day") == 15
    checks = [*quality.trip_checks(zones), quality.Unique("pickup_at"), quality.NotNull("passenger_count")]
    quality.refresh_checks(trips.where(~late), checks, path, days)
    return quality.refresh_checks(trips, checks, path, days, trips.where(late).select(*days))


@query
def freshness(spark, folder):
    return quality.freshness(t.stream_trips(spark, folder), as_of=AS_OF)


@query
def sanity_share(spark, folder):
    return quality.sanity_share(t.order_trips(spark, folder))


@query
def reconcile_daily(spark, folder):
    """The right copy stopped on the evening of the 28th and lacks the days after."""
    left = t.trips(spark, folder)
    right = left.where(F.col("pickup_datetime") < F.lit("2024-01-28 18:00:00").cast("timestamp_ntz"))
    return reconcile.reconcile(left, right)


def audit_events(spark, folder):
    """Events as stage events: stages by type, status by ``k``."""
    k = F.col("k")
    return t.with_k(t.table(spark, folder, "events")).select(
        F.concat(
            t.cab_type_of(F.col("user_id") % 3), F.lit("_tripdata_2024-"),
            F.lpad((F.col("user_id") % 12 + 1).cast("string"), 2, "0"),
        ).alias("pipeline_id"),
        F.col("event_type").alias("stage"),
        F.when(k < 50, "STARTED").when(k < 90, "SUCCEEDED").otherwise("FAILED").alias("status"),
        F.col("ts").alias("timestamp"),
        F.col("props").alias("details"),
    )


@query
def audit_latest(spark, folder):
    return audit.latest_status(audit_events(spark, folder))


@query
def failed_runs(spark, folder):
    return audit.failed_runs(audit_events(spark, folder))


@query
def stage_report(spark, folder):
    return audit.stage_report(audit_events(spark, folder))


# --- cost --------------------------------------------------------------------------------
@query
def credit_cost(spark, folder):
    return cost.credit_cost(
        t.query_history(spark, folder), t.query_attribution(spark, folder), t.chosen_queries(spark, folder)
    )


def usage_inputs(spark, folder):
    history, ids = t.query_history(spark, folder), t.chosen_queries(spark, folder)
    selected = cost.selected_queries(history, ids)
    minutes = cost.billed_minutes(t.metering(spark, folder), selected)
    span = cost.time_span(minutes, "minute_start", "minute_end")
    return selected, cost.minute_concurrency(minutes, history, ids, span), span


@query
def usage_overlap(spark, folder):
    return usage_inputs(spark, folder)[1]


@query
def usage_exact_share(spark, folder):
    return rounded(cost.exact_shares(*usage_inputs(spark, folder)), rpu_seconds_exact=6)


@query
def usage_idle_match(spark, folder):
    selected, concurrency, _ = usage_inputs(spark, folder)
    return cost.idle_matches(cost.idle_minutes(concurrency), selected)


@query
def usage_cost(spark, folder):
    return rounded(
        cost.usage_cost(t.query_history(spark, folder), t.metering(spark, folder), t.chosen_queries(spark, folder)),
        rpu_seconds_attributed=6,
    )


# --- functions ---------------------------------------------------------------------------
@query
def boundary_minutes(spark, folder):
    start, end = F.col("pickup_datetime"), F.col("dropoff_datetime")
    return t.trips(spark, folder).select(
        "trip_id", elapsed(start, end).alias("elapsed_min"), boundary(start, end).alias("boundary_min")
    )


@query
def month_label(spark, folder):
    orders = t.table(spark, folder, "orders")
    return orders.groupBy(label_of(F.col("o_orderdate")).alias("month_ym")).agg(F.count("*").alias("orders"))


def offset_texts(spark, folder):
    """Event times as text: with and without fraction, offsets in three styles, or no time at all."""
    k, kind = F.col("k"), F.col("event_type")
    ending = (
        F.when(kind == "view", "+00:00").when(kind == "click", "+0530").when(kind == "signup", "Z")
        .when(kind == "purchase", "-08:00").otherwise("")
    )
    text = F.concat(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.when(k < 50, ".250000").otherwise(""), ending
    )
    return t.with_k(t.table(spark, folder, "events")).select("event_id", text.alias("text"))


@query
def event_time_parse(spark, folder):
    text = F.col("text")
    return offset_texts(spark, folder).select(
        "event_id",
        parse_event_time(text).alias("wall_clock"),
        parse_event_time(text, "utc").alias("utc"),
    )


@query
def safe_numbers(spark, folder):
    """Quantities as text that is not always a number, and fares as money."""
    quantity, price = F.col("l_quantity"), F.col("l_extendedprice")
    text = F.when(F.col("l_returnflag") == "R", "n/a").otherwise(quantity.cast("string"))
    return t.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber",
        safe_decimal(text).cast("double").alias("record_count"),
        money(price).alias("fare_money"),
    )


# --- streams -----------------------------------------------------------------------------
def cleansed(spark, folder):
    return cleansing.cleanse(t.as_envelopes(t.table(spark, folder, "events")), AS_OF)


@query
def cleanse_good(spark, folder):
    return cleansing.good_rows(cleansed(spark, folder))


@query
def cleanse_bad(spark, folder):
    return cleansing.failed_rows(cleansed(spark, folder)).select("recordId", "result", "error")


@query
def cleanse_delivery(spark, folder):
    """Every output record: the members of the re-encoded ones, the untouched data of the others."""
    records = cleansing.delivery_records(cleansed(spark, folder))
    text = F.when(F.col("result") == "Ok", F.unbase64("data").cast("string"))

    def member(name: str):
        value = F.regexp_extract(text, f'"{name}":("[^"]*"|[^,}}]*)', 1)
        return F.when(F.col("result") == "Ok", value).alias(name)

    names = [c for c in cleansing.PAYLOAD if c != "fare_amount"]
    return records.select(
        "recordId",
        "result",
        *[member(c) for c in names],
        member("fare_amount").cast("double").alias("fare_amount"),
        F.array_join(F.regexp_extract_all(text, F.lit('"([a-z_]+)":'), 1), ",").alias("members"),
        F.col("year").alias("key_year"),
        F.col("hour").alias("key_hour"),
        F.when(F.col("result") != "Ok", F.col("data")).alias("data"),
    )


def run_cleanse(spark, folder):
    sink, bad = work_folder(spark, "trips"), work_folder(spark, "bad")
    raw = t.as_envelopes(t.events_stream(spark, folder))
    streams.run_stream(
        raw, sink, bad, work_folder(spark, "checkpoint"), received_at=AS_OF, inserted_at=AS_OF
    ).awaitTermination()
    return sink, bad


@query
def stream_cleanse_load(spark, folder):
    return CommittedSink(spark, run_cleanse(spark, folder)[0]).read()


@query
def stream_dead_letters(spark, folder):
    sink, bad = run_cleanse(spark, folder)
    return CommittedSink(spark, sink).read(bad).select("recordId", "result", "error")


def delivered_twice(spark, folder):
    """The trip stream with every row delivered twice."""
    once = t.as_stream_trips(t.events_stream(spark, folder))
    return once.unionByName(t.as_stream_trips(t.events_stream(spark, folder)))


def landed_twice(spark, folder) -> str:
    """The stream trips landed in two goes of ``LANDED_FILES`` files that share five days."""
    landing = work_folder(spark, "landing")
    for part in load_sides(t.stream_trips(spark, folder)):
        part.repartition(LANDED_FILES).write.mode("append").parquet(landing)
    return landing


@query
def stream_dedup(spark, folder):
    """Two micro-batches, the second of which brings rows that the sink holds."""
    sink, landing = work_folder(spark, "trips"), landed_twice(spark, folder)
    files = streams.file_stream(spark, landing, t.stream_trips(spark, folder).schema, max_files=LANDED_FILES)
    streams.run_keyed_load(files.drop("source_file"), sink, work_folder(spark, "checkpoint")).awaitTermination()
    return CommittedSink(spark, sink).read().select("trip_id", "pickup_datetime", "fare_amount", "year", "month", "day", "hour")


@query
def stream_dedup_bounded(spark, folder):
    sink = work_folder(spark, "trips")
    rows = streams.dedup_within(delivered_twice(spark, folder), delay="40 days").select("trip_id", "fare_amount")
    writer = rows.writeStream.format("parquet").option("path", sink)
    streams.start(writer, work_folder(spark, "checkpoint"), once=True).awaitTermination()
    return spark.read.parquet(sink)


@query
def stream_hourly_window(spark, folder):
    sink = work_folder(spark, "hours")
    stream = staging.stg_stream(t.as_stream_trips(t.events_stream(spark, folder)))
    hourly.run_hourly(hourly.stream_hourly(stream), sink, work_folder(spark, "checkpoint")).awaitTermination()
    return hours(hourly.read_hours(spark, sink))


@query
def stream_static_join(spark, folder):
    sink = work_folder(spark, "enriched")
    stream = staging.stg_stream(t.as_stream_trips(t.events_stream(spark, folder)))
    rows = models.streaming_enriched(stream, t.zones(spark, folder), days_back=None)
    writer = rows.writeStream.format("parquet").option("path", sink)
    streams.start(writer, work_folder(spark, "checkpoint"), once=True).awaitTermination()
    return spark.read.parquet(sink).select(
        "trip_id", "pickup_zone", "pickup_borough", "pickup_date", "trip_duration_min", "delay_time_minutes"
    )


@query
def stream_file_load(spark, folder):
    """Two goes of landed files with rows in common, one per micro-batch; the trips with what the ledger says."""
    landing, (sink, ledger) = landed_twice(spark, folder), (work_folder(spark, n) for n in ("trips", "ledger"))
    files = streams.file_stream(spark, landing, t.stream_trips(spark, folder).schema, max_files=LANDED_FILES)
    streams.run_file_load(files, sink, ledger, work_folder(spark, "checkpoint")).awaitTermination()
    trips = CommittedSink(spark, sink)
    entries = trips.read(ledger).agg(F.count("*").alias("files_in_ledger")).first()[0]
    return trips.read().select("trip_id", "pickup_datetime", "fare_amount").withColumn(
        "files_in_ledger", F.lit(entries).cast("bigint")
    )


def land_broken(spark, landing: str) -> None:
    """A landed file that ends too early."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{landing}/part-broken.parquet")
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place)
    out.write(bytearray(b"PAR1 and no footer"))
    out.close()


@query
def stream_tolerant_load(spark, folder):
    """Landed files with a broken one among them: trips, ledger and failures, each with its side."""
    landing = landed_twice(spark, folder)
    land_broken(spark, landing)
    sink, ledger, failures = (work_folder(spark, n) for n in ("trips", "ledger", "failures"))
    schema = t.stream_trips(spark, folder).schema
    files = whole_files(spark, landing, max_files=LANDED_FILES)
    streams.run_tolerant_file_load(files, schema, sink, ledger, failures, work_folder(spark, "checkpoint")).awaitTermination()
    trips = CommittedSink(spark, sink)
    none = F.lit(None).cast("double")
    parts = [
        trips.read().select(F.lit("trip").alias("side"), "trip_id", "fare_amount"),
        trips.read(ledger).select(F.lit("loaded file").alias("side"), F.lit(None).cast("string").alias("trip_id"), none.alias("fare_amount")),
        trips.read(failures).select(
            F.lit("failed file").alias("side"), F.regexp_extract("key", "[^/]+$", 0).alias("trip_id"), none.alias("fare_amount")
        ).distinct(),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def stream_late_rows(spark, folder):
    """Rows more than a day older than what came before, beside the others."""
    landing, (sink, late) = landed_twice(spark, folder), (work_folder(spark, n) for n in ("trips", "late"))
    schema = t.stream_trips(spark, folder).schema
    files = streams.file_stream(spark, landing, schema, max_files=LANDED_FILES).drop("source_file")
    streams.run_late_split(files, sink, late, work_folder(spark, "checkpoint"), delay="1 day").awaitTermination()
    trips = CommittedSink(spark, sink)
    sides = [df.select("trip_id", "event_time", F.lit(side).alias("side")) for df, side in ((trips.read(), "on time"), (trips.read(late), "late"))]
    return sides[0].unionByName(sides[1])
