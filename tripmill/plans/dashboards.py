"""Dashboard figures: series comparison, KPIs, running counts, recent rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.numbers import (
    arrow_percent_text,
    difference_color,
    percent_change,
    percent_text,
)
from tripmill.functions.times import as_of_column, in_zone, minute_start, within_minutes
from tripmill.operators.intervals import running_total
from tripmill.plans.models import on_day
from tripmill.schema import NEW_YORK

SERIES = ("baseline", "stream")


# --- stream against baseline -------------------------------------------------
def hour_series(stream_daily: DataFrame, baseline_hourly: DataFrame) -> DataFrame:
    """Both series by hour of day. The stream side keeps one row per day and hour."""
    stream = stream_daily.select(
        F.lit("stream").alias("series"), F.col("pickup_hour").cast("int").alias("hour"), "trips", "fare_total"
    )
    baseline = baseline_hourly.select(
        F.lit("baseline").alias("series"), F.hour("hour").alias("hour"), "trips", "fare_total"
    )
    return stream.unionByName(baseline)


def one_series(df: DataFrame, series: str) -> DataFrame:
    return df.where(F.col("series") == series)


def pivot_series(df: DataFrame, value: str, index: str = "hour", repeats: str = "error") -> DataFrame:
    """One row per index value, one column per series.

    A cell with several rows is an error, or summed with ``repeats="sum"``.
    """
    if repeats == "sum":
        cell = F.sum(value)
    elif repeats == "error":
        problem = F.raise_error(F.lit(f"several rows for one {index} and series"))
        cell = F.when(F.count("*") > 1, problem).otherwise(F.first(value))
    else:
        raise ValueError(f"unknown repeats: {repeats}")
    cells = df.groupBy(index, "series").agg(cell.alias("cell"))
    return cells.groupBy(index).pivot("series", list(SERIES)).agg(F.first("cell"))


def hour_difference(df: DataFrame, value: str = "trips", index: str = "hour", repeats: str = "error") -> DataFrame:
    """Pivot with missing cells as 0, stream minus baseline, and its bar colour."""
    wide = pivot_series(df, value, index, repeats).fillna(0, list(SERIES))
    difference = F.col("stream") - F.col("baseline")
    return wide.select(
        index, *SERIES, difference.alias("difference"), difference_color(difference).alias("color")
    )


def series_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("series").agg(F.sum("trips").alias("trips"), F.sum("fare_total").alias("fare_total"))


def kpi_deltas(df: DataFrame) -> DataFrame:
    """One row: totals of both series and the changes of stream against baseline."""

    def total(value: str, series: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("series") == series, F.col(value))), F.lit(0))

    totals = df.agg(
        *[
            total(value, series).alias(f"{name}_{series}")
            for value, name in (("trips", "trips"), ("fare_total", "fare"))
            for series in reversed(SERIES)
        ]
    )
    trips, trips_base = F.col("trips_stream"), F.col("trips_baseline")
    fare, fare_base = F.col("fare_stream"), F.col("fare_baseline")
    return totals.select(
        "*",
        percent_change(trips, trips_base).alias("trips_change_pct"),
        percent_change(fare, fare_base).alias("fare_change_pct"),
        percent_text(trips, trips_base).alias("trips_change_text"),
        percent_text(fare, fare_base).alias("fare_change_text"),
        F.when(trips_base > 0, trips - trips_base).alias("trips_delta"),
        F.when(trips_base > 0, percent_text(trips, trips_base, 2)).otherwise("N/A").alias("trips_delta_text"),
    )


# --- live figures --------------------------------------------------------------
def zone_choice(df: DataFrame, zone: str | None = None) -> DataFrame:
    return df if zone in (None, "All") else df.where(F.col("pickup_zone") == zone)


def zone_list(df: DataFrame) -> DataFrame:
    return df.select("pickup_zone").where(F.col("pickup_zone").isNotNull()).distinct().orderBy("pickup_zone")


def zone_aggregates() -> list[Column]:
    """What trips of a zone add up to; ``merged_zones`` adds such figures up again."""
    return [
        F.count("*").alias("n"),
        F.sum("delay_time_minutes").alias("delay"),
        F.count("delay_time_minutes").alias("delays"),
        F.sum("fare_amount").alias("fare"),
        F.sum("passenger_count").alias("passengers"),
        F.min("event_time").alias("first_event"),
        F.max("event_time").alias("last_event"),
    ]


def merged_zones(figures: DataFrame) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("n", "delay", "delays", "fare", "passengers")]
    return figures.groupBy("pickup_zone").agg(*sums, F.min("first_event").alias("first_event"), F.max("last_event").alias("last_event"))


def minute_figures(df: DataFrame) -> DataFrame:
    """Figures per minute and zone, of which any window of whole minutes is made."""
    return df.groupBy(minute_start(F.col("event_time")).alias("minute"), "pickup_zone").agg(*zone_aggregates())


def live_kpis(df: DataFrame, as_of=None, minutes: int = 120, zone: str | None = None) -> DataFrame:
    """One row of KPIs over the trailing minutes.

    Trips shrink to one row per zone first; the second step adds those up and picks the
    busiest zone (of equals, the first by name).
    """
    recent = zone_choice(df.where(within_minutes(F.col("event_time"), as_of, minutes)), zone)
    return kpis_of_zones(recent.groupBy("pickup_zone").agg(*zone_aggregates()))


def live_kpis_of_minutes(figures: DataFrame, df: DataFrame, as_of=None, minutes: int = 120, zone: str | None = None) -> DataFrame:
    """``live_kpis`` from the figures of its minutes, kept by the stream (``run_minutes``).

    Trips themselves are read for the one minute that the window cuts, if it cuts one.
    """
    start = as_of_column(as_of) - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    cut = minute_start(start)
    whole = F.when(cut == start, cut).otherwise(cut + F.expr("INTERVAL 1 MINUTE"))
    edge = df.where((F.col("event_time") >= start) & (F.col("event_time") < whole))
    inside = zone_choice(figures.where(F.col("minute") >= whole), zone).drop("minute")
    rest = zone_choice(edge, zone).groupBy("pickup_zone").agg(*zone_aggregates())
    return kpis_of_zones(merged_zones(inside.unionByName(rest)))


def cumulative_of_minutes(figures: DataFrame) -> DataFrame:
    """``cumulative_trips`` from the figures of the minutes."""
    per_minute = figures.groupBy("minute").agg(F.sum("n").alias("trip_count"))
    return running_total(per_minute, "minute", "trip_count").orderBy("minute")


def kpis_of_zones(per_zone: DataFrame) -> DataFrame:
    leader = F.when(F.col("pickup_zone").isNotNull(), F.struct((-F.col("n")).alias("n"), F.col("pickup_zone").alias("zone")))
    totals = per_zone.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.try_divide(F.sum("delay"), F.sum("delays")).alias("delay"),
        F.round(F.coalesce(F.sum("fare"), F.lit(0.0)), 2).alias("fare"),
        F.coalesce(F.sum("passengers"), F.lit(0)).cast("bigint").alias("passengers"),
        F.min(leader).alias("leader"),
        F.min("first_event").alias("first_event"),
        F.max("last_event").alias("last_event"),
    )
    n = F.col("n")
    micros = F.unix_micros(F.col("last_event").cast("timestamp")) - F.unix_micros(F.col("first_event").cast("timestamp"))
    rate = F.when(micros > 0, F.round(n / (micros / 60e6), 2)).otherwise(0.0)
    return totals.select(
        n.alias("total_trips"),
        F.when(n == 0, 0.0).otherwise(F.round("delay", 2)).alias("avg_delay"),
        F.when(n == 0, "N/A").otherwise(F.col("leader.zone")).alias("busiest_zone"),
        F.col("fare").alias("total_fare"),
        F.col("passengers").alias("total_passengers"),
        F.when(F.col("passengers") > 0, F.round(F.try_divide(F.col("fare"), F.col("passengers")), 2))
        .otherwise(0.0)
        .alias("avg_fare_per_passenger"),
        rate.alias("trips_per_minute"),
    )


def trips_per_minute(df: DataFrame, time_col: str = "event_time") -> DataFrame:
    return df.groupBy(minute_start(F.col(time_col)).alias("minute")).agg(F.count("*").alias("trip_count"))


def cumulative_trips(df: DataFrame, time_col: str = "event_time") -> DataFrame:
    """Trips per minute and their running total."""
    return running_total(trips_per_minute(df, time_col), "minute", "trip_count").orderBy("minute")


def recent(
    df: DataFrame,
    n: int,
    time_col: str = "event_time",
    keys: Sequence[str] = ("trip_id",),
    as_of=None,
    minutes: int | None = None,
) -> DataFrame:
    """The newest ``n`` rows, of the trailing minutes if given; ``keys`` order equal times."""
    if minutes is not None:
        df = df.where(within_minutes(F.col(time_col), as_of, minutes))
    return df.orderBy(F.desc(time_col), *keys).limit(n)


def last_hours(df: DataFrame, n: int = 48, time_col: str = "hour", keys: Sequence[str] = ("series",)) -> DataFrame:
    """The last ``n`` rows of an hourly frame, in its order."""
    newest = df.orderBy(F.desc(time_col), *[F.desc(k) for k in keys]).limit(n)
    return newest.orderBy(time_col, *keys)


# --- today against a baseline day, on local hours ------------------------------
def local_rows(df: DataFrame, as_of=None, tz: str = NEW_YORK, upto_now: bool = False) -> DataFrame:
    """Pickup times moved from UTC to the local zone, with the local hour."""
    if upto_now:
        df = df.where(F.col("pickup_datetime") <= as_of_column(as_of))
    local = in_zone(F.col("pickup_datetime"), tz)
    return df.withColumn("pickup_datetime", local).withColumn("hour", F.hour("pickup_datetime"))


def _by_hour(rows: DataFrame, suffix: str) -> DataFrame:
    return rows.groupBy("hour").agg(
        F.count("pickup_datetime").alias(f"trip_count_{suffix}"),
        F.sum("fare_amount").alias(f"fare_total_{suffix}"),
    )


def local_hour_compare(today: DataFrame, baseline: DataFrame, as_of=None, tz: str = NEW_YORK) -> DataFrame:
    """Trips and fares by local hour of both days; hours missing on one side count 0."""
    now = _by_hour(local_rows(today, as_of, tz, upto_now=True), "today")
    then = _by_hour(local_rows(baseline, as_of, tz), "baseline")
    return then.join(now, "hour", "full_outer").fillna(0).orderBy("hour")


def current_hour_kpis(today: DataFrame, baseline: DataFrame, as_of=None, tz: str = NEW_YORK) -> DataFrame:
    """One row: trips, fares and mean passengers of the current local hour, both days."""
    columns = ["hour", "fare_amount", "passenger_count"]
    both = (
        local_rows(today, as_of, tz, upto_now=True).select(F.lit("today").alias("day"), *columns)
        .unionByName(local_rows(baseline, as_of, tz).select(F.lit("baseline").alias("day"), *columns))
        .where(F.col("hour") == F.hour(in_zone(as_of_column(as_of), tz)))
    )
    figures = []
    for day in ("today", "baseline"):
        mine = F.col("day") == day
        figures += [
            F.count_if(mine).alias(f"{day}_trips"),
            F.coalesce(F.sum(F.when(mine, F.col("fare_amount"))), F.lit(0.0)).alias(f"{day}_fare"),
            F.avg(F.when(mine, F.col("passenger_count"))).alias(f"{day}_passengers"),
        ]
    wide = both.agg(*figures)
    texts = [
        arrow_percent_text(F.col(f"today_{f}"), F.col(f"baseline_{f}")).alias(f"{f}_change_text")
        for f in ("trips", "fare", "passengers")
    ]
    return wide.select("*", *texts)


def simulate_today(tz: DataFrame, day: DataFrame, as_of=None) -> DataFrame:
    """Trips of a chosen day (a one-row frame) moved by whole days onto the date of ``as_of``."""
    today = F.to_date(as_of_column(as_of))
    chosen = on_day(tz, day.select("pickup_date").scalar())
    shift = F.make_dt_interval(F.datediff(today, F.col("pickup_date")))
    return chosen.select(
        (F.col("pickup_at") + shift).alias("pickup_datetime"),
        (F.col("dropoff_at") + shift).alias("dropoff_datetime"),
        "pickup_zone",
        "fare_amount",
        "passenger_count",
    )


def day_trips(tz: DataFrame, day: DataFrame) -> DataFrame:
    """Trips of a chosen day (a one-row frame) under their own times."""
    return on_day(tz, day.select("pickup_date").scalar()).select(
        F.col("pickup_at").alias("pickup_datetime"), "pickup_zone", "fare_amount", "passenger_count"
    )
