"""Marts over enriched trips."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripmill.functions.times import hour_start
from tripmill.plans.models import PARTS, on_day, part_date, parts_of


def avg_fare_by_zone(tz: DataFrame) -> DataFrame:
    """Trips without a zone form a group of their own."""
    known = tz.where(F.col("fare_amount").isNotNull())
    return known.groupBy("pickup_zone").agg(F.avg("fare_amount").alias("avg_fare"))


def avg_passengers_by_cab(tz: DataFrame) -> DataFrame:
    known = tz.where(F.col("passenger_count").isNotNull())
    return known.groupBy("cab_type").agg(F.avg("passenger_count").alias("avg_passenger_count"))


def avg_duration_by_cab_month(tz: DataFrame) -> DataFrame:
    known = tz.where(F.col("trip_duration_min").isNotNull())
    return known.groupBy("cab_type", "pickup_month").agg(
        F.avg("trip_duration_min").alias("avg_trip_duration_min")
    )


def monthly_cab_counts(tz: DataFrame) -> DataFrame:
    return tz.groupBy("cab_type", "pickup_month").agg(F.count("*").alias("trip_count"))


def busiest_zone(tz: DataFrame, drop_unmatched: bool = False) -> DataFrame:
    """Zones with the most trips, overall and by month; ties stay.

    Trips are counted once, by month and zone; the overall counts are sums of those.
    Ranks run over the counts, and Spark cuts each side to its leaders before the
    windows shuffle.
    """
    if drop_unmatched:
        tz = tz.where(F.col("pickup_zone").isNotNull())
    by_month = tz.groupBy("pickup_month", "pickup_zone").agg(F.count("*").alias("total_trips"))
    overall = by_month.groupBy("pickup_zone").agg(F.sum("total_trips").alias("total_trips"))
    most = F.col("total_trips").desc()

    def leaders(counts: DataFrame, window) -> DataFrame:
        return counts.withColumn("rnk", F.dense_rank().over(window)).where(F.col("rnk") == 1)

    top_overall = leaders(overall, W.orderBy(most)).select(
        F.lit("overall").alias("grain"),
        F.lit(None).cast("date").alias("pickup_month"),
        "pickup_zone", "total_trips", "rnk",
    )
    top_by_month = leaders(by_month, W.partitionBy("pickup_month").orderBy(most)).select(
        F.lit("by_month").alias("grain"), "pickup_month", "pickup_zone", "total_trips", "rnk"
    )
    return top_overall.unionByName(top_by_month)


def hourly(df: DataFrame) -> DataFrame:
    """Trips, fares and mean passengers (zero counts as unknown) per pickup hour."""
    return df.groupBy(hour_start(F.col("pickup_at")).alias("hour")).agg(
        F.count("*").alias("trips"),
        F.sum("fare_amount").alias("fare_total"),
        F.avg(F.nullif(F.col("passenger_count"), F.lit(0))).alias("avg_passenger_count"),
    )


def partition_days(staged: DataFrame) -> DataFrame:
    """The partition columns of staged trips; reading them opens no data column."""
    names = {"pickup_year": "part_year", "pickup_month": "part_month", "pickup_day": "part_day"}
    return staged.select(*[F.col(c).alias(p) for c, p in names.items()])


def latest_day(tz: DataFrame) -> DataFrame:
    return tz.agg(F.max("pickup_date").alias("pickup_date"))


def latest_day_of(tz: DataFrame, days: DataFrame) -> Column:
    """``latest_day`` as a subquery that reads the newest partition day alone.

    ``days`` holds the partition columns of the trips' source and nothing else, so its newest
    day comes from partition values. Only if that day has no trip of ``tz`` are all others
    looked at: the bound on their partitions is itself a subquery, which else leaves none.
    """
    newest = days.select(part_date().alias("day")).agg(F.max("day"))
    found = latest_day(on_day(tz, newest.scalar()))
    bound = F.when(found.scalar().isNull(), F.lit("9999-12-31")).otherwise(F.lit("0001-01-01")).cast("date")
    others = latest_day(tz.where(F.coalesce(part_date(), F.lit("0001-01-02").cast("date")) <= bound))
    return F.coalesce(found.scalar(), others.scalar())


def baseline_hourly(tz: DataFrame, baseline_date: dt.date | str | None = None, days: DataFrame | None = None) -> DataFrame:
    """The hourly mart of one day: the given one, else the latest in the data.

    A given day prunes partitions and reaches the scan as a range on the pickup time. The
    latest day is a subquery, found anew at each read, and prunes partitions when it is known.
    With ``days``, the source's partition columns (``partition_days``), that one day's files
    are all that is read to find it, too.
    """
    if baseline_date is not None:
        day = F.lit(str(baseline_date)).cast("date")
    elif days is not None and len(parts_of(tz)) == len(PARTS):
        day = latest_day_of(tz, days)
    else:
        day = latest_day(tz).scalar()
    return hourly(on_day(tz, day))


def stream_vs_baseline(stream_hourly: DataFrame, baseline: DataFrame) -> DataFrame:
    columns = ["hour", "trips", "fare_total", "avg_passenger_count"]
    return stream_hourly.select(F.lit("stream").alias("series"), *columns).unionByName(
        baseline.select(F.lit("baseline").alias("series"), *columns)
    )


def daily_streaming_trips(enriched: DataFrame) -> DataFrame:
    """Stream trips and fares per pickup day and hour of day."""
    return enriched.groupBy("pickup_date", "pickup_hour").agg(
        F.count("*").alias("trips"), F.sum("fare_amount").alias("fare_total")
    )


def top_traffic_day(tz: DataFrame) -> DataFrame:
    """The day with the most trips; of equals, the earliest."""
    per_day = tz.groupBy("pickup_date").agg(F.count("*").alias("trips"))
    return per_day.orderBy(F.desc("trips"), "pickup_date").limit(1)
