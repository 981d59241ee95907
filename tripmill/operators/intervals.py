"""Joins on time intervals and instants that need neither nested loops nor large groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DAY_SECONDS = 86400


def bucket_of(ts: Column, width: int) -> Column:
    return F.floor(F.unix_timestamp(ts) / width)


def _per_bucket(
    df: DataFrame, start: str, end: str, width: int, first_name: str, within: tuple[Column, Column] | None = None
) -> DataFrame:
    """One row per bucket an interval touches inside ``within``, with the first of them."""
    begin, stop = F.col(start), F.col(end)
    if within:
        begin, stop = F.greatest(begin, within[0]), F.least(stop, within[1])
        df = df.where((F.col(start) < within[1]) & (F.col(end) > within[0]))
    low, high = bucket_of(begin, width), bucket_of(stop, width)
    return df.withColumn(first_name, low).withColumn("bucket", F.explode(F.sequence(low, high)))


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    left_span: tuple[str, str] = ("start_time", "end_time"),
    right_span: tuple[str, str] = ("minute_start", "minute_end"),
    width: int = 60,
    within: tuple[Column, Column] | None = None,
) -> DataFrame:
    """Pairs with left.start < right.end and left.end > right.start.

    Both sides are cut into time buckets of ``width`` seconds and joined on the bucket,
    an equi join that Spark can shuffle and AQE can split where a bucket is hot. A pair
    meeting in several buckets is kept only in the later of its two start buckets, so no
    distinct is needed. Column names of the two sides must differ.

    ``within`` are two instants that all of the right side lies between. Left intervals
    outside are left out at the scan, and longer ones cut into buckets only in between.
    """
    lo, hi = (F.col(c) for c in left_span)
    ro, rh = (F.col(c) for c in right_span)
    pairs = _per_bucket(left, *left_span, width, "__left_first", within).join(
        _per_bucket(right, *right_span, width, "__right_first"), "bucket"
    )
    owner = F.greatest("__left_first", "__right_first")
    return pairs.where((lo < rh) & (hi > ro) & (F.col("bucket") == owner)).drop(
        "bucket", "__left_first", "__right_first"
    )


def _next_hit(probes: DataFrame, points: DataFrame, group: str, position: str) -> DataFrame:
    """For each probe the ``hit`` of the first point of its group at or after its position."""
    no_hit = F.lit(None).cast(points.schema["hit"].dataType).alias("hit")
    both = probes.select(group, position, F.lit(0).alias("side"), no_hit).unionByName(
        points.select(group, position, F.lit(1).alias("side"), "hit")
    )
    ahead = W.partitionBy(group).orderBy(position, "side").rowsBetween(0, W.unboundedFollowing)
    found = both.withColumn("hit", F.first("hit", ignorenulls=True).over(ahead))
    return found.where(F.col("side") == 0).drop("side")


def first_following(
    probes: DataFrame, points: DataFrame, probe_time: str, point_time: str, point_id: str
) -> DataFrame:
    """Add to each probe the first point at or after its time, as ``next_time`` and ``next_id``.

    NULL where no point follows; of points at one instant, the least id. Exact at any
    skew: points shrink to the first per instant, per second and per day, and each window
    sees at most the instants of one second, the seconds of one day, or the days of the
    calendar. Probe rows themselves never enter a window.
    """
    t, second, day = F.col("t"), F.col("second"), F.col("day")
    whole = F.date_trunc("SECOND", t).cast("timestamp_ntz") == t

    hits = points.where(F.col(point_time).isNotNull()).select(
        F.col(point_time).alias("t"),
        F.unix_timestamp(point_time).alias("second"),
        F.struct(F.col(point_time).alias("t"), F.col(point_id).alias("id")).alias("hit"),
    )
    seconds = (
        hits.groupBy("second")
        .agg(F.min("hit").alias("hit"))
        .select("second", F.floor(second / DAY_SECONDS).alias("day"), "hit")
    )
    days = seconds.groupBy("day").agg(F.min("hit").alias("hit")).select("day", F.lit(0).alias("calendar"), "hit")

    # A probe inside a second looks there first, then from the next second on.
    times = (
        probes.select(F.col(probe_time).alias("t")).where(t.isNotNull()).distinct()
        .select("t", F.unix_timestamp(t).alias("own_second"), whole.alias("whole"))
        .withColumn("second", F.when(F.col("whole"), F.col("own_second")).otherwise(F.col("own_second") + 1))
        .withColumn("day", F.floor(second / DAY_SECONDS))
    )
    inside = times.where(~F.col("whole")).select("t", F.col("own_second").alias("second"))
    busy = hits.join(inside.select("second").distinct(), "second", "left_semi")
    busy = busy.groupBy("second", "t").agg(F.min("hit").alias("hit"))
    in_second = _next_hit(inside, busy, "second", "t").select("t", F.col("hit").alias("hit_second"))
    in_day = _next_hit(times.select("day", "second").distinct(), seconds, "day", "second")
    in_day = in_day.select("second", F.col("hit").alias("hit_day"))
    later = times.select((day + 1).alias("day"), F.lit(0).alias("calendar")).distinct()
    in_calendar = _next_hit(later, days, "calendar", "day")
    in_calendar = in_calendar.select((day - 1).alias("day"), F.col("hit").alias("hit_calendar"))

    found = (
        times.join(in_second, "t", "left")
        .join(in_day, "second", "left")
        .join(in_calendar, "day", "left")
        .select(t.alias(probe_time), F.coalesce("hit_second", "hit_day", "hit_calendar").alias("hit"))
    )
    return (
        probes.join(found, probe_time, "left")
        .select(*probes.columns, F.col("hit.t").alias("next_time"), F.col("hit.id").alias("next_id"))
    )


def running_total(df: DataFrame, time_col: str, value_col: str, name: str = "cumulative") -> DataFrame:
    """Running sum over time of rows that are unique in time (one per minute, say).

    Sums run inside each day and start from the total of the days before. The window over
    whole days is the only one not partitioned; it sees one row per calendar day.
    """
    dated = df.withColumn("__day", F.to_date(time_col))
    totals = dated.groupBy("__day").agg(F.sum(value_col).alias("__total"))
    before = W.orderBy("__day").rowsBetween(W.unboundedPreceding, -1)
    carried = totals.select("__day", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__carried"))
    inside = W.partitionBy("__day").orderBy(time_col).rowsBetween(W.unboundedPreceding, 0)
    return (
        dated.withColumn("__inside", F.sum(value_col).over(inside))
        .join(carried, "__day")
        .select(*df.columns, (F.col("__carried") + F.col("__inside")).alias(name))
    )
