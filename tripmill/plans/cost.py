"""Cost of selected queries from history and metering tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.functions.numbers import credit_usd, usage_usd
from tripmill.functions.times import boundary_millis
from tripmill.operators.intervals import first_following, overlap_join
from tripmill.schema import CREDIT_PRICE_USD, RPU_HOUR_PRICE_USD

MINUTE = ["minute_start", "minute_end", "billed_seconds"]


def inline_ids(spark: SparkSession, ids: Iterable, kind: str = "string") -> DataFrame:
    """A list of query ids as a one-column table."""
    return spark.createDataFrame([(i,) for i in ids], f"query_id {kind}")


def credit_cost(
    history: DataFrame, attribution: DataFrame, ids: DataFrame, price: str = CREDIT_PRICE_USD
) -> DataFrame:
    """Credits and dollars per selected query; NULL where no credits are attributed."""
    picked = history.join(ids, "query_id").select(
        "query_id", "start_time", F.col("execution_time").alias("exec_ms"), "bytes_scanned"
    )
    credits = attribution.join(ids, "query_id", "left_semi").select(
        "query_id", F.col("credits_attributed_compute").alias("credits_compute")
    )
    return (
        picked.join(credits, "query_id", "left")
        .withColumn("cost_usd", credit_usd(F.col("credits_compute"), price))
        .orderBy("start_time")
    )


def selected_queries(history: DataFrame, ids: DataFrame) -> DataFrame:
    return history.join(ids, "query_id", "left_semi").select("query_id", "start_time", "end_time")


def time_span(df: DataFrame, start: str, end: str) -> tuple[Column, Column]:
    """First start and last end as literals, which reach the scans of the tables they bound.

    Both are NULL for an empty frame, and so nothing lies between them.
    """
    kind = df.schema[start].dataType
    ends = df.agg(F.min(start).cast("string"), F.max(end).cast("string")).first()
    return tuple(F.lit(e).cast(kind) for e in ends)


def billed_minutes(metering: DataFrame, selected: DataFrame) -> DataFrame:
    """Metering records around the selected queries, padded to catch a resume before them."""
    first, last = time_span(selected, "start_time", "end_time")
    early, late = first - F.expr("INTERVAL 2 MINUTES"), last + F.expr("INTERVAL 1 MINUTE")
    return metering.where((F.col("end_time") > early) & (F.col("start_time") < late)).select(
        F.col("start_time").alias("minute_start"),
        F.col("end_time").alias("minute_end"),
        F.col("charged_seconds").cast("double").alias("billed_seconds"),
    )


def minute_concurrency(
    minutes: DataFrame, history: DataFrame, ids: DataFrame, span: tuple[Column, Column] | None = None
) -> DataFrame:
    """Distinct queries running in each billed minute: all of them and the selected ones.

    One overlap join serves both counts; the selected ids are marked on the history.
    The minutes themselves join the counting as rows without a query, which keeps those in
    which nothing ran. Pairs shrink to one per minute and query, then to one per minute,
    both with map-side partial sums, so a crowded minute spreads over many tasks.

    Of the history only queries inside ``span``, the minutes' first start and last end, are
    read, and a query's minutes outside it are never made; it is looked up if not given.
    """
    span = span or time_span(minutes, "minute_start", "minute_end")
    mine = ids.select("query_id", F.lit(True).alias("selected")).distinct()
    running = history.select("query_id", "start_time", "end_time").join(mine, "query_id", "left")
    pairs = overlap_join(running, minutes.select(*MINUTE), within=span).select(*MINUTE, "query_id", "selected")
    empty = minutes.select(*MINUTE, F.lit(None).cast(history.schema["query_id"].dataType).alias("query_id"))
    per_query = (
        pairs.unionByName(empty.withColumn("selected", F.lit(None).cast("boolean")))
        .groupBy(*MINUTE, "query_id")
        .agg(F.max("selected").alias("selected"))
    )
    return per_query.groupBy(*MINUTE).agg(
        F.count("query_id").alias("running_all"), F.count_if(F.col("selected")).alias("running_my")
    )


def exact_shares(
    selected: DataFrame, concurrency: DataFrame, span: tuple[Column, Column] | None = None
) -> DataFrame:
    """Seconds of each selected query's minutes, split evenly over all queries running.

    ``span`` bounds the minutes, as in ``minute_concurrency``.
    """
    busy = concurrency.where(F.col("running_all") > 0)
    share = F.try_divide(F.col("billed_seconds"), F.col("running_all"))
    return overlap_join(selected, busy, within=span).groupBy("query_id").agg(F.sum(share).alias("rpu_seconds_exact"))


def idle_minutes(concurrency: DataFrame) -> DataFrame:
    """Billed minutes in which nothing ran."""
    return concurrency.where((F.col("billed_seconds") > 0) & (F.col("running_all") == 0)).select(*MINUTE)


def idle_matches(idle: DataFrame, selected: DataFrame) -> DataFrame:
    """Each idle minute with the first selected query that starts at or after its end.

    Minutes no selected query follows carry NULL; they are the unattributed remainder.
    """
    return first_following(idle, selected, "minute_end", "start_time", "query_id").select(
        *MINUTE, F.col("next_id").alias("query_id"), F.col("next_time").alias("start_time")
    )


def usage_cost(
    history: DataFrame, metering: DataFrame, ids: DataFrame, price_per_hour: str = RPU_HOUR_PRICE_USD
) -> DataFrame:
    """Seconds and dollars attributed to each selected query.

    A busy minute is split over the queries running in it; an idle minute goes to the
    next selected query.
    """
    selected = selected_queries(history, ids)
    minutes = billed_minutes(metering, selected)
    span = time_span(minutes, "minute_start", "minute_end")
    concurrency = minute_concurrency(minutes, history, ids, span)
    exact = exact_shares(selected, concurrency, span)
    resumed = (
        idle_matches(idle_minutes(concurrency), selected)
        .where(F.col("query_id").isNotNull())
        .groupBy("query_id")
        .agg(F.sum("billed_seconds").alias("rpu_seconds_resume"))
    )
    seconds = F.coalesce("rpu_seconds_exact", F.lit(0.0)) + F.coalesce("rpu_seconds_resume", F.lit(0.0))
    return (
        selected.join(exact, "query_id", "left")
        .join(resumed, "query_id", "left")
        .select(
            F.lit("redshift_serverless").alias("engine"),
            "query_id",
            "start_time",
            boundary_millis(F.col("start_time"), F.col("end_time")).alias("exec_ms"),
            seconds.alias("rpu_seconds_attributed"),
            usage_usd(seconds, price_per_hour).alias("cost_usd"),
        )
        .orderBy("start_time")
    )
