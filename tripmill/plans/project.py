"""The model project: all layers over the source tables, published by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmill.operators.sinks import publish
from tripmill.plans import marts, models, staging
from tripmill.sources.lake import source_table


def staging_models(spark: SparkSession, tables: dict[str, str] | None = None) -> dict[str, DataFrame]:
    return {
        "trips": staging.stg_trips(source_table(spark, "trip_data", tables)),
        "zones": staging.stg_zones(source_table(spark, "taxi_zone_lookup", tables)),
        "stream": staging.stg_stream(source_table(spark, "taxi_streaming_trips", tables)),
    }


def intermediate_models(
    stg: dict[str, DataFrame], as_of=None, streaming_days_back: int = 1
) -> dict[str, DataFrame]:
    return {
        "trip_zone": models.trip_zone(stg["trips"], stg["zones"]),
        "streaming_enriched": models.streaming_enriched(stg["stream"], stg["zones"], as_of, streaming_days_back),
    }


def mart_models(inter: dict[str, DataFrame], baseline_date=None, days: DataFrame | None = None) -> dict[str, DataFrame]:
    trips, stream = inter["trip_zone"], inter["streaming_enriched"]
    stream_hours, baseline_hours = marts.hourly(stream), marts.baseline_hourly(trips, baseline_date, days)
    return {
        "avg_fare_by_zone": marts.avg_fare_by_zone(trips),
        "avg_passengers_by_cab": marts.avg_passengers_by_cab(trips),
        "avg_duration_by_cab_month": marts.avg_duration_by_cab_month(trips),
        "monthly_cab_counts": marts.monthly_cab_counts(trips),
        "busiest_zone": marts.busiest_zone(trips),
        "streaming_hourly": stream_hours.orderBy("hour"),
        "baseline_hourly": baseline_hours.orderBy("hour"),
        "stream_vs_baseline": marts.stream_vs_baseline(stream_hours, baseline_hours).orderBy("hour", "series"),
        "daily_streaming_trips": marts.daily_streaming_trips(stream),
        "live_trips": models.live_trips(stream),
    }


def build(
    spark: SparkSession,
    tables: dict[str, str] | None = None,
    as_of=None,
    streaming_days_back: int = 1,
    baseline_date=None,
    save_intermediate: bool = False,
) -> list[str]:
    """Publish every model as a view: ``stg_…``, ``int_…`` and ``mart_…``.

    Views are worked out whenever they are read. ``save_intermediate`` stores the enriched
    trips as tables, so that marts read the trips and join the zones once.
    """
    stg = staging_models(spark, tables)
    inter = intermediate_models(stg, as_of, streaming_days_back)
    names = publish(stg, "stg") + publish(inter, "int", as_table=save_intermediate)
    if save_intermediate:
        inter = {name: spark.table(f"int_{name}") for name in inter}
    days = marts.partition_days(stg["trips"])
    return names + publish(mart_models(inter, baseline_date, days), "mart")
