"""The given tables in the roles of the trip data model.

Each view exists twice: as a DataFrame here and as SQL in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmill.plans import staging
from tripmill.schema import TRIP_TYPES
from tripmill.sources.records import encode

AS_OF = "2024-01-31 00:00:00"


# Schemas by path and time of change: a table's footers are looked at once, not by every query.
SCHEMAS: dict[tuple[str, int], StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    path = f"{folder}/{name}.parquet"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    changed = place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).getModificationTime()
    if (path, changed) not in SCHEMAS:
        SCHEMAS[path, changed] = spark.read.parquet(path).schema
    return spark.read.schema(SCHEMAS[path, changed]).parquet(path)


def events_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = table(spark, folder, "events").schema
    # The pattern also fits a table stored as one file, which a plain path does not.
    return spark.readStream.schema(schema).parquet(f"{folder}/events.parquet*")


def seconds(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), n)


def with_k(events: DataFrame) -> DataFrame:
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def cab_type_of(number: Column) -> Column:
    return F.when(number == 0, "yellow").when(number == 1, "green").otherwise("fhv")


def as_trips(events: DataFrame) -> DataFrame:
    """Events as trips of the lake."""
    k, ts = F.col("k"), F.col("ts")
    vendor = F.col("user_id") % 3
    known = {
        "vendorid": vendor.cast("int"),
        "pickup_datetime": ts,
        "dropoff_datetime": ts + seconds((k - 10) * 61),
        "store_and_fwd_flag": F.when(k % 10 == 0, "X").when(k % 2 == 0, "Y").when(k % 9 != 0, "N"),
        "pulocationid": k % 27,
        "dolocationid": (k * 7) % 25,
        "passenger_count": F.when(k % 11 != 0, (k % 7).cast("bigint")),
        "trip_distance": F.col("value") / 10,
        "fare_amount": F.when(k % 13 != 0, F.col("value")),
        "payment_type": (k % 4 + 1).cast("bigint"),
        "cab_type": cab_type_of(vendor),
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
    }
    lake = [
        known.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in TRIP_TYPES.items()
    ]
    return with_k(events).select(F.col("event_id").alias("trip_id"), "k", "event_type", *lake)


def trips(spark: SparkSession, folder: str) -> DataFrame:
    return as_trips(table(spark, folder, "events"))


def staged_trips(spark: SparkSession, folder: str) -> DataFrame:
    return staging.stg_trips(trips(spark, folder))


def order_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as staged trips over several years."""
    lines = table(spark, folder, "lineitem").join(
        table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    pickup = F.col("o_orderdate")
    known = {
        "pickup_datetime": pickup,
        "dropoff_datetime": F.col("l_shipdate"),
        "pulocationid": F.col("o_custkey") % 30,
        "dolocationid": F.col("l_suppkey") % 25,
        "passenger_count": F.col("l_linenumber"),
        "trip_distance": F.col("l_quantity"),
        "fare_amount": F.col("l_extendedprice"),
        "cab_type": F.col("o_orderstatus"),
        "year": F.year(pickup),
        "month": F.month(pickup),
        "day": F.dayofmonth(pickup),
    }
    return staging.stg_trips(
        lines.select(*[known.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in TRIP_TYPES.items()])
    )


def zones(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    lookup = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("bigint").alias("locationid"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
        F.lit(None).cast("string").alias("service_zone"),
    )
    return staging.stg_zones(lookup)


def as_stream_trips(events: DataFrame) -> DataFrame:
    """Events as rows of the stream landing table."""
    t = as_trips(events)
    pickup, k = F.col("pickup_datetime"), F.col("k")
    return t.select(
        F.col("trip_id").cast("string").alias("trip_id"),
        "pickup_datetime",
        "dropoff_datetime",
        "pulocationid",
        "dolocationid",
        F.col("passenger_count").cast("int").alias("passenger_count"),
        "fare_amount",
        F.col("payment_type").cast("int").alias("payment_type"),
        pickup.alias("event_time"),
        (pickup + seconds(k)).alias("lambda_received_time"),
        (pickup + seconds(k * 3)).alias("inserted_at"),
        "year",
        "month",
        "day",
        F.hour(pickup).alias("hour"),
    )


def stream_trips(spark: SparkSession, folder: str) -> DataFrame:
    return as_stream_trips(table(spark, folder, "events"))


def staged_stream(spark: SparkSession, folder: str) -> DataFrame:
    return staging.stg_stream(stream_trips(spark, folder))


def as_envelopes(events: DataFrame) -> DataFrame:
    """Events as base64 JSON records, some of them odd or broken in one of several ways."""
    t = as_stream_trips(events)
    clock = "yyyy-MM-dd HH:mm:ss"
    offset = F.when(F.col("hour") < 8, "+00:00").when(F.col("hour") < 16, "+0500").otherwise("Z")
    fraction = F.when(F.col("payment_type") == 1, ".250000").otherwise("")
    record = F.struct(
        "trip_id",
        F.date_format("pickup_datetime", clock).alias("pickup_datetime"),
        F.date_format("dropoff_datetime", clock).alias("dropoff_datetime"),
        F.when(F.col("pulocationid") < 20, F.col("pulocationid")).alias("PULocationID"),
        F.col("dolocationid").alias("DOLocationID"),
        F.coalesce("passenger_count", F.lit(0)).alias("passenger_count"),
        F.coalesce("fare_amount", F.lit(0.0)).alias("fare_amount"),
        "payment_type",
        F.when(
            F.col("payment_type") != 2,
            F.concat(F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss"), fraction, offset),
        ).alias("event_time"),
    )
    text = F.to_json(record)
    odd = F.col("hour") == 9
    json = (
        # A member given twice, and counts that no integer holds.
        F.when(F.col("hour") == 7, F.concat(F.lit('{"trip_id":"stale",'), F.substring(text, F.lit(2), F.length(text))))
        .when(odd & (F.col("payment_type") == 1), F.regexp_replace(text, '"passenger_count":[^,]*', '"passenger_count":NaN'))
        .when(odd & (F.col("payment_type") == 2), F.regexp_replace(text, '"passenger_count":[^,]*', '"passenger_count":1.7'))
        .when(F.col("hour") == 3, F.lit(""))
        .when((F.col("hour") == 5) & (F.col("payment_type") == 1), F.lit("[1]"))
        .when((F.col("hour") == 5) & (F.col("payment_type") == 2), F.lit("{bad"))
        .when((F.col("hour") == 5) & (F.col("payment_type") == 3), F.lit('{"trip_id":1}'))
        .otherwise(text)
    )
    return t.select(F.col("trip_id").alias("recordId"), encode(json).alias("data"))


def query_history(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a query history; ``value`` is the run time in seconds."""
    ts, value = F.col("ts"), F.col("value")
    return with_k(table(spark, folder, "events")).select(
        F.col("event_id").alias("query_id"),
        ts.alias("start_time"),
        (ts + seconds(F.floor(value))).alias("end_time"),
        (F.floor(value) * 1000).cast("bigint").alias("execution_time"),
        (F.col("k") * 1048576).cast("bigint").alias("bytes_scanned"),
        F.col("event_type").alias("warehouse_name"),
    )


def query_attribution(spark: SparkSession, folder: str) -> DataFrame:
    """Credits of the queries that ran at least five seconds."""
    return table(spark, folder, "events").where("value >= 5").select(
        F.col("event_id").alias("query_id"),
        (F.floor(F.col("value")) / 64).alias("credits_attributed_compute"),
    )


def chosen_queries(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of the queries to account for: one workload's."""
    return table(spark, folder, "events").where("event_type = 'purchase'").select(
        F.col("event_id").alias("query_id")
    )


def metering(spark: SparkSession, folder: str) -> DataFrame:
    """Billed minutes: those in which a query started, and the third minute after it."""
    minute = F.date_trunc("MINUTE", "ts").cast("timestamp_ntz")
    after = F.explode(F.array(F.expr("INTERVAL 0 MINUTES"), F.expr("INTERVAL 3 MINUTES")))
    return (
        table(spark, folder, "events")
        .select(minute.alias("minute"), after.alias("after"))
        .select((F.col("minute") + F.col("after")).alias("start_time"))
        .distinct()
        .select(
            "start_time",
            (F.col("start_time") + F.expr("INTERVAL 1 MINUTES")).alias("end_time"),
            F.lit(60.0).alias("charged_seconds"),
        )
    )
