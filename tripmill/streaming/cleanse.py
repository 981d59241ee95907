"""Cleansing of stream records. Works on static and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.times import as_of_column, parse_event_time, parse_record_time
from tripmill.schema import REQUIRED_RECORD_KEYS, STREAM_PARTITIONS, STREAM_TYPES
from tripmill.sources.records import decode, encode

# Fixed names and order of the cleansed payload.
PAYLOAD = (
    "trip_id", "pickup_datetime", "dropoff_datetime", "pulocationid", "dolocationid",
    "passenger_count", "fare_amount", "payment_type", "event_time", "lambda_received_time",
    "year", "month", "day", "hour",
)
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


RECORD_KEYS = (*REQUIRED_RECORD_KEYS, "event_time", "PULocationID", "DOLocationID")


def with_record(df: DataFrame) -> DataFrame:
    """Add ``record``: the members of the one JSON object in ``text``; NULL for anything else.

    Members are variants, so they keep their JSON types; an absent one is NULL, a null one is
    not. Of repeated members the last counts. Read inside brackets, because the JSON reader by
    itself stops after a first object and would not see that more follows.
    """
    bracketed = F.concat(F.lit("["), F.col("text"), F.lit("]"))
    members = ", ".join(f"`{k}` variant" for k in RECORD_KEYS)
    listed = F.from_json(bracketed, f"array<struct<{members}>>", {"allowSingleQuotes": "false"})
    only = F.when((F.size("listed") == 1) & F.col("text").endswith("}"), F.get("listed", F.lit(0)))
    return df.withColumn("listed", listed).withColumn("record", only).drop("listed")


def cleanse(raw: DataFrame, received_at=None, offset_mode: str = "wall_clock") -> DataFrame:
    """Decode, check and parse (recordId, data) envelopes; every input row comes back.

    ``error`` says why a record failed, NULL for good ones. Required keys must be present;
    a null value passes. Location ids default to -1 when the key is absent only. A missing
    or empty event time becomes the receive time. A good record's value that does not fit
    its column type is NULL here and unchanged in ``delivery_records``.
    """
    received = F.date_trunc("SECOND", as_of_column(received_at)).cast("timestamp_ntz")
    parsed = with_record(raw.select("recordId", "data", decode(F.col("data")).alias("text")))

    # Members are taken out once, then only looked at.
    def member(key: str) -> Column:
        return F.try_variant_get(F.col(f"record.{key}"), "$", "string")

    def number(key: str) -> Column:
        return member(key).try_cast("double")

    def whole(key: str) -> Column:
        value = number(key)
        return F.when(value == F.floor(value), value.try_cast("int"))

    def located(key: str) -> Column:
        return F.when(F.col(f"record.{key}").isNull(), F.lit(-1)).otherwise(whole(key))

    absent = [F.when(F.col(f"record.{k}").isNull(), F.lit(k)) for k in REQUIRED_RECORD_KEYS]
    taken = parsed.select(
        "recordId",
        "data",
        "text",
        "record",
        F.col("record").isNotNull().alias("is_object"),
        F.concat_ws(", ", *absent).alias("missing"),
        member("trip_id").alias("trip_id"),
        member("pickup_datetime").alias("pickup_text"),
        member("dropoff_datetime").alias("dropoff_text"),
        F.coalesce(member("event_time"), F.lit("")).alias("event_text"),
        located("PULocationID").alias("pulocationid"),
        located("DOLocationID").alias("dolocationid"),
        whole("passenger_count").alias("passenger_count"),
        number("fare_amount").alias("fare_amount"),
        whole("payment_type").alias("payment_type"),
    )
    event_text = F.col("event_text")
    timed = taken.withColumns(
        {
            "pickup_datetime": parse_record_time(F.col("pickup_text")),
            "dropoff_datetime": parse_record_time(F.col("dropoff_text")),
            "event_time": F.when(event_text == "", received).otherwise(parse_event_time(event_text, offset_mode)),
        }
    )
    error = (
        F.when(F.col("text").isNull(), "not base64 text")
        .when(F.col("text") == "", "empty record")
        .when(~F.col("is_object"), "not a JSON object")
        .when(F.col("missing") != "", F.concat(F.lit("missing keys: "), F.col("missing")))
        .when(F.col("pickup_datetime").isNull() | F.col("dropoff_datetime").isNull(), "bad trip time")
        .when(F.col("event_time").isNull(), "bad event time")
    )
    pickup = F.col("pickup_datetime")
    checked = timed.withColumns(
        {
            "lambda_received_time": received,
            "year": F.year(pickup),
            "month": F.month(pickup),
            "day": F.dayofmonth(pickup),
            "hour": F.hour(pickup),
            "error": error,
        }
    )
    # A filter on ``error`` pushed below this point would repeat the whole parse inside the
    # filter, several times over. Catalyst does not push filters through a generator, so a
    # one-row explode keeps it at one parse per record.
    row = F.struct("recordId", "data", "error", "record", *PAYLOAD)
    once = checked.select(F.explode(F.array(row)).alias("row")).select("row.*")
    return once.select(
        "recordId",
        "data",
        F.when(F.col("error").isNull(), "Ok").otherwise("ProcessingFailed").alias("result"),
        "error",
        "record",
        *PAYLOAD,
    )


def good_rows(cleansed: DataFrame) -> DataFrame:
    """Typed payload columns of the good records."""
    return cleansed.where(F.col("error").isNull()).select(
        *[F.col(c).cast(STREAM_TYPES[c]).alias(c) for c in PAYLOAD]
    )


def failed_rows(cleansed: DataFrame) -> DataFrame:
    """Dead letters: id, original data, result, and the reason."""
    return cleansed.where(F.col("error").isNotNull()).select(
        F.coalesce("recordId", F.lit("unknown")).alias("recordId"),
        "result",
        F.coalesce("data", F.lit("")).alias("data"),
        "error",
    )


def json_text(value: Column) -> Column:
    """A variant as JSON. Numbers without a JSON form go out as the words they came in as."""
    number = F.when(F.schema_of_variant(value) == "DOUBLE", F.try_variant_get(value, "$", "double"))
    return (
        F.when(F.isnan(number), F.lit("NaN"))
        .when(number == F.lit(float("inf")), F.lit("Infinity"))
        .when(number == F.lit(float("-inf")), F.lit("-Infinity"))
        .otherwise(F.to_json(value))
    )


def delivery_records(cleansed: DataFrame) -> DataFrame:
    """One output record per input: good ones re-encoded with partition keys, others as they came.

    Values go out with the JSON types they came with, from the same parse as the typed columns.
    """

    def value(key: str) -> Column:
        return json_text(F.col(f"record.{key}"))

    def located(key: str) -> Column:
        return F.coalesce(value(key), F.lit("-1"))

    def clock(c: str) -> Column:
        return F.concat(F.lit('"'), F.date_format(c, TIME_FORMAT), F.lit('"'))

    times = {c: clock(c) for c in ("pickup_datetime", "dropoff_datetime", "event_time", "lambda_received_time")}
    raw_values = {c: value(c) for c in ("trip_id", "passenger_count", "fare_amount", "payment_type")}
    places = {"pulocationid": located("PULocationID"), "dolocationid": located("DOLocationID")}
    source = {**times, **raw_values, **places}
    members = [F.concat(F.lit(f'"{c}":'), source.get(c, F.col(c).cast("string"))) for c in PAYLOAD]
    payload = F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))
    good = F.col("error").isNull()
    return cleansed.select(
        F.coalesce("recordId", F.lit("unknown")).alias("recordId"),
        "result",
        F.when(good, encode(payload)).otherwise(F.coalesce("data", F.lit(""))).alias("data"),
        *[F.when(good, F.col(k).cast("string")).alias(k) for k in STREAM_PARTITIONS],
    )
