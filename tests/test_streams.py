from __future__ import annotations

import base64
import json
import os
import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tests.conftest import at, plan_of, rows
from tripmill.operators.ingest import fill_defaults
from tripmill.plans import marts, staging
from tripmill.schema import STREAM_TYPES, ddl
from tripmill.session import conf_set, work_folder
from tripmill.sources.records import RECORD_SCHEMA, read_envelopes
from tripmill.streaming import cleanse as cleansing
from tripmill.streaming import commits, files, hourly, load
from tripmill.streaming.commits import CommittedSink
from tripmill.workload import tables as t

AS_OF = "2024-01-31 00:00:00"
GOOD = {
    "trip_id": "a1", "pickup_datetime": "2024-01-02 3:04:05", "dropoff_datetime": "2024-01-02 03:14:05",
    "PULocationID": 4, "DOLocationID": 7, "passenger_count": 2, "fare_amount": 12.5, "payment_type": 1,
    "event_time": "2024-01-02T03:04:06.5+05:00",
}


def pack(record) -> str:
    text = record if isinstance(record, bytes) else (record if isinstance(record, str) else json.dumps(record)).encode()
    return base64.b64encode(text).decode()


def without(*keys):
    return {k: v for k, v in GOOD.items() if k not in keys}


def cleanse_one(spark, data, **options):
    df = spark.createDataFrame([("r1", data)], RECORD_SCHEMA)
    cleansed = cleansing.cleanse(df, AS_OF, **options)
    return cleansed.first(), cleansing.delivery_records(cleansed).first()


def test_good_record(spark):
    row, out = cleanse_one(spark, pack(GOOD))
    assert (row.result, row.error, row.trip_id) == ("Ok", None, "a1")
    assert (row.pickup_datetime, row.dropoff_datetime) == (at("2024-01-02 03:04:05"), at("2024-01-02 03:14:05"))
    assert (row.pulocationid, row.dolocationid, row.passenger_count, row.fare_amount, row.payment_type) == (4, 7, 2, 12.5, 1)
    assert (row.event_time, row.lambda_received_time) == (at("2024-01-02 03:04:06"), at(AS_OF))
    assert (row.year, row.month, row.day, row.hour) == (2024, 1, 2, 3)
    assert (out.year, out.month, out.day, out.hour) == ("2024", "1", "2", "3")
    text = base64.b64decode(out.data).decode()
    assert text.endswith("\n")
    assert list(json.loads(text)) == list(cleansing.PAYLOAD)
    assert json.loads(text)["pickup_datetime"] == "2024-01-02 03:04:05"


def test_payload_keeps_value_types(spark):
    odd = {**GOOD, "trip_id": 5, "passenger_count": None, "fare_amount": "free", "PULocationID": None}
    del odd["DOLocationID"]
    row, out = cleanse_one(spark, pack(odd))
    assert (row.trip_id, row.passenger_count, row.fare_amount, row.pulocationid, row.dolocationid) == ("5", None, None, None, -1)
    payload = json.loads(base64.b64decode(out.data))
    assert [payload[k] for k in ("trip_id", "passenger_count", "fare_amount", "pulocationid", "dolocationid")] == [5, None, "free", None, -1]


@pytest.mark.parametrize("event_time", [None, "", "absent"])
def test_missing_event_time_becomes_receive_time(spark, event_time):
    record = without("event_time") if event_time == "absent" else {**GOOD, "event_time": event_time}
    row, _ = cleanse_one(spark, pack(record))
    assert (row.result, row.event_time) == ("Ok", at(AS_OF))


def test_event_time_in_utc(spark):
    assert cleanse_one(spark, pack(GOOD), offset_mode="utc")[0].event_time == at("2024-01-01 22:04:06")


@pytest.mark.parametrize(
    ("data", "error"),
    [
        (pack(""), "empty record"),
        (pack(" \n"), "empty record"),
        (pack("{bad"), "not a JSON object"),
        (pack("[1]"), "not a JSON object"),
        (pack("5"), "not a JSON object"),
        (pack(json.dumps(GOOD) + " x"), "not a JSON object"),
        (pack(json.dumps(GOOD) * 2), "not a JSON object"),
        (pack(json.dumps(GOOD) + "," + json.dumps(GOOD)), "not a JSON object"),
        (pack(b"\xff\xfe"), "not base64 text"),
        ("!!!", "not base64 text"),
        (None, "not base64 text"),
        (pack(without("trip_id", "fare_amount")), "missing keys: trip_id, fare_amount"),
        (pack({**GOOD, "pickup_datetime": None}), "bad trip time"),
        (pack({**GOOD, "dropoff_datetime": "2024-01-02T03:14:05"}), "bad trip time"),
        (pack({**GOOD, "event_time": "soon"}), "bad event time"),
        (pack({**GOOD, "event_time": "2024-01-02T03:04:06"}), "bad event time"),
    ],
)
def test_failed_records_come_back_as_they_were(spark, data, error):
    row, out = cleanse_one(spark, data)
    assert (row.result, row.error) == ("ProcessingFailed", error)
    assert (out.recordId, out.data, out.year) == ("r1", data or "", None)


def test_each_record_is_parsed_once(spark):
    df = spark.createDataFrame([("r1", pack(GOOD))], RECORD_SCHEMA)
    for part in (cleansing.good_rows, cleansing.failed_rows, cleansing.delivery_records):
        plan = plan_of(part(cleansing.cleanse(df, AS_OF)))
        assert plan.count("from_json(") == 1 and "parse_json(" not in plan and "Python" not in plan


def test_odd_but_good_records_are_delivered_whole(spark):
    """As a lenient JSON reader takes them: the last of repeated members, and NaN as it is."""
    text = json.dumps({**GOOD, "fare_amount": float("nan"), "passenger_count": 1.7, "payment_type": float("inf")})
    row, out = cleanse_one(spark, pack('{"trip_id":"old",' + text[1:-1] + ',"PULocationID":[1,"x"],"DOLocationID":9}'))
    assert (row.result, row.trip_id, row.passenger_count, row.payment_type, row.dolocationid) == ("Ok", "a1", None, None, 9)
    assert row.fare_amount != row.fare_amount
    payload = base64.b64decode(out.data).decode()
    assert '"fare_amount":NaN' in payload and '"payment_type":Infinity' in payload
    values = json.loads(payload)
    assert list(values) == list(cleansing.PAYLOAD)
    assert [values[k] for k in ("trip_id", "passenger_count", "pulocationid", "dolocationid")] == ["a1", 1.7, [1, "x"], 9]


def trip_schema() -> StructType:
    return StructType.fromDDL(ddl(STREAM_TYPES))


def contents(spark, path, sink=None):
    """What is visible in a sink, or in a folder beside it."""
    df = CommittedSink(spark, sink or path).read(path)
    return [] if df is None else df.collect()


# --- streams -------------------------------------------------------------------


def write_envelopes(spark, path, records, name):
    data = [(f"{name}-{i}", pack(r)) for i, r in enumerate(records)]
    spark.createDataFrame(data, RECORD_SCHEMA).coalesce(1).write.mode("append").json(path)


def cleanse_stream(spark, source, sink, bad, checkpoint):
    raw = read_envelopes(spark, source, streaming=True)
    load.run_stream(raw, sink, bad, checkpoint, received_at=AS_OF, inserted_at=AS_OF).awaitTermination()


def test_stream_restart_and_duplicates(spark):
    source, sink, bad, checkpoint = (work_folder(spark, n) for n in ("in", "trips", "bad", "checkpoint"))
    trip = lambda i: {**GOOD, "trip_id": f"t{i}"}
    write_envelopes(spark, source, [trip(1), trip(2), trip(2), "{bad", {**GOOD, "trip_id": None}], "a")
    cleanse_stream(spark, source, sink, bad, checkpoint)
    assert sorted(r.trip_id or "" for r in contents(spark, sink)) == ["", "t1", "t2"]
    assert len(contents(spark, bad, sink)) == 1

    write_envelopes(spark, source, [trip(2), trip(3), "[1]", {**GOOD, "trip_id": None}], "b")
    cleanse_stream(spark, source, sink, bad, checkpoint)
    assert sorted(r.trip_id or "" for r in contents(spark, sink)) == ["", "", "t1", "t2", "t3"]
    assert sorted(r.recordId for r in contents(spark, bad, sink)) == ["a-3", "b-2"]

    # A new checkpoint replays everything: keyed rows stay as they were, and the dead
    # letters of the first stream are not replaced.
    keyed = lambda: sorted(r.trip_id for r in contents(spark, sink) if r.trip_id)
    before = keyed()
    cleanse_stream(spark, source, sink, bad, work_folder(spark, "checkpoint"))
    assert keyed() == before
    assert sorted(r.recordId for r in contents(spark, bad, sink)) == ["a-3", "a-3", "b-2", "b-2"]


def test_repeated_batch_replaces_itself(spark):
    path = work_folder(spark, "batches")
    for batch, n in ((load.Batch("s", 0), 3), (load.Batch("s", 1), 2), (load.Batch("r", 0), 5), (load.Batch("s", 0), 4)):
        commits.write_batch(spark.range(n), path, batch)
    assert rows(spark.read.parquet(path).groupBy("stream_id", "batch_id").count()) == [("r", 0, 5), ("s", 0, 4), ("s", 1, 2)]


def test_sink_columns(spark):
    source, sink, bad = (work_folder(spark, n) for n in ("in", "trips", "bad"))
    write_envelopes(spark, source, [GOOD], "a")
    cleanse_stream(spark, source, sink, bad, work_folder(spark, "checkpoint"))
    assert set(CommittedSink(spark, sink).read().columns) == set(STREAM_TYPES)


def test_good_and_bad_make_up_the_input(spark, folder):
    cleansed = cleansing.cleanse(t.as_envelopes(t.table(spark, folder, "events")), AS_OF)
    good, bad = cleansing.good_rows(cleansed).count(), cleansing.failed_rows(cleansed).count()
    assert good > 0 and bad > 0
    assert good + bad == t.table(spark, folder, "events").count() == cleansing.delivery_records(cleansed).count()


def trips_file(spark, path, *trips):
    data = [
        (i, at(when), at(when), 1, 1, 1, fare, 1, at(when), at(when), at(when), 2024, 1, at(when).day, at(when).hour)
        for i, when, fare in trips
    ]
    spark.createDataFrame(data, ddl(STREAM_TYPES)).coalesce(1).write.mode("append").parquet(path)


def test_file_load_reads_each_file_once(spark):
    landing, sink, ledger, checkpoint = (work_folder(spark, n) for n in ("landing", "trips", "ledger", "checkpoint"))

    def run():
        files = load.file_stream(spark, landing, ddl(STREAM_TYPES), max_files=1)
        load.run_file_load(files, sink, ledger, checkpoint).awaitTermination()
        return len(contents(spark, sink)), len(contents(spark, ledger, sink))

    trips_file(spark, landing, ("a", "10:00:00", 1.0), ("b", "11:00:00", 2.0))
    trips_file(spark, landing, ("b", "11:00:00", 2.0), ("c", "12:00:00", 3.0))
    assert run() == (3, 2)
    trips_file(spark, landing, ("c", "12:00:00", 3.0), ("d", "13:00:00", 4.0))
    assert run() == (4, 3)
    assert run() == (4, 3)


def test_a_bad_file_is_listed_and_tried_again(spark):
    names = ("landing", "trips", "ledger", "failures", "checkpoint")
    landing, sink, ledger, failures, checkpoint = (work_folder(spark, n) for n in names)
    bad = Path(landing.removeprefix("file:")) / "part-bad.parquet"

    def run(**options):
        landed = files.whole_files(spark, landing)
        load.run_tolerant_file_load(landed, trip_schema(), sink, ledger, failures, checkpoint, **options).awaitTermination()
        names = {r.key.split("/")[-1] for r in contents(spark, failures, sink)}
        return sorted(r.trip_id for r in contents(spark, sink)), len(contents(spark, ledger, sink)), names

    trips_file(spark, landing, ("a", "10:00:00", 1.0))
    trips_file(spark, landing, ("a", "10:00:00", 1.0), ("b", "11:00:00", 1.0))
    bad.write_bytes(b"no parquet at all")
    assert run() == (["a", "b"], 2, {"part-bad.parquet"})
    trips_file(spark, landing, ("c", "12:00:00", 1.0))
    assert run() == (["a", "b", "c"], 3, {"part-bad.parquet"})
    mended = work_folder(spark, "mended")
    trips_file(spark, mended, ("d", "13:00:00", 1.0))
    bad.write_bytes(next(Path(mended.removeprefix("file:")).glob("*.parquet")).read_bytes())
    (bad.parent / ".part-bad.parquet.crc").unlink(missing_ok=True)
    assert run() == (["a", "b", "c", "d"], 4, {"part-bad.parquet"})
    assert run() == (["a", "b", "c", "d"], 4, {"part-bad.parquet"})


def test_a_bad_file_is_given_up_when_it_leaves_the_lookback(spark):
    names = ("landing", "trips", "ledger", "failures", "checkpoint")
    landing, sink, ledger, failures, checkpoint = (work_folder(spark, n) for n in names)
    trips_file(spark, landing, ("a", "10:00:00", 1.0))
    for name, age in (("old", 7200), ("new", 60)):
        bad = Path(landing.removeprefix("file:")) / f"part-{name}.parquet"
        bad.write_bytes(b"no parquet")
        os.utime(bad, (time.time() - age,) * 2)
    for _ in range(3):
        landed = files.whole_files(spark, landing)
        load.run_tolerant_file_load(landed, trip_schema(), sink, ledger, failures, checkpoint, lookback="1 hour").awaitTermination()
    tried = Counter(r.key.split("/")[-1] for r in contents(spark, failures, sink))
    assert tried == {"part-old.parquet": 1, "part-new.parquet": 3}


def test_a_file_is_loaded_whole_or_not_at_all(spark):
    landing = work_folder(spark, "landing")
    for k in range(3):
        trips_file(spark, landing, *[(f"{k}-{i}", "10:00:00", 1.0) for i in range(50)])
    spark.createDataFrame([("x", "no number")], "trip_id string, fare_amount string").coalesce(1).write.mode("append").parquet(landing)
    spark.createDataFrame([], "trip_id string").coalesce(1).write.mode("append").parquet(landing)
    spark.createDataFrame([("few", 2.5)], "trip_id string, more double").coalesce(1).write.mode("append").parquet(landing)
    half = sorted(Path(landing.removeprefix("file:")).glob("*.parquet"), key=lambda p: -p.stat().st_size)[0]
    raw = bytearray(half.read_bytes())
    raw[60:400] = bytes(340)  # the footer is whole, the pages are not
    half.write_bytes(raw)
    (half.parent / f".{half.name}.crc").unlink()
    found = files.decode_now(files.read_whole(spark, [landing]), trip_schema())
    marks = found.where("is_file").collect()
    assert len(marks) == 6 and sum(r.reason is not None for r in marks) == 2
    loaded = found.where("NOT is_file")
    failed = [r.source_file for r in marks if r.reason]
    assert loaded.where(F.col("source_file").isin(failed)).count() == 0
    assert [r[1] for r in rows(loaded.groupBy("source_file").count())] in ([1, 50, 50], [50, 1, 50], [50, 50, 1])
    assert loaded.select(*STREAM_TYPES).schema == trip_schema()


def sink_of(spark, path, **options):
    return CommittedSink(spark, path, ["trip_id"], **options)


def load_rows(sink, batch_id, rows_in, stream="s", crash=None):
    """One batch, which may crash before its commit."""
    with sink.load(commits.Batch(stream, batch_id)) as attempt:
        if attempt is not None:
            attempt.add_new(rows_in)
            attempt.beside(rows_in.select("trip_id"), f"{sink.path}-beside")
            if crash:
                raise crash
    return attempt


def landed(spark, *trips):
    folder = work_folder(spark, "landing")
    trips_file(spark, folder, *trips)
    return spark.read.parquet(folder)


def test_a_crashed_batch_is_not_seen_and_a_repeated_one_adds_nothing(spark):
    path = work_folder(spark, "trips")
    first = landed(spark, ("a", "10:00:00", 1.0), (None, "10:00:00", 1.0))
    second = landed(spark, ("b", "11:00:00", 1.0), (None, "11:00:00", 1.0))
    ids = lambda p: sorted(r.trip_id or "" for r in contents(spark, p, path))
    load_rows(sink_of(spark, path), 0, first)
    with pytest.raises(OSError, match="lost"):
        load_rows(sink_of(spark, path), 1, second, crash=OSError("lost"))
    assert ids(path) == ids(f"{path}-beside") == ["", "a"]
    assert spark.read.parquet(path).count() == 4  # what is not seen
    load_rows(sink_of(spark, path), 1, second)
    assert ids(path) == ids(f"{path}-beside") == ["", "", "a", "b"]
    assert load_rows(sink_of(spark, path), 1, second) is None  # run again after its commit
    assert ids(path) == ["", "", "a", "b"]
    assert sink_of(spark, path).remove_left_overs() > 0
    assert spark.read.parquet(path).count() == 4 and ids(path) == ["", "", "a", "b"]


def test_keys_that_move_between_days_are_known(spark):
    path = work_folder(spark, "trips")
    for k, when in enumerate(("10:00:00", "2024-01-03 10:00:00", "2023-12-31 23:59:59")):
        load_rows(sink_of(spark, path, compact_every=2), k, landed(spark, ("a", when, 1.0), (f"only-{k}", when, 1.0)))
    assert sorted(r.trip_id for r in contents(spark, path)) == ["a", "only-0", "only-1", "only-2"]


@pytest.mark.parametrize("compact_every", [1, 3])
def test_index_against_all_that_was_loaded(spark, compact_every):
    path, seen = work_folder(spark, "trips"), {}
    for k in range(6):
        batch = [(f"k{(k * 5 + i) % 17}", "10:00:00", float(k)) for i in range(9)]
        load_rows(sink_of(spark, path, compact_every=compact_every, buckets=4), k, landed(spark, *batch))
        for name, _, fare in batch:
            seen.setdefault(name, fare)
    assert sorted((r.trip_id, r.fare_amount) for r in contents(spark, path)) == sorted(seen.items())
    sink = sink_of(spark, path, buckets=4)
    assert len(commits.folders(spark, f"{path}.commits/deltas", 2)) <= max(2 * compact_every, 1)
    assert sink.commits.read().select("batch_id").distinct().count() == 6


def test_a_batch_reads_the_buckets_of_its_keys(spark):
    path = work_folder(spark, "trips")
    sink = sink_of(spark, path, compact_every=1)
    load_rows(sink, 0, landed(spark, *[(f"k{i}", "10:00:00", 1.0) for i in range(300)]))
    batch = landed(spark, ("k7", "2024-01-09 10:00:00", 1.0), ("new", "10:00:00", 1.0))
    known = sink.known(batch)
    assert 0 < known.count() < 20
    plan = plan_of(known)
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "bucket#" in filters and ("IN" in filters or "=" in filters)
    assert f"{path}/" not in plan  # the sink itself is not read
    load_rows(sink, 1, batch)
    assert len(contents(spark, path)) == 301


def test_a_sink_without_an_index_is_read_once(spark):
    path = work_folder(spark, "trips")
    load_rows(sink_of(spark, path, key_fixes_partition=True), 0, landed(spark, ("a", "10:00:00", 1.0)))
    load_rows(sink_of(spark, path), 1, landed(spark, ("a", "2024-01-05 10:00:00", 1.0), ("b", "10:00:00", 1.0)))
    assert sorted(r.trip_id for r in contents(spark, path)) == ["a", "b"]


def test_load_reads_only_partitions_of_the_batch(spark):
    path = work_folder(spark, "trips")
    batches = [
        [("a", "10:00:00", 1.0), ("b", "11:00:00", 1.0), ("c", "2024-01-03 10:00:00", 1.0)],
        [("b", "11:00:00", 1.0), ("b", "12:00:00", 1.0), ("d", "10:30:00", 1.0)],
    ]
    sink = sink_of(spark, path, key_fixes_partition=True)
    for k, trips in enumerate(batches):
        rows_in = landed(spark, *trips)
        load_rows(sink, k, rows_in)
    assert [r[0] for r in rows(sink.read().select("trip_id"))] == ["a", "b", "c", "d"]
    known = sink.known(rows_in)
    # One by one: hour 11 of the batch's day is touched, that of another day would not be.
    assert [r[0] for r in rows(known.select("trip_id"))] == ["a", "b", "d"]
    filters = plan_of(known).split("PartitionFilters: [")[1].split("]")[0]
    assert "day#" in filters and "dynamicpruning" in filters


def test_partitions_without_a_value_are_compared(spark):
    sink = sink_of(spark, work_folder(spark, "trips"), key_fixes_partition=True)
    nowhere = landed(spark, ("a", "10:00:00", 1.0), ("b", "11:00:00", 1.0)).withColumn("hour", F.lit(None).cast("int"))
    for k in range(2):
        load_rows(sink, k, nowhere)
    assert sink.read().count() == 2


def test_late_rows_go_aside(spark):
    source, sink, late = (work_folder(spark, n) for n in ("in", "sink", "late"))
    checkpoint = work_folder(spark, "checkpoint")

    def run():
        stream = spark.readStream.schema(ddl(STREAM_TYPES)).parquet(source)
        load.run_late_split(stream, sink, late, checkpoint).awaitTermination()
        return [sorted(r.trip_id for r in contents(spark, p, sink)) for p in (sink, late)]

    trips_file(spark, source, ("a", "10:00:00", 1.0), ("b", "05:00:00", 1.0))
    assert run() == [["a", "b"], []]
    trips_file(spark, source, ("c", "09:30:00", 1.0), ("d", "08:59:59", 1.0), ("e", "12:00:00", 1.0))
    assert run() == [["a", "b", "c", "e"], ["d"]]
    trips_file(spark, source, ("f", "10:59:59", 1.0), ("g", "11:00:00", 1.0))
    assert run() == [["a", "b", "c", "e", "g"], ["d", "f"]]
    day = CommittedSink(spark, sink).read().where("day = 1 AND hour = 9")
    assert [r.trip_id for r in day.collect()] == ["c"]
    assert "hour#" in plan_of(day).split("PartitionFilters: [")[1].split("]")[0]


def test_bounded_dedup(spark):
    source, sink = work_folder(spark, "in"), work_folder(spark, "sink")
    trips_file(spark, source, ("a", "10:00:00", 1.0), ("a", "10:00:00", 1.0), ("b", "10:10:00", 1.0))
    stream = spark.readStream.schema(ddl(STREAM_TYPES)).parquet(source)
    writer = load.dedup_within(stream).writeStream.format("parquet").option("path", sink)
    load.start(writer, work_folder(spark, "checkpoint"), once=True).awaitTermination()
    assert [r[0] for r in rows(spark.read.parquet(sink).select("trip_id"))] == ["a", "b"]


def test_stream_hours_equal_batch_hours(spark, folder):
    source, sink, checkpoint = (work_folder(spark, n) for n in ("in", "hours", "checkpoint"))
    parts = t.stream_trips(spark, folder)
    cut = F.lit("2024-01-15 12:30:00").cast("timestamp_ntz")
    for side in (F.col("pickup_datetime") < cut, F.col("pickup_datetime") >= cut):
        parts.where(side).coalesce(1).write.mode("append").parquet(source)
        stream = staging.stg_stream(spark.readStream.schema(parts.schema).parquet(source))
        hourly.run_hourly(hourly.stream_hourly(stream), sink, checkpoint).awaitTermination()
    figures = ["hour", "trips", "round(fare_total, 2)", "round(avg_passenger_count, 6)"]
    streamed = hourly.read_hours(spark, sink).selectExpr(*figures)
    assert rows(streamed) == rows(marts.hourly(staging.stg_stream(parts)).selectExpr(*figures))


def test_final_hours_wait_for_the_watermark(spark, folder):
    source, sink = work_folder(spark, "in"), work_folder(spark, "hours")
    parts = t.stream_trips(spark, folder)
    parts.write.parquet(source)
    stream = staging.stg_stream(spark.readStream.schema(parts.schema).parquet(source))
    writer = hourly.stream_hourly(stream, delay="1 hour").writeStream.format("parquet").option("path", sink)
    load.start(writer, work_folder(spark, "checkpoint"), once=True).awaitTermination()
    final, batch = spark.read.parquet(sink), marts.hourly(staging.stg_stream(parts))
    last = batch.agg(F.max("hour")).first()[0]
    assert final.agg(F.max("hour")).first()[0] < last
    assert final.join(batch, ["hour", "trips"], "left_anti").isEmpty()


def test_fresh_checkpoint_over_an_old_hourly_sink(spark, folder):
    source, sink = work_folder(spark, "in"), work_folder(spark, "hours")
    parts = t.stream_trips(spark, folder)

    def run(checkpoint: str) -> int:
        parts.coalesce(1).write.mode("append").parquet(source)
        stream = staging.stg_stream(spark.readStream.schema(parts.schema).parquet(source))
        hourly.run_hourly(hourly.stream_hourly(stream), sink, checkpoint).awaitTermination()
        return hourly.read_hours(spark, sink).agg(F.sum("trips")).first()[0]

    checkpoint, once = work_folder(spark, "checkpoint"), parts.count()
    assert [run(checkpoint), run(checkpoint), run(work_folder(spark, "checkpoint"))] == [once, 2 * once, 3 * once]


def test_hours_from_snapshots(spark, folder, compact_every=2):
    source, sink, checkpoint = (work_folder(spark, n) for n in ("in", "hours", "checkpoint"))
    parts = t.stream_trips(spark, folder)
    days = [f"2024-01-{d:02d} 00:00:00" for d in (1, 8, 15, 22)] + ["2024-03-01 00:00:00"]
    time = F.col("pickup_datetime")
    for k, (low, high) in enumerate(zip(days, days[1:], strict=False)):
        low, high = (F.lit(x).cast("timestamp_ntz") for x in (low, high))
        parts.where((time >= low - F.expr("INTERVAL 1 DAY")) & (time < high)).coalesce(1).write.mode("append").parquet(source)
        stream = staging.stg_stream(spark.readStream.schema(parts.schema).parquet(source))
        hourly.run_hourly(hourly.stream_hourly(stream), sink, checkpoint, compact_every=compact_every).awaitTermination()
        figures = ["hour", "trips", "round(fare_total, 2)", "round(avg_passenger_count, 6)"]
        whole = marts.hourly(staging.stg_stream(spark.read.parquet(source))).selectExpr(*figures)
        assert rows(hourly.read_hours(spark, sink).selectExpr(*figures)) == rows(whole), k
    log = commits.Log(spark, sink)
    assert len(log.versions()) == 2 and len(commits.folders(spark, f"{sink}/deltas", 2)) == 2


def test_fill_defaults(spark):
    df = spark.createDataFrame([(None, None, None, None, None)], "passenger_count bigint, fare_amount double, payment_type bigint, pulocationid int, dolocationid int")
    assert rows(fill_defaults(df)) == [(1, 0.0, 1, 0, 0)]


def test_work_folder_needs_a_shared_place(spark):
    assert work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert work_folder(spark, "x") != work_folder(spark, "x")
    with conf_set(spark, spark__sql__shuffle__partitions="3"):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_no_python_workers_in_any_plan(spark, folder):
    from tripmill.workload.queries import REGISTRY

    for name in ("trip_zone", "usage_cost", "cleanse_delivery", "cumulative_per_minute", "live_kpis"):
        plan = plan_of(REGISTRY[name](spark, folder))
        assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan, name


