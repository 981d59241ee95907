"""Time columns. All expect zone-less timestamps under a UTC session."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = "Column | str | dt.datetime | None"


def as_of_column(as_of=None) -> Column:
    """The instant that stands for "now": a column, a literal, or the wall clock."""
    if as_of is None:
        return F.localtimestamp()
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def hour_start(ts: Column) -> Column:
    return F.date_trunc("HOUR", ts).cast("timestamp_ntz")


def minute_start(ts: Column) -> Column:
    return F.date_trunc("MINUTE", ts).cast("timestamp_ntz")


def month_start(ts: Column) -> Column:
    return F.trunc(ts, "MM")


def month_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def elapsed_minutes(start: Column, end: Column) -> Column:
    """Whole minutes between two instants, cut toward zero."""
    return ((F.unix_timestamp(end) - F.unix_timestamp(start)) / 60).cast("int")


def boundary_minutes(start: Column, end: Column) -> Column:
    """Minute boundaries crossed: 10:00:59 to 10:01:00 counts one."""
    return (
        F.floor(F.unix_timestamp(end) / 60) - F.floor(F.unix_timestamp(start) / 60)
    ).cast("int")


def boundary_seconds(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def boundary_millis(start: Column, end: Column) -> Column:
    return F.unix_millis(end.cast("timestamp")) - F.unix_millis(start.cast("timestamp"))


def delay_minutes(received: Column, inserted: Column) -> Column:
    return F.round(boundary_seconds(received, inserted).cast("decimal(18,0)") / 60, 2).cast("double")


def in_zone(ts: Column, zone: str) -> Column:
    """Wall clock in ``zone`` of a UTC wall clock."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


def within_minutes(ts: Column, as_of, minutes: int) -> Column:
    return ts >= as_of_column(as_of) - F.expr(f"INTERVAL {int(minutes)} MINUTES")


def within_days(ts: Column, as_of, days: int) -> Column:
    """From the start of the day ``days`` before; no upper bound."""
    first = F.date_sub(F.to_date(as_of_column(as_of)), int(days))
    return ts >= first.cast("timestamp_ntz")


def month_range(ts: Column, year: int, month: int) -> Column:
    """Half-open month. Unlike year(ts) = y AND month(ts) = m, both bounds reach the scan."""
    first = dt.date(year, month, 1)
    after = dt.date(year + month // 12, month % 12 + 1, 1)
    return (ts >= F.lit(f"{first} 00:00:00").cast("timestamp_ntz")) & (
        ts < F.lit(f"{after} 00:00:00").cast("timestamp_ntz")
    )


# Fixed formats of the stream records: date and time with a blank or a T, one-digit
# parts allowed; event times carry an offset and perhaps a fraction.
RECORD_TIME = r"^(\d{4}-\d{1,2}-\d{1,2})\s+(\d{1,2}:\d{1,2}:\d{1,2})$"
EVENT_TIME = (
    r"^(\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2})(?:\.\d{1,6})?"
    r"(?:Z|[+-]\d{2}:?[0-5]\d(?::?[0-5]\d(?:\.\d{1,6})?)?)$"
)


def parse_record_time(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` or NULL."""
    tidy = F.regexp_extract(text, RECORD_TIME, 1), F.regexp_extract(text, RECORD_TIME, 2)
    return F.try_to_timestamp(F.concat_ws(" ", *tidy), F.lit("yyyy-M-d H:m:s")).cast("timestamp_ntz")


def parse_event_time(text: Column, mode: str = "wall_clock") -> Column:
    """ISO time with offset, to the second, or NULL.

    ``wall_clock`` keeps the clock reading and drops the offset; ``utc`` converts.
    """
    if mode == "wall_clock":
        clock = F.regexp_extract(text, EVENT_TIME, 1)
        return F.try_to_timestamp(clock, F.lit("yyyy-M-d'T'H:m:s")).cast("timestamp_ntz")
    if mode == "utc":
        instant = F.when(text.rlike(EVENT_TIME), text).try_cast("timestamp")
        return F.date_trunc("SECOND", instant).cast("timestamp_ntz")
    raise ValueError(f"unknown mode: {mode}")
