"""Interval operators against brute force, with crowded buckets, ragged ends and ties."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from tests.conftest import at, rows
from tripmill.operators.intervals import first_following, overlap_join, running_total

BASE = dt.datetime(2024, 1, 1)


def moments(rng, n, span, step=1):
    return [BASE + dt.timedelta(microseconds=rng.randrange(0, span * 1_000_000, step)) for _ in range(n)]


@pytest.mark.parametrize("width", [1, 60, 3600])
def test_overlap_pairs(spark, width):
    rng = random.Random(width)
    left = [(i, s, s + dt.timedelta(seconds=rng.choice([0, 1, 30, 60, 61, 4000]))) for i, s in enumerate(moments(rng, 120, 7200, 500_000))]
    # A third of the left side crowds into one minute.
    left += [(200 + i, BASE + dt.timedelta(seconds=600 + i % 60), BASE + dt.timedelta(seconds=660)) for i in range(60)]
    left += [(300, BASE + dt.timedelta(seconds=900), BASE + dt.timedelta(seconds=850)), (301, BASE, None)]
    right = [(i, BASE + dt.timedelta(minutes=i), BASE + dt.timedelta(minutes=i + 1)) for i in range(0, 130, 2)]
    right += [(500, BASE + dt.timedelta(seconds=31), BASE + dt.timedelta(seconds=5000)), (501, BASE, BASE)]
    expected = sorted(
        (a, b) for a, s, e in left for b, ms, me in right if e is not None and s < me and e > ms
    )
    pairs = overlap_join(
        spark.createDataFrame(left, "a int, start_time timestamp_ntz, end_time timestamp_ntz"),
        spark.createDataFrame(right, "b int, minute_start timestamp_ntz, minute_end timestamp_ntz"),
        width=width,
    )
    assert sorted((r.a, r.b) for r in pairs.collect()) == expected


@pytest.mark.parametrize("step", [1, 250_000, 1_000_000, 60_000_000])
def test_first_following(spark, step):
    rng = random.Random(step)
    days = 5 * 86400
    points = [(i, t) for i, t in enumerate(moments(rng, 80, days, step))]
    points += [(1000 + i, BASE + dt.timedelta(days=1, seconds=5, microseconds=(i % 7) * step)) for i in range(40)]
    points.append((2000, None))
    probes = [(i, t) for i, t in enumerate(moments(rng, 200, days + 86400, step))]
    probes += [(500 + i, t) for i, (_, t) in enumerate(points)]
    known = sorted((t, i) for i, t in points if t is not None)
    expected = []
    for p, t in probes:
        later = [k for k in known if t is not None and k[0] >= t]
        expected.append((p, *(later[0] if later else (None, None))))
    found = first_following(
        spark.createDataFrame(probes, "p int, t timestamp_ntz"),
        spark.createDataFrame(points, "q int, start timestamp_ntz"),
        "t", "start", "q",
    )
    assert sorted(((r.p, r.next_time, r.next_id) for r in found.collect()), key=repr) == sorted(expected, key=repr)


def test_first_following_without_points(spark):
    probes = spark.createDataFrame([(1, at("10:00:00"))], "p int, t timestamp_ntz")
    points = spark.createDataFrame([], "q int, start timestamp_ntz")
    assert rows(first_following(probes, points, "t", "start", "q")) == [(1, at("10:00:00"), None, None)]


def test_running_total_over_days(spark):
    data = [(BASE + dt.timedelta(minutes=317 * i), i) for i in range(40)]
    df = spark.createDataFrame(data, "minute timestamp_ntz, n bigint")
    got = [(r.minute, r.cumulative) for r in running_total(df, "minute", "n").orderBy("minute").collect()]
    assert got == [(t, sum(range(i + 1))) for t, i in data]
