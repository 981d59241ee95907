from __future__ import annotations

import datetime as dt
import random

import pytest

from tests.conftest import at, plan_of, rows
from tripmill.plans import cost

HISTORY = "query_id bigint, start_time timestamp_ntz, end_time timestamp_ntz, execution_time bigint, bytes_scanned bigint, warehouse_name string"
METER = "start_time timestamp_ntz, end_time timestamp_ntz, charged_seconds double"


def history(spark, *spans):
    return spark.createDataFrame([(i, s, e, 0, 0, "w") for i, s, e in spans], HISTORY)


def minutes(spark, *starts):
    return spark.createDataFrame([(s, s + dt.timedelta(minutes=1), 60.0) for s in starts], METER)


def test_credit_cost(spark):
    h = history(spark, (1, at("10:00:00"), at("10:01:00")), (2, at("09:00:00"), at("09:01:00")), (3, at("08:00:00"), at("08:01:00")))
    a = spark.createDataFrame([(1, 0.03127), (3, 5.0)], "query_id bigint, credits_attributed_compute double")
    got = cost.credit_cost(h, a, cost.inline_ids(spark, [1, 2], "bigint")).collect()
    assert [(r.query_id, r.credits_compute, r.cost_usd) for r in got] == [(2, None, None), (1, 0.03127, 0.0625)]
    half = cost.credit_cost(h, a, cost.inline_ids(spark, [1], "bigint"), price="1.0").first()
    assert half.cost_usd == 0.0313


def test_usage_by_hand(spark):
    h = history(
        spark,
        (1, at("10:00:10"), at("10:01:30")),  # selected, minutes 0 and 1
        (2, at("10:01:10"), at("10:01:20")),  # another query in minute 1
        (3, at("10:05:00"), at("10:05:30")),  # selected, after two idle minutes
    )
    m = minutes(spark, *[at(f"10:0{i}:00") for i in (0, 1, 2, 3, 5, 6)])
    got = cost.usage_cost(h, m, cost.inline_ids(spark, [1, 3], "bigint")).collect()
    # The idle minute 6 has no later selected query, so nobody pays it.
    assert [(r.query_id, r.rpu_seconds_attributed, r.exec_ms) for r in got] == [(1, 90.0, 80_000), (3, 180.0, 30_000)]
    assert [r.cost_usd for r in got] == [0.0094, 0.0188]


@pytest.mark.parametrize("seed", [1, 2])
def test_usage_against_brute_force(spark, seed):
    rng = random.Random(seed)
    base = at("2024-01-01 22:00:00")
    spans = []
    for i in range(150):
        s = base + dt.timedelta(seconds=rng.randrange(0, 5 * 3600))
        spans.append((i, s, s + dt.timedelta(seconds=rng.choice([5, 40, 90, 400]))))
    crowded = base + dt.timedelta(minutes=30)
    spans += [(200 + i, crowded + dt.timedelta(seconds=i % 50), crowded + dt.timedelta(seconds=55)) for i in range(75)]
    # Metering that does not start on whole minutes, and one equal pair of records.
    starts = [base + dt.timedelta(seconds=60 * i + 13) for i in range(-4, 320) if rng.random() < 0.8]
    meter = minutes(spark, *starts, starts[5])
    chosen = [i for i, _, _ in spans if i % 3 == 0]

    mine = [x for x in spans if x[0] in chosen]
    low = min(s for _, s, _ in mine) - dt.timedelta(minutes=2)
    high = max(e for _, _, e in mine) + dt.timedelta(minutes=1)
    windows = sorted({(s, s + dt.timedelta(minutes=1)) for s in starts if s + dt.timedelta(minutes=1) > low and s < high})
    running = {w: [i for i, s, e in spans if s < w[1] and e > w[0]] for w in windows}
    expected = dict.fromkeys(chosen, 0.0)
    for w, ids in running.items():
        for i in ids:
            if i in expected:
                expected[i] += 60.0 / len(ids)
        if not ids:
            later = sorted((s, i) for i, s, _ in mine if s >= w[1])
            if later:
                expected[later[0][1]] += 60.0
    ids = cost.inline_ids(spark, chosen, "bigint")
    h = history(spark, *spans)
    got = {r.query_id: r.rpu_seconds_attributed for r in cost.usage_cost(h, meter, ids).collect()}
    assert got == pytest.approx(expected)
    conc = cost.minute_concurrency(cost.billed_minutes(meter, cost.selected_queries(h, ids)), h, ids)
    assert rows(conc.select("minute_start", "running_all", "running_my")) == sorted(
        [(w[0], len(r), sum(i in expected for i in r)) for w, r in running.items()], key=repr
    )


def test_every_second_is_attributed(spark):
    """With only selected queries running, all billed seconds but trailing idle ones are paid."""
    spans = [(i, at("10:00:00") + dt.timedelta(minutes=7 * i), at("10:01:30") + dt.timedelta(minutes=7 * i)) for i in range(6)]
    meter = minutes(spark, *[at("10:00:00") + dt.timedelta(minutes=i) for i in range(36)])
    got = cost.usage_cost(history(spark, *spans), meter, cost.inline_ids(spark, range(6), "bigint"))
    assert got.selectExpr("sum(rpu_seconds_attributed)").first()[0] == pytest.approx(36 * 60.0)


def test_no_nested_loops(spark):
    h = history(spark, (1, at("10:00:10"), at("10:01:30")))
    plan = plan_of(cost.usage_cost(h, minutes(spark, at("10:00:00")), cost.inline_ids(spark, [1], "bigint")))
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_open_ended_history_and_selection(spark):
    """One interval of ten years and one without end neither fail nor make rows outside the minutes."""
    history = spark.createDataFrame(
        [
            ("a", at("10:00:10"), at("10:02:30")),
            ("b", at("2015-01-01 00:00:00"), at("2025-01-01 00:00:00")),
            ("c", at("10:01:00"), at("9999-12-31 23:59:59")),
        ],
        "query_id string, start_time timestamp_ntz, end_time timestamp_ntz",
    )
    metering = spark.createDataFrame(
        [(at(f"10:{m:02d}:00"), at(f"10:{m + 1:02d}:00"), 60) for m in range(5)],
        "start_time timestamp_ntz, end_time timestamp_ntz, charged_seconds int",
    )
    for chosen in (["a"], ["a", "c"]):
        ids = cost.inline_ids(spark, chosen)
        selected = cost.selected_queries(history, ids)
        minutes = cost.billed_minutes(metering, selected)
        concurrency = cost.minute_concurrency(minutes, history, ids)
        got = {r.minute_start.minute: (r.running_all, r.running_my) for r in concurrency.collect()}
        c = int("c" in chosen)
        want = {0: (2, 1), 1: (3, 1 + c), 2: (3, 1 + c), 3: (2, c), 4: (2, c)}
        assert got == {m: n for m, n in want.items() if m in got} and len(got) >= 3
        assert cost.usage_cost(history, metering, ids).count() == len(chosen)
    none = cost.inline_ids(spark, ["nobody"])
    assert cost.usage_cost(history, metering, none).count() == 0


def test_history_is_cut_at_the_scan(spark, tmp_path):
    from tripmill.workload import tables as t

    folder, path = "/root/testdata/sf0.001", f"{tmp_path}/history"
    t.query_history(spark, folder).write.parquet(path)
    history, ids = spark.read.parquet(path), t.chosen_queries(spark, folder).limit(1)
    minutes = cost.billed_minutes(t.metering(spark, folder), cost.selected_queries(history, ids))
    plan = plan_of(cost.minute_concurrency(minutes, history, ids))
    pushed = plan.split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert "LessThan(start_time" in plan and "GreaterThan(end_time" in plan, pushed
