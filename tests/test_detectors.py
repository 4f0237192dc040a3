from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from streams import lines

from tidemark.functions.text import PAID, PAID_LATE, PAID_UNKNOWN, TIMED_OUT
from tidemark.operators import (
    Step,
    cap_per_key_per_day,
    fail_pairs,
    fail_runs,
    match_sequence,
    order_pay_status,
    running_count_per_day,
    running_unique_count,
    top_n,
)
from tidemark.plans import jobs

def at(second):
    return dt.datetime.fromtimestamp(second, dt.timezone.utc).replace(tzinfo=None)


def frame(spark, rows, columns):
    return spark.createDataFrame(rows, columns).withColumn("ts", F.timestamp_seconds("second")).drop("second")


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows belongs to user 1, another third to no user at all."""
    rng = random.Random(7)
    rows = []
    for i in range(600):
        user = (1, None, rng.randrange(2, 30))[i % 3]
        rows.append((i, user, rng.choice(["a", "b", "c", "d"]), 1_700_000_000 + rng.randrange(100_000)))
    return frame(spark, rows, "seq BIGINT, user BIGINT, kind STRING, second BIGINT").cache()


@pytest.fixture(scope="module")
def arrived(skewed):
    """The same rows with their place in time as a number: in that order a group is one bin."""
    return skewed.withColumn("place", F.row_number().over(Window.orderBy("ts", "seq"))).cache()


def both_ways(arrived, job):
    bins, one = job(arrived, ["ts", "seq"]), job(arrived, ["place"])
    assert lines(bins) == lines(one)
    assert bins.count() > 0


def test_bins_of_time_change_nothing(arrived):
    both_ways(arrived, lambda df, order: running_count_per_day(df, "user", "ts", order))
    both_ways(arrived, lambda df, order: fail_pairs(df, "user", "kind", "ts", 600, order, "a"))
    for least in (1, 2, 3):
        both_ways(arrived, lambda df, order: fail_runs(df, "user", "kind", "ts", 30_000, least, order, "a"))


def runs_by_hand(rows, span, least):
    found, length, first = [], 0, None
    for when, failed in rows:
        length, first = (length + 1, first if length else when) if failed else (0, None)
        if failed and length == least and when - first < span:
            found.append((first, when))
    return found


def test_runs_over_many_bins(spark):
    rng = random.Random(2)
    rows, expected = [], []
    for user in (1, 2, 3, None):
        times = sorted(rng.sample(range(200_000), 120))
        events = [(t, rng.random() < (0.97 if user == 1 else 0.7)) for t in times]
        rows += [(user, t, "fail" if f else None) for t, f in events]
        expected += [(user, at(a), at(b)) for a, b in runs_by_hand(events, 40_000, 6)]
    df = frame(spark, rows, "user BIGINT, second BIGINT, status STRING")
    found = fail_runs(df, "user", "status", "ts", 40_000, 6).collect()
    assert sorted(((r.user, r.first_fail, r.last_fail) for r in found), key=str) == sorted(expected, key=str)
    assert expected


def test_running_distinct_over_bins(arrived):
    counted = running_unique_count(arrived, "seq", "ts", "1 day", ["seq"]).collect()
    by_window = {}
    for r in sorted(counted, key=lambda r: (r.window_end, r.first_seen, r.id)):
        by_window.setdefault(r.window_end, []).append(r["count"])
    assert all(counts == list(range(1, len(counts) + 1)) for counts in by_window.values())


def test_plans_stay_small_and_building_them_runs_nothing(spark, skewed):
    leaves = lambda df: df._jdf.queryExecution().optimizedPlan().collectLeaves().size()
    before = spark.sparkContext.statusTracker().getJobIdsForGroup()
    sizes = [leaves(fail_runs(skewed, "user", "kind", "ts", 3000, k, fail="a")) for k in (2, 8)]
    steps = [Step(f"s{i}", F.col("kind") == "abcd"[i % 4]) for i in range(5)]
    sequences = [leaves(match_sequence(skewed, "user", "ts", steps[:n], "1 hour")) for n in (2, 5)]
    assert sizes[0] == sizes[1] and sequences == [1, 1]
    assert spark.sparkContext.statusTracker().getJobIdsForGroup() == before


def test_ranks_of_any_type_and_number(spark):
    low, nan = -(2**63), float("nan")
    cases = [
        ("metric DOUBLE", [5.0, 7.0, nan, None], [nan, 7.0, 5.0, None]),
        ("metric STRING", ["a", "c", None, "b"], ["c", "b", "a", None]),
        ("metric BIGINT", [low, 3, None, 2**63 - 1], [2**63 - 1, 3, low, None]),
        ("metric TIMESTAMP", [at(5), at(9), None, at(7)], [at(9), at(7), at(5), None]),
    ]
    for column, values, expected in cases:
        df = spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], f"k INT, tie INT, {column}")
        for n in (2, 4, 1000, 100_000):
            ranked = sorted(top_n(df, "k", "metric", "tie", n).collect(), key=lambda r: r["rank"])
            assert str([r.metric for r in ranked]) == str(expected[:n])


def test_daily_cap_keeps_the_first_rows_and_warns_once(spark):
    rows = [(i, 1, 1_700_000_000 + i) for i in range(8)] + [(8, 2, 1_700_000_000), (9, 1, 1_700_090_000)]
    df = frame(spark, rows, "seq BIGINT, user BIGINT, second BIGINT")
    for limit in (3, 5000):
        passed, warnings = cap_per_key_per_day(df, "user", "ts", limit, ["seq"])
        assert passed.columns == df.columns
        assert sorted(r.seq for r in passed.collect()) == ([0, 1, 2, 8, 9] if limit == 3 else list(range(10)))
        expected = [(1, at(1_700_000_003), "click over3times today")] if limit == 3 else []
        assert [tuple(r) for r in warnings.collect()] == expected
    custom = cap_per_key_per_day(df, "user", "ts", 3, ["seq"], message="too many")[1]
    assert custom.first().message == "too many"


LOGINS = [
    (0, 1, "fail", 100),
    (1, 1, "fail", 101),
    (2, 1, "fail", 103),  # exactly 2 s after the one before
    (3, 1, "success", 104),
    (4, 1, "fail", 104),
    (5, 2, "fail", 50),
    (6, 2, "fail", 49),  # arrives later, one second earlier
    (7, 3, "fail", 10),
    (8, 3, None, 10),
    (9, 3, "fail", 11),
]


def test_fail_pairs_in_order_of_arrival(spark):
    df = frame(spark, LOGINS, "seq BIGINT, user_id BIGINT, status STRING, second BIGINT")
    pairs = fail_pairs(df, "user_id", "status", "ts", 2, ["seq"]).collect()
    assert {(r.user_id, r.first_fail, r.last_fail) for r in pairs} == {
        (1, at(100), at(101)),
        (2, at(50), at(49)),
    }
    assert {r.message for r in pairs} == {"login fail in 2 seconds"}


def test_fail_runs_warn_once_per_run(spark):
    df = frame(spark, LOGINS, "seq BIGINT, user_id BIGINT, status STRING, second BIGINT")
    runs = fail_runs(df, "user_id", "status", "ts", 4, 3, ["ts", "seq"]).collect()
    assert [(r.user_id, r.first_fail, r.last_fail) for r in runs] == [(1, at(100), at(103))]
    assert fail_runs(df, "user_id", "status", "ts", 3, 3, ["ts", "seq"]).count() == 0


def test_login_sequences_use_event_time(spark):
    df = frame(spark, LOGINS, "seq BIGINT, user_id BIGINT, status STRING, second BIGINT")
    found = jobs.login_fail_sequences(df, "2 seconds", ["seq"]).collect()
    assert {(r.user_id, r.first_fail, r.last_fail) for r in found} == {(1, at(100), at(101)), (2, at(49), at(50))}


ORDERS = [
    (0, 1, "create", "", 0),
    (1, 1, "pay", "x1", 899),
    (2, 2, "create", "", 0),
    (3, 2, "pay", "x2", 900),  # exactly at the limit
    (4, 3, "create", "", 5),
    (5, 4, "pay", "x4", 5),
    (6, 5, "pay", "x5", 7),
    (7, 5, "create", "", 7),  # same time: the create counts first
    (8, 6, "create", "", 0),
    (9, 6, "create", "", 900),  # replaces an expired one
    (10, 6, "pay", "", 910),  # no transaction id
    (11, 7, "create", "", 0),
    (12, 7, "create", "", 10),  # replaces an open one
    (13, 7, "other", "", 11),
    (14, 7, "pay", "x7", 12),
]


def test_order_outcomes(spark):
    df = frame(spark, ORDERS, "seq BIGINT, order_id BIGINT, event_type STRING, tx_id STRING, second BIGINT")
    got = order_pay_status(df, "order_id", "event_type", "ts", order_by=["seq"]).collect()
    assert sorted((r.order_id, r.result) for r in got) == [
        (1, PAID),
        (2, PAID_LATE),
        (3, TIMED_OUT),
        (4, PAID_UNKNOWN),
        (5, PAID),
        (6, PAID),
        (6, TIMED_OUT),
        (7, PAID),
    ]


def test_orders_are_given_up_in_the_end(spark):
    rows = [(0, 1, "create", 0), (1, 1, "pay", 900 + 86_400), (2, 2, "create", 0), (3, 2, "pay", 899 + 86_400)]
    rows += [(4, 3, "create", 0), (5, 3, "create", 100_000), (6, 3, "pay", 100_001)]
    df = frame(spark, rows, "seq BIGINT, order_id BIGINT, event_type STRING, second BIGINT")
    got = order_pay_status(df, "order_id", "event_type", "ts", order_by=["seq"]).collect()
    assert sorted((r.order_id, r.result) for r in got) == sorted(
        [(1, TIMED_OUT), (1, PAID_UNKNOWN), (2, PAID_LATE), (3, TIMED_OUT), (3, PAID)]
    )


def test_order_sequences(spark):
    df = frame(spark, ORDERS, "seq BIGINT, order_id BIGINT, event_type STRING, tx_id STRING, second BIGINT")
    got = jobs.order_timeouts(df, order_by=["seq"]).collect()
    assert sorted((r.order_id, r.create_ts, r.result) for r in got) == [
        (1, at(0), PAID),
        (2, at(0), TIMED_OUT),
        (3, at(5), TIMED_OUT),
        (5, at(7), TIMED_OUT),
        (6, at(0), TIMED_OUT),
        (6, at(900), TIMED_OUT),
        (7, at(0), PAID),
        (7, at(10), PAID),
    ]


def follow(events, kinds, contiguity, within):
    """Every start looked at on its own, event by event."""
    found = []
    for i, (start, kind) in enumerate(events):
        if kind != kinds[0]:
            continue
        times, output = [start], "timeout"
        for when, other in events[i + 1 :]:
            if when - start >= within:
                break
            if other == kinds[len(times)]:
                times.append(when)
                if len(times) == len(kinds):
                    output = "matched"
                    break
            elif contiguity[len(times)] == "next":
                output = None
                break
        if output:
            found.append((*times, *[None] * (len(kinds) - len(times)), output))
    return found


@pytest.mark.parametrize("second", ["next", "followed_by"])
@pytest.mark.parametrize("third", ["next", "followed_by"])
@pytest.mark.parametrize("kinds", ["abc", "aab", "aaa"])
def test_sequences_event_by_event(spark, kinds, second, third):
    rng = random.Random(kinds + second + third)
    rows, expected = [], []
    for user in range(40):
        times = sorted(rng.sample(range(200), 12))
        events = [(t, rng.choice("aabc")) for t in times]
        rows += [(user, t, k) for t, k in events]
        expected += [(user, *row) for row in follow(events, kinds, [None, second, third], 40)]
    df = frame(spark, rows, "user BIGINT, second BIGINT, kind STRING")
    names = ["first", "second", "third"]
    steps = [Step(n, F.col("kind") == k, c) for n, k, c in zip(names, kinds, ["next", second, third])]
    got = match_sequence(df, "user", "ts", steps, 40)
    epoch = [F.unix_seconds(f"{n}_ts") for n in names]
    result = [tuple(r) for r in got.select("user", *epoch, "output").collect()]
    assert sorted(result, key=str) == sorted(expected, key=str)


def test_sequence_without_timeouts_and_bad_steps(spark):
    df = frame(spark, [(1, 0, "a"), (1, 5, "b"), (2, 0, "a")], "user BIGINT, second BIGINT, kind STRING")
    steps = [Step("x", F.col("kind") == "a"), Step("y", F.col("kind") == "b")]
    assert match_sequence(df, "user", "ts", steps, 10, on_timeout=False).count() == 1
    assert match_sequence(df, "user", "ts", steps, 10).count() == 2
    with pytest.raises(ValueError):
        match_sequence(df, "user", "ts", steps[:1], 10)
    with pytest.raises(ValueError):
        match_sequence(df, "user", "ts", [steps[0], Step("y", F.lit(True), "later")], 10)


def test_rows_without_a_time_are_kept(spark):
    from tidemark.operators.detectors import fail_runs, order_pay_status, running_count_per_day

    df = spark.sql("SELECT * FROM VALUES (1, timestamp'2024-01-01 10:00:00', 'fail'), (1, NULL, 'fail'), (1, NULL, 'fail') AS t(k, ts, status)")
    found = running_count_per_day(df, "k", "ts").collect()
    assert sorted((r["ts"] is None, r["count"]) for r in found) == [(False, 1), (True, 1), (True, 2)]
    runs = fail_runs(df, "k", "status", "ts", span=2, min_fails=1).collect()
    assert len(runs) == 0
    orders = spark.sql("SELECT 1 AS k, CAST(NULL AS timestamp) AS ts, 'pay' AS kind")
    assert [r["create_ts"] for r in order_pay_status(orders, "k", "kind", "ts").collect()] == [None]
