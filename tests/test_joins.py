from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import interval_join, prefixed, reconcile, split_outputs, tagged, window_join
from tidemark.plans import jobs


@pytest.fixture(scope="module")
def sides(spark):
    """Key 0 holds a third of each side; keys may be null; times lie on half seconds."""
    rng = random.Random(3)
    pick = lambda: rng.choice([0, 0, None, *range(1, 5)])
    left = [(i, pick(), rng.randrange(0, 400) / 2) for i in range(120)]
    right = [(i, pick(), rng.randrange(0, 400) / 2) for i in range(150)]
    a = spark.createDataFrame(left, "a_id BIGINT, k BIGINT, a_sec DOUBLE")
    b = spark.createDataFrame(right, "b_id BIGINT, k BIGINT, b_sec DOUBLE")
    timed = lambda df, side: df.select(
        f"{side}_id", "k", F.timestamp_micros((F.col(f"{side}_sec") * 1_000_000).cast("bigint")).alias(f"{side}_ts")
    )
    return left, right, timed(a, "a"), timed(b, "b")


def pairs_by_hand(left, right, fits):
    return sorted((i, j) for i, k, s in left for j, m, t in right if k is not None and k == m and fits(s, t))


@pytest.mark.parametrize("lo, hi", [(-3, 5), (0, 0), (-40, -10), (7, 300)])
def test_interval_join_and_reconciliation_by_hand(sides, lo, hi):
    left, right, a, b = sides
    expected = pairs_by_hand(left, right, lambda s, t: s + lo <= t <= s + hi)
    inner = interval_join(a, b, "k", "a_ts", "b_ts", lo, hi)
    assert inner.columns == ["a_id", "k", "a_ts", "b_id", "b_ts"]
    assert sorted((r.a_id, r.b_id) for r in inner.collect()) == expected
    outer = interval_join(a, b, "k", "a_ts", "b_ts", lo, hi, "left").collect()
    alone = {i for i, *_ in left} - {i for i, _ in expected}
    assert sorted((r.a_id, r.b_id) for r in outer if r.b_id is not None) == expected
    assert sorted(r.a_id for r in outer if r.b_id is None) == sorted(alone)
    rows = reconcile(a, b, "k", "a_ts", "b_ts", lo, hi, ("both", "a", "b"))
    parts = {tag: df.collect() for tag, df in split_outputs(rows, ("both", "a", "b")).items()}
    assert sorted((r.a_id, r.b_id) for r in parts["both"]) == expected
    assert sorted(r.a_id for r in parts["a"]) == sorted(alone)
    assert sorted(r.b_id for r in parts["b"]) == sorted({j for j, *_ in right} - {j for _, j in expected})
    assert all(r.a_ts is None for r in parts["b"]) and all(r.b_ts is None for r in parts["a"])


@pytest.mark.parametrize("size, slide", [(15, None), (20, 5), (10, 4)])
def test_window_join_by_hand(sides, size, slide):
    left, right, a, b = sides
    step = slide or size
    expected = []
    for start in range(-100, 400):
        if start % step == 0:
            inside = lambda s, start=start: start <= s < start + size
            expected += [(start, *p) for p in pairs_by_hand(left, right, lambda s, t: inside(s) and inside(t))]
    got = window_join(a, b, "k", "a_ts", "b_ts", size, slide)
    starts = got.select(F.unix_seconds("window_start"), "a_id", "b_id").collect()
    assert sorted(tuple(r) for r in starts) == sorted(expected)


def test_bounds_are_included_and_ids_required(spark):
    orders = [(1, "pay", "t1", 100), (2, "pay", "t2", 100), (3, "pay", "", 100), (4, "create", "t4", 100)]
    receipts = [("t1", "alipay", 97), ("t2", "wechat", 105), ("t9", "wechat", 100)]
    o = spark.createDataFrame(orders, "order_id BIGINT, event_type STRING, tx_id STRING, second BIGINT")
    r = spark.createDataFrame(receipts, "tx_id STRING, pay_channel STRING, second BIGINT")
    timed = lambda df: df.withColumn("ts", F.timestamp_seconds("second")).drop("second")
    rows = jobs.tx_match(timed(o), timed(r)).collect()
    assert sorted((x.tx_id, x.output) for x in rows) == [
        ("t1", "matched"),
        ("t2", "matched"),
        ("t9", "unmatched_receipt"),
    ]
    assert {x.receipt_ts for x in rows} == {dt.datetime.fromtimestamp(s, dt.timezone.utc).replace(tzinfo=None) for s in (97, 105, 100)}


def test_no_join_compares_all_rows_of_a_key(sides):
    _, _, a, b = sides
    for job in (
        interval_join(a, b, "k", "a_ts", "b_ts", -3, 5),
        reconcile(a, b, "k", "a_ts", "b_ts", -3, 5),
        window_join(a, b, "k", "a_ts", "b_ts", 15),
    ):
        plan = job._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_prefix_and_tag(spark):
    df = spark.createDataFrame([(1, "x")], "k BIGINT, v STRING")
    assert prefixed(df, "pay_", ["k"]).columns == ["k", "pay_v"]
    assert tagged(df, "agg").first().asDict() == {"output": "agg", "k": 1, "v": "x"}
    with pytest.raises(ValueError):
        interval_join(df, df, "k", "v", "v", 0, 1, "full")
