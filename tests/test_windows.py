import datetime as dt
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions import event_time, next_utc_midnight, reject_future, seconds
from tidemark.operators import (
    latest_per_key,
    page_views,
    sliding_ends,
    top_n,
    unique_count,
    windowed_agg,
    windowed_avg,
    windowed_count,
    windowed_distinct,
    windowed_extremes,
)

UTC = dt.timezone.utc


def at(second):
    return dt.datetime.fromtimestamp(second, UTC).replace(tzinfo=None)


@pytest.fixture(scope="module")
def clicks(spark):
    """Keys a, b and null over some minutes, one row before 1970, several rows per second."""
    rows = [(i * 7 % 400 - 30, "ab"[i % 2] if i % 5 else None, float(i % 13)) for i in range(200)]
    df = spark.createDataFrame(rows, "second BIGINT, key STRING, value DOUBLE")
    return df.withColumn("ts", F.timestamp_seconds("second")).cache()


def by_hand(rows, size, slide):
    """(key, window end) -> values, from the definition of epoch-aligned windows."""
    found = {}
    for second, key, value in rows:
        start = second // slide * slide
        while start > second - size:
            found.setdefault((key, at(start + size)), []).append(value)
            start -= slide
    return found


@pytest.mark.parametrize("size, slide", [(60, 60), (60, 5), (61, 7), (7, 3), (5, 20), (3600, 5)])
def test_extremes_and_distinct_counts_by_hand(clicks, size, slide):
    """Some values and one time are null; 3600 s at 5 s are 720 windows per row."""
    rows = clicks.withColumn("value", F.when(F.col("second") % 3 != 0, F.col("value")))
    expected = by_hand([(r.second, r.key, r.value) for r in rows.collect()], size, slide)
    rows = rows.union(rows.limit(1).withColumn("ts", F.lit(None).cast("timestamp")))
    rows = rows if slide < size else rows.filter("ts IS NOT NULL")
    extremes = windowed_extremes(rows, "value", ["key"], "ts", size, slide)
    distinct = windowed_distinct(rows, "value", ["key"], "ts", size, slide)
    found = {(r.key, r.window_end): (r.lowest, r.highest) for r in extremes.collect()}
    known = {k: [v for v in values if v is not None] for k, values in expected.items()}
    assert found == {k: (min(v, default=None), max(v, default=None)) for k, v in known.items()}
    assert {(r.key, r.window_end): r["count"] for r in distinct.collect()} == {k: len(set(v)) for k, v in known.items()}
    assert extremes.count() == distinct.count() == len(expected)
    nothing = rows.limit(0)
    assert not windowed_extremes(nothing, "value", ["key"], "ts", size, slide).collect()
    assert not windowed_distinct(nothing, "value", ["key"], "ts", size, slide).collect()


@pytest.mark.parametrize("size, slide", [(60, 60), (60, 5), (60, 1), (61, 7), (7, 3), (5, 20), (3600, 1)])
def test_sliding_counts_and_averages_by_hand(clicks, size, slide):
    expected = by_hand([(r.second, r.key, r.value) for r in clicks.collect()], size, slide)
    counts = windowed_count(clicks, ["key"], "ts", size, slide).collect()
    assert len(counts) == len(expected)
    assert {(r.key, r.window_end): r["count"] for r in counts} == {k: len(v) for k, v in expected.items()}
    assert all(r.window_end - r.window_start == dt.timedelta(seconds=size) for r in counts)
    whole = clicks.withColumn("value", F.col("value").cast("int"))
    for rows in (clicks, whole):
        averages = windowed_avg(rows, "value", ["key"], "ts", size, slide).collect()
        assert len(averages) == len(expected)
        for r in averages:
            values = expected[r.key, r.window_end]
            assert r.average == pytest.approx(sum(values) / len(values))


def test_any_aggregate_over_a_large_overlap(clicks):
    expected = by_hand([(r.second, r.key, r.value) for r in clicks.collect()], 60, 2)
    result = windowed_agg(clicks, ["key"], "ts", 60, 2, kinds=F.count_distinct("value"), top=F.max("value"))
    got = {(r.key, r.window_end): (r.kinds, r.top) for r in result.collect()}
    assert got == {k: (len(set(v)), max(v)) for k, v in expected.items()}


def test_an_aggregate_of_ones_own(clicks):
    @F.pandas_udf("double")
    def spread(values: pd.Series) -> float:
        return float(values.max() - values.min())

    expected = by_hand([(r.second, r.key, r.value) for r in clicks.collect()], 60, 30)
    result = windowed_agg(clicks, ["key"], "ts", 60, 30, spread=spread("value")).collect()
    assert {(r.key, r.window_end): r.spread for r in result} == {k: max(v) - min(v) for k, v in expected.items()}


def test_window_ends_match_the_builtin_window(clicks):
    ends = sliding_ends(clicks.select("second", "key", "ts"), "ts", 60, 10).select("second", "key", "window_end")
    builtin = clicks.select("second", "key", F.window("ts", "60 seconds", "10 seconds")["end"].alias("window_end"))
    assert ends.exceptAll(builtin).isEmpty() and builtin.exceptAll(ends).isEmpty()


def test_null_values_do_not_enter_an_average(spark):
    rows = [(0, 4.0), (1, None), (2, 8.0), (70, None)]
    df = spark.createDataFrame(rows, "second BIGINT, value DOUBLE").withColumn("ts", F.timestamp_seconds("second"))
    whole = df.withColumn("value", F.col("value").cast("bigint"))
    for rows, slide in ((df, None), (df, 30), (whole, None), (whole, 30)):
        got = {r.window_end: r.average for r in windowed_avg(rows, "value", [], "ts", 60, slide).collect()}
        assert got[at(60)] == 6.0 and got[at(120)] is None


def test_page_views_and_unique_counts(spark):
    rows = [(0, 1), (10, 1), (20, 2), (3600, 1)]
    df = spark.createDataFrame(rows, "second BIGINT, user BIGINT").withColumn("ts", F.timestamp_seconds("second"))
    assert {(r.label, r.window_end, r["count"]) for r in page_views(df, "ts").collect()} == {
        ("pv", at(3600), 3),
        ("pv", at(7200), 1),
    }
    for method in ("exact", "bitmap", "approx"):
        got = {r.window_end: r["count"] for r in unique_count(df, "user", "ts", method=method).collect()}
        assert got == {at(3600): 2, at(7200): 1}


def test_approximate_distinct_is_close(spark):
    df = spark.range(20_000).withColumn("ts", F.timestamp_seconds(F.lit(0)))
    estimate = unique_count(df, "id", "ts", method="approx", rsd=0.02).first()["count"]
    assert abs(estimate - 20_000) < 20_000 * 0.06


def test_ranking_breaks_ties_by_key_and_renders_a_report(spark):
    rows = [(0, 5, 2), (0, 3, 2), (0, 9, 7), (0, 1, 1), (300, 4, 1)]
    df = spark.createDataFrame(rows, "second BIGINT, item BIGINT, count BIGINT")
    df = df.withColumn("window_end", F.timestamp_seconds("second"))
    ranked = top_n(df, "window_end", "count", "item", 3).collect()
    assert [(r.item, r["rank"]) for r in sorted(ranked, key=lambda r: (r.window_end, r["rank"]))] == [
        (9, 1),
        (3, 2),
        (5, 3),
        (4, 1),
    ]
    reports = top_n(df, "window_end", "count", "item", 2, report=True).orderBy("window_end").collect()
    assert reports[0].report == (
        "时间: 1970-01-01 00:00:00.0\nNO1:商品ID9点击量=7\nNO2:商品ID3点击量=2\n=============="
    )


def test_the_latest_count_wins(spark):
    rows = [("a", 1, 10), ("a", 3, 12), ("a", 2, 11), ("b", 1, None)]
    df = spark.createDataFrame(rows, "url STRING, version BIGINT, count BIGINT")
    got = {r.url: (r.version, r["count"]) for r in latest_per_key(df, ["url"], "version").collect()}
    assert got == {"a": (3, 12), "b": (1, None)}


def test_ranking_cuts_groups_before_the_shuffle(clicks):
    counts = windowed_count(clicks, ["key"], "ts", 60, 5)
    plan = top_n(counts, "window_end", "count", "key", 3)._jdf.queryExecution().executedPlan().toString()
    final, exchange, partial = (plan.index(s) for s in ("3, Final", "Exchange", "3, Partial"))
    assert final < exchange < partial


def test_durations_and_times(spark):
    assert seconds("1 hour 30 minutes") == 5400 and seconds(7) == 7 and seconds("-3 days") == -259200
    with pytest.raises(ValueError):
        seconds("soon")
    row = spark.range(1).select(
        event_time(F.lit(1636070400)).alias("s"),
        event_time(F.lit(1636070400123), "ms").alias("ms"),
        next_utc_midnight(event_time(F.lit(1636070400))).alias("reset"),
    ).first()
    assert row.s == dt.datetime(2021, 11, 5) and row.ms.microsecond == 123000
    assert row.reset == dt.datetime(2021, 11, 6)


def test_rows_from_the_future_are_set_apart(spark):
    df = spark.createDataFrame([(1636070400,), (16360704003,), (None,)], "epoch BIGINT")
    df = df.select(event_time("epoch").alias("ts"))
    rows, rejects = reject_future(df, "ts", "1 day")
    assert (rows.count(), rejects.count()) == (1, 2)


def test_counts_add_up_to_rows_times_overlap(clicks):
    total = windowed_count(clicks, ["key"], "ts", 60, 5).agg(F.sum("count")).first()[0]
    assert total == clicks.count() * 12
    assert Counter(r.key for r in clicks.collect())[None] > 0
