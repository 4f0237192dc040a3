"""Jobs from lines of text to results, with their default parameters, on the edges that the defaults have."""

from __future__ import annotations

import datetime as dt

from tidemark import schemas
from tidemark.functions import with_event_time
from tidemark.functions.text import PAID, TIMED_OUT
from tidemark.plans import jobs
from tidemark.sources import parse_delimited

BASE = 1_646_200_800  # a full hour


def rows_of(spark, schema, lines):
    text = spark.createDataFrame([(line,) for line in lines], "value STRING")
    rows, rejects = parse_delimited(text, schema)
    assert rejects.isEmpty()
    return with_event_time(rows, "epoch")


def at(second):
    return dt.datetime.fromtimestamp(BASE + second, dt.timezone.utc).replace(tzinfo=None)


def test_items_of_the_hour_and_a_time_far_ahead(spark):
    views = [(1, 0), (2, 10), (2, 20), (3, 30), (3, 40), (3, 50), (4, 60)]
    lines = [f"{user},{item},7,pv,{BASE + second}" for user, (item, second) in enumerate(views)]
    lines += [f"9,5,7,buy,{BASE}", f"9,5,7,pv,{BASE + 400 * 31_557_600}"]
    found = jobs.hot_items(rows_of(spark, schemas.USER_BEHAVIOR, lines)).collect()
    by_window = {}
    for r in sorted(found, key=lambda r: (r.window_end, r["rank"])):
        by_window.setdefault(r.window_end, []).append((r.item_id, r["count"]))
    near = [w for end, w in sorted(by_window.items()) if end < at(100_000)]
    far = [w for end, w in by_window.items() if end > at(100_000)]
    assert near == [[(3, 3), (2, 2), (1, 1)]] * 12 and far == [[(5, 1)]] * 12


def test_a_hundred_clicks_and_one_more(spark):
    lines = [f"1,10,north,x,{BASE + i}" for i in range(102)] + [f"2,10,south,y,{BASE + 5}"]
    counts, warnings = jobs.ad_clicks_by_province(rows_of(spark, schemas.AD_CLICK, lines))
    assert [(r.user_id, r.ad_id, r["at"]) for r in warnings.collect()] == [(1, 10, at(100))]
    totals = {}
    for r in counts.collect():
        windows, most, total = totals.get(r.province, (0, 0, 0))
        totals[r.province] = windows + 1, max(most, r["count"]), total + r["count"]
    assert totals == {"north": (739, 100, 720 * 100), "south": (720, 1, 720)}


def test_pays_around_the_limit(spark):
    lines = [f"1,create,,{BASE}", f"1,pay,a,{BASE + 899}", f"2,create,,{BASE}", f"2,pay,b,{BASE + 900}", f"3,create,,{BASE}", f"3,pay,,{BASE + 1}"]
    found = jobs.order_timeouts(rows_of(spark, schemas.ORDER, lines)).collect()
    assert sorted((r.order_id, r.result) for r in found) == [(1, PAID), (2, TIMED_OUT), (3, TIMED_OUT)]


def test_receipts_at_both_ends_of_the_interval(spark):
    gaps = {"a": -3, "b": 5, "c": -4, "d": 6, "e": 0}
    orders = [f"{i},pay,{tx},{BASE}" for i, tx in enumerate(gaps)] + [f"8,pay,,{BASE}", f"9,create,e,{BASE}"]
    receipts = [f"{tx},card,{BASE + gap}" for tx, gap in gaps.items()] + [f"f,card,{BASE}"]
    found = jobs.tx_match(rows_of(spark, schemas.ORDER, orders), rows_of(spark, schemas.RECEIPT, receipts))
    tags = {}
    for r in found.collect():
        tags.setdefault(r.output, []).append(r.tx_id)
    assert {t: sorted(v) for t, v in tags.items()} == {
        "matched": ["a", "b", "e"],
        "unmatched_pay": ["c", "d"],
        "unmatched_receipt": ["c", "d", "f"],
    }


def test_login_failures_within_the_limit(spark):
    tries = [(1, "fail", 0), (1, "fail", 179), (1, "success", 180), (1, "fail", 181), (2, "fail", 0), (2, "fail", 180)]
    lines = [f"{user},192.0.2.1,{status},{BASE + second}" for user, status, second in tries]
    found = jobs.login_fail_sequences(rows_of(spark, schemas.LOGIN, lines)).collect()
    assert [(r.user_id, r.first_fail, r.last_fail) for r in found] == [(1, at(0), at(179))]
