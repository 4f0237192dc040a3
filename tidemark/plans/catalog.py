"""The registered queries over the shared tables, one per operator and job.

``events`` stands for all behaviour streams: ``props.k`` is the item, ``error`` a failed login,
``click`` an ad click or an opened order, ``purchase`` its payment. ``orders`` and ``lineitem``
stand for payments and receipts. Ties are broken by ``event_id``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.hashing import bitmap_position
from ..functions.text import PAID, TIMED_OUT
from ..functions.time import next_utc_midnight, reject_future, with_event_time
from ..operators import detectors, distinct, joins, outputs, patterns, ranking, windows
from ..operators.ordered import with_running_number
from ..session import shared_dir
from ..sources import parsing
from ..sources.tables import load_table, zoneless_timestamps
from ..streaming.corrected import CompactedLog
from . import jobs

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = lambda spark, sf_dir: zoneless_timestamps(run(spark, sf_dir))
    return run


def _item() -> Column:
    return F.get_json_object("props", "$.k").try_cast("bigint")


def behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", _item().alias("item_id"), F.col("event_type").alias("behavior"), "value"
    )


def events_of(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return behavior(spark, sf_dir).filter(F.col("behavior") == kind)


def logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", F.col("event_type").alias("status")
    )


def access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests: every event opens one page; each fourth asks for a style sheet instead."""
    pages = load_table(spark, sf_dir, "pages")
    n_pages = pages.count()
    requests = load_table(spark, sf_dir, "events").select(
        "event_id", "ts", F.when(F.col("event_type") == "signup", "POST").otherwise("GET").alias("method")
    )
    opened = requests.join(pages.select("page_id", "url"), F.col("event_id") % n_pages == F.col("page_id"))
    ending = F.when(F.col("event_id") % 4 == 0, ".css").otherwise("")
    return opened.select("ts", "method", F.concat("url", ending).alias("url"))


@query
def hot_items(spark, sf_dir):
    return jobs.hot_items(behavior(spark, sf_dir), wanted="view")


@query
def item_window_counts(spark, sf_dir):
    return jobs.item_window_counts(behavior(spark, sf_dir), wanted="view")


@query
def top_n_report(spark, sf_dir):
    return jobs.hot_items(behavior(spark, sf_dir), wanted="view", report=True)


@query
def hot_urls(spark, sf_dir):
    return jobs.hot_urls(access_log(spark, sf_dir), slide="1 minute")


@query
def hot_urls_report(spark, sf_dir):
    return jobs.hot_urls(access_log(spark, sf_dir), slide="1 minute", report=True)


@query
def late_corrected_counts(spark, sf_dir):
    """Every view, in order of arrival, corrects the count of its item and window: the newest one stands."""
    views = events_of(spark, sf_dir, "view").select("event_id", "ts", "item_id")
    keys = ["item_id", "window_end"]
    ended = views.withColumn("window_end", F.window("ts", "1 hour").getField("end"))
    given = with_running_number(ended, keys, ["event_id"], "ts", "count").select(*keys, "count", "event_id")
    return ranking.latest_per_key(given, keys, "event_id").drop("event_id")


@query
def corrected_hot_items(spark, sf_dir):
    """The hot items of a stream that arrives by event number: each file corrects the rankings given out before.

    Without a watermark no window is ever final, so that every view counts however late it comes.
    """
    folder = f"{shared_dir(spark)}/corrected/{uuid.uuid4().hex}"
    arrivals = events_of(spark, sf_dir, "view").select("event_id", "ts", "item_id", "behavior")
    arrivals.repartitionByRange(3, "event_id").write.parquet(f"{folder}/arrivals")
    stream = spark.readStream.schema(arrivals.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/arrivals")
    log = CompactedLog(f"{folder}/log", every=2)
    writer = jobs.write_corrected_hot_items(stream, log.append, f"{folder}/state", wanted="view")
    writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return log.read(spark).drop("change")


@query
def unique_visitors_merged(spark, sf_dir):
    """Daily distinct positions out of stored hourly bitmaps."""
    hourly = distinct.window_bitmaps(events_of(spark, sf_dir, "view"), "user_id", "ts", "1 hour")
    return distinct.merged_unique_count(hourly, "1 day")


@query
def event_times(spark, sf_dir):
    """Epoch seconds and milliseconds as event times."""
    rows = load_table(spark, sf_dir, "events").select(
        "event_id", F.unix_seconds("ts").alias("sent_s"), F.unix_millis("ts").alias("sent_ms")
    )
    return with_event_time(with_event_time(rows, "sent_s", "s", ts="by_s"), "sent_ms", "ms", ts="by_ms")


def _order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks open orders and purchases pay them; of three payments one has an empty and one no transaction id."""
    tx = F.when(F.col("event_id") % 3 == 0, "").when(F.col("event_id") % 3 == 1, F.concat(F.lit("tx"), "event_id"))
    kind = F.when(F.col("behavior") == "purchase", "pay").when(F.col("behavior") == "click", "create")
    rows = behavior(spark, sf_dir).select("event_id", F.col("user_id").alias("order_id"), kind.alias("event_type"), tx.alias("tx_id"), "ts")
    return rows.where("event_type IS NOT NULL")


@query
def paid_transactions(spark, sf_dir):
    """Payments that have a transaction id."""
    orders = _order_log(spark, sf_dir)
    return jobs.pays_and_receipts(orders, orders.select("tx_id", "ts"))[0]


@query
def side_outputs(spark, sf_dir):
    """Clicks within the daily limit and warnings as outputs of one result, each counted by itself."""
    passed, warned = detectors.cap_per_key_per_day(events_of(spark, sf_dir, "click"), "user_id", "ts", 1, ["ts", "event_id"])
    both = passed.select("user_id", F.lit("passed").alias("output")).union(warned.select("user_id", F.lit("warned").alias("output")))
    parts = outputs.split_outputs(both, ["passed", "warned"])
    counted = [outputs.tagged(rows.groupBy("user_id").count(), tag) for tag, rows in parts.items()]
    return counted[0].union(counted[1])


@query
def parse_access_log(spark, sf_dir):
    ip = F.concat(F.lit("10.0."), F.expr("user_id div 256"), F.lit("."), F.col("user_id") % 256)
    at = F.date_format("ts", parsing.ACCESS_LOG_TIME)
    address = F.concat(F.lit("/item/"), _item())
    line = F.concat_ws(" ", ip, "user_id", F.lit("-"), at, F.lit("+0000"), F.lit("GET"), address)
    rows, _ = parsing.parse_access_log(load_table(spark, sf_dir, "events").select(line.alias("value")))
    return rows


def _behavior_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited behaviour records; those of errors break off after the category."""
    head = F.concat_ws(",", "user_id", _item(), _item() % 7)
    full = F.concat_ws(",", head, "event_type", F.unix_seconds("ts"))
    line = F.when(F.col("event_type") == "error", head).otherwise(full)
    return load_table(spark, sf_dir, "events").select(line.alias("value"))


@query
def parse_delimited(spark, sf_dir):
    return parsing.parse_delimited(_behavior_lines(spark, sf_dir), schemas.USER_BEHAVIOR)[0]


@query
def parse_rejects(spark, sf_dir):
    return parsing.parse_delimited(_behavior_lines(spark, sf_dir), schemas.USER_BEHAVIOR)[1]


@query
def static_asset_filter(spark, sf_dir):
    ending = F.element_at(
        F.array(*[F.lit(e) for e in (".css", ".css?x", ".js", ".PNG", ".ico", ".png", "")]),
        (F.col("page_id") % 7 + 1).cast("int"),
    )
    pages = load_table(spark, sf_dir, "pages").select("page_id", F.concat("url", ending).alias("url"))
    return parsing.exclude_static_assets(pages, "url")


@query
def page_views(spark, sf_dir):
    return windows.page_views(events_of(spark, sf_dir, "view"), "ts")


@query
def unique_visitors(spark, sf_dir):
    return distinct.unique_count(events_of(spark, sf_dir, "view"), "user_id", "ts")


@query
def unique_items(spark, sf_dir):
    return distinct.unique_count(events_of(spark, sf_dir, "view"), "item_id", "ts")


@query
def unique_visitors_bitmap(spark, sf_dir):
    return distinct.unique_count(events_of(spark, sf_dir, "view"), "user_id", "ts", method="bitmap")


@query
def unique_visitors_running(spark, sf_dir):
    views = events_of(spark, sf_dir, "view")
    return distinct.running_unique_count(views, "user_id", "ts", order_by=["event_id"], method="bitmap")


@query
def unique_visitors_approx(spark, sf_dir):
    """Per hour, whether the estimate is within three standard errors (and one visitor) of the exact count."""
    views, error = events_of(spark, sf_dir, "view"), 0.05
    exact = distinct.unique_count(views, "user_id", "ts").select("window_end", F.col("count").alias("exact"))
    about = distinct.unique_count(views, "user_id", "ts", method="approx", rsd=error)
    near = F.abs(F.col("count") - F.col("exact")) <= 3 * error * F.col("exact") + 1
    return about.join(exact, "window_end").select("window_start", "window_end", "exact", near.alias("is_near"))


@query
def bitmap_positions(spark, sf_dir):
    users = load_table(spark, sf_dir, "events").select("user_id").distinct()
    return users.select("user_id", bitmap_position("user_id").alias("position"))


@query
def channel_counts(spark, sf_dir):
    marketing = behavior(spark, sf_dir).select(
        "ts", "behavior", F.concat(F.lit("channel_"), F.col("item_id") % 5).alias("channel")
    )
    counts = jobs.channel_counts(marketing, slide="1 minute", unwanted="error")
    return counts.select("window_start", "channel", "behavior", "count")


@query
def ad_clicks_by_province(spark, sf_dir):
    clicks = events_of(spark, sf_dir, "click").select("event_id", "ts", "user_id")
    customers = load_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = load_table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("province"))
    placed = clicks.join(customers, F.col("user_id") == F.col("c_custkey")).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    order = ["ts", "event_id"]
    counts, _ = jobs.ad_clicks_by_province(placed, 2, "1 hour", "1 minute", ["user_id"], order)
    return counts.select("window_end", "province", "count")


@query
def ad_blacklist(spark, sf_dir):
    clicks = events_of(spark, sf_dir, "click").select("event_id", "ts", "user_id")
    return detectors.cap_per_key_per_day(clicks, "user_id", "ts", 2, ["ts", "event_id"])[1]


@query
def daily_click_sequence(spark, sf_dir):
    clicks = events_of(spark, sf_dir, "click").select("event_id", "ts", "user_id")
    return detectors.running_count_per_day(clicks, "user_id", "ts", ["ts", "event_id"])


@query
def daily_reset_times(spark, sf_dir):
    return load_table(spark, sf_dir, "events").select("event_id", next_utc_midnight("ts").alias("reset_at"))


@query
def future_rejects(spark, sf_dir):
    rows = load_table(spark, sf_dir, "events").select("event_id", "ts")
    return reject_future(rows, "ts", "1 day", now=F.lit("2024-01-20 00:00:00").cast("timestamp"))[1]


@query
def login_fail_pairs(spark, sf_dir):
    rows = logins(spark, sf_dir)
    return detectors.fail_pairs(rows, "user_id", "status", "ts", "6 hours", ["ts", "event_id"], fail="error")


@query
def login_fail_runs(spark, sf_dir):
    rows = logins(spark, sf_dir)
    return detectors.fail_runs(rows, "user_id", "status", "ts", "24 hours", 2, ["ts", "event_id"], fail="error")


@query
def login_fail_runs_of_three(spark, sf_dir):
    rows = logins(spark, sf_dir)
    return detectors.fail_runs(rows, "user_id", "status", "ts", "5 days", 3, ["ts", "event_id"], fail="error")


@query
def login_fail_cep(spark, sf_dir):
    return jobs.login_fail_sequences(logins(spark, sf_dir), "6 hours", ["event_id"], fail="error")


def _is(kind: str) -> Column:
    return F.col("behavior") == kind


@query
def order_timeout_cep(spark, sf_dir):
    steps = [patterns.Step("create", _is("click")), patterns.Step("pay", _is("purchase"))]
    rows = behavior(spark, sf_dir)
    found = patterns.match_sequence(rows, "user_id", "ts", steps, "12 hours", ["event_id"])
    result = F.when(F.col("output") == patterns.MATCHED, PAID).otherwise(TIMED_OUT)
    return found.select("user_id", "create_ts", "pay_ts", result.alias("result"))


@query
def three_step_sequence(spark, sf_dir):
    steps = [patterns.Step(k, _is(k)) for k in ("click", "view", "purchase")]
    rows = behavior(spark, sf_dir)
    return patterns.match_sequence(rows, "user_id", "ts", steps, "2 days", ["event_id"])


@query
def strict_then_relaxed_sequence(spark, sf_dir):
    steps = [
        patterns.Step("click", _is("click")),
        patterns.Step("view", _is("view"), patterns.NEXT),
        patterns.Step("purchase", _is("purchase")),
    ]
    rows = behavior(spark, sf_dir)
    return patterns.match_sequence(rows, "user_id", "ts", steps, "3 days", ["event_id"])


@query
def order_pay_status(spark, sf_dir):
    return detectors.order_pay_status(
        behavior(spark, sf_dir),
        "user_id",
        "behavior",
        "ts",
        "12 hours",
        ["event_id"],
        "click",
        "purchase",
        keep_expired="36500 days",
    )


def _payments(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = load_table(spark, sf_dir, "orders")
    lines = load_table(spark, sf_dir, "lineitem")
    return (
        orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("pay_ts")),
        lines.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line"),
            F.col("l_shipdate").alias("receipt_ts"),
        ),
    )


@query
def tx_interval_join(spark, sf_dir):
    pays, receipts = _payments(spark, sf_dir)
    return joins.interval_join(pays, receipts, "order_id", "pay_ts", "receipt_ts", "-3 days", "5 days")


@query
def tx_window_join(spark, sf_dir):
    pays, receipts = _payments(spark, sf_dir)
    return joins.window_join(pays, receipts, "order_id", "pay_ts", "receipt_ts", "15 days")


@query
def tx_sliding_window_join(spark, sf_dir):
    pays, receipts = _payments(spark, sf_dir)
    return joins.window_join(pays, receipts, "order_id", "pay_ts", "receipt_ts", "15 days", "5 days")


@query
def tx_match(spark, sf_dir):
    pays, receipts = _payments(spark, sf_dir)
    return joins.reconcile(pays, receipts, "order_id", "pay_ts", "receipt_ts", "-3 days", "5 days")


def _cents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values as whole cents: their sums are exact in any order, so averages are repeatable."""
    return behavior(spark, sf_dir).withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))


@query
def avg_value(spark, sf_dir):
    return windows.windowed_avg(_cents(spark, sf_dir), "cents", [], "ts", "1 hour", average="avg_cents")


@query
def avg_value_sliding(spark, sf_dir):
    rows = _cents(spark, sf_dir)
    return windows.windowed_avg(rows, "cents", ["behavior"], "ts", "2 hours", "30 minutes", "avg_cents")


@query
def window_profile(spark, sf_dir):
    """Extremes and distinct items side by side, without a row per window and event."""
    rows, by = behavior(spark, sf_dir), ["behavior", "window_start", "window_end"]
    found = windows.windowed_extremes(rows, "value", ["behavior"], "ts", "1 hour", "20 minutes")
    items = windows.windowed_distinct(rows, "item_id", ["behavior"], "ts", "1 hour", "20 minutes", "items")
    both = found.unionByName(items, allowMissingColumns=True).groupBy(*by)
    return both.agg(*[F.max(c).alias(c) for c in ("lowest", "highest", "items")])
