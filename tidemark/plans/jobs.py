"""The end-to-end jobs: typed records in, results out, on batch tables and streams alike.

Each job fixes the columns and default parameters and leaves the work to the operators. Inputs
have an event-time column ``ts`` (with a watermark, if a stream).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.text import ITEM_REPORT, PAID, TIMED_OUT, URL_REPORT, login_fail_message
from ..functions.time import seconds
from ..operators.detectors import cap_per_key_per_day
from ..operators.joins import prefixed, reconcile
from ..operators.outputs import Sink
from ..operators.patterns import FOLLOWED_BY, MATCHED, NEXT, Step, match_sequence
from ..operators.ranking import top_n
from ..operators.windows import windowed_count
from ..sources.parsing import exclude_static_assets
from ..streaming.corrected import write_corrected_top_n
from ..streaming.sinks import ranked_sink
from ..streaming.sliding import sliding_counts


def item_window_counts(
    behavior: DataFrame,
    size: int | str = "1 hour",
    slide: int | str = "5 minutes",
    wanted: str = "pv",
    closed_only: bool = False,
) -> DataFrame:
    """Views per item and window."""
    views = behavior.filter(F.col("behavior") == wanted)
    return windowed_count(views, ["item_id"], "ts", size, slide, closed_only=closed_only)


def hot_items(
    behavior: DataFrame,
    size: int | str = "1 hour",
    slide: int | str = "5 minutes",
    n: int = 3,
    wanted: str = "pv",
    report: bool = False,
) -> DataFrame:
    """Most viewed items per window end. Batch; for a stream see ``write_hot_items``."""
    counts = item_window_counts(behavior, size, slide, wanted)
    return top_n(counts, "window_end", "count", "item_id", n, report, ITEM_REPORT)


def url_window_counts(
    log: DataFrame,
    size: int | str = "10 minutes",
    slide: int | str = 5,
    method: str = "GET",
    closed_only: bool = False,
) -> DataFrame:
    """Requests per page address and window, static files left out."""
    pages = exclude_static_assets(log.filter(F.col("method") == method), "url")
    return windowed_count(pages, ["url"], "ts", size, slide, closed_only=closed_only)


def hot_urls(
    log: DataFrame,
    size: int | str = "10 minutes",
    slide: int | str = 5,
    n: int = 5,
    method: str = "GET",
    report: bool = False,
) -> DataFrame:
    """Most requested addresses per window end."""
    counts = url_window_counts(log, size, slide, method)
    return top_n(counts, "window_end", "count", "url", n, report, URL_REPORT)


def write_hot_items(
    behavior: DataFrame,
    sink: Sink,
    size: int | str = "1 hour",
    slide: int | str = "5 minutes",
    n: int = 3,
    wanted: str = "pv",
    report: bool = False,
) -> DataStreamWriter:
    """``hot_items`` of a stream: the writer gives ``sink`` the ranking of every window that has closed."""
    counts = item_window_counts(behavior, size, slide, wanted, closed_only=True)
    return counts.writeStream.outputMode("append").foreachBatch(ranked_sink(sink, "count", "item_id", n, report, ITEM_REPORT))


def write_corrected_hot_items(
    behavior: DataFrame,
    sink: Sink,
    state_path: str,
    size: int | str = "1 hour",
    slide: int | str = "5 minutes",
    n: int = 3,
    wanted: str = "pv",
) -> DataStreamWriter:
    """The rankings of a stream as changes, from the first row of a window on and corrected by late rows until the
    watermark has passed its end. ``streaming.CompactedLog`` keeps their sum."""
    views = behavior.filter(F.col("behavior") == wanted)
    return write_corrected_top_n(views, sink, state_path, "item_id", "ts", size, slide, n)


def write_hot_urls(
    log: DataFrame,
    sink: Sink,
    size: int | str = "10 minutes",
    slide: int | str = 5,
    n: int = 5,
    method: str = "GET",
    report: bool = False,
) -> DataStreamWriter:
    """``hot_urls`` of a stream."""
    counts = url_window_counts(log, size, slide, method, closed_only=True)
    return counts.writeStream.outputMode("append").foreachBatch(ranked_sink(sink, "count", "url", n, report, URL_REPORT))


def _counts(df: DataFrame, keys: list[str], size: int | str, slide: int | str) -> DataFrame:
    if df.isStreaming and seconds(slide) < seconds(size):
        return sliding_counts(df, keys, "ts", size, slide)
    return windowed_count(df, keys, "ts", size, slide)


def channel_counts(
    marketing: DataFrame, size: int | str = "1 hour", slide: int | str = 1, unwanted: str = "UNINSTALL"
) -> DataFrame:
    """Events per channel and behaviour and window; a missing behaviour is not the unwanted one.

    On a stream each window comes once, when it closes (append mode), see ``streaming.sliding_counts``.
    """
    kept = marketing.filter(~F.col("behavior").eqNullSafe(unwanted))
    return _counts(kept, ["channel", "behavior"], size, slide)


def ad_clicks_by_province(
    clicks: DataFrame,
    limit: int = 100,
    size: int | str = "1 hour",
    slide: int | str = 5,
    keys: Sequence[str] = ("user_id", "ad_id"),
    order_by: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Clicks per province and window without those over the daily limit, and the blacklist."""
    passed, warnings = cap_per_key_per_day(clicks, keys, "ts", limit, order_by)
    return _counts(passed, ["province"], size, slide), warnings


def login_fail_sequences(
    logins: DataFrame, within: int | str = "3 minutes", order_by: Sequence[str] = (), fail: str = "fail"
) -> DataFrame:
    """Two login failures in direct succession within the time limit."""
    failed = F.col("status") == fail
    steps = [Step("first_fail", failed), Step("last_fail", failed, NEXT)]
    pairs = match_sequence(logins, "user_id", "ts", steps, within, order_by, on_timeout=False)
    return pairs.select(
        "user_id",
        F.col("first_fail_ts").alias("first_fail"),
        F.col("last_fail_ts").alias("last_fail"),
        F.lit(login_fail_message(seconds(within))).alias("message"),
    )


def order_timeouts(
    orders: DataFrame, within: int | str = "15 minutes", order_by: Sequence[str] = ()
) -> DataFrame:
    """Every order creation: paid within the limit (with a transaction id), or timed out."""
    has_tx = F.col("tx_id").isNotNull() & (F.col("tx_id") != "")
    steps = [
        Step("create", F.col("event_type") == "create"),
        Step("pay", (F.col("event_type") == "pay") & has_tx, FOLLOWED_BY),
    ]
    found = match_sequence(orders, "order_id", "ts", steps, within, order_by)
    result = F.when(F.col("output") == MATCHED, PAID).otherwise(TIMED_OUT)
    return found.select("order_id", "create_ts", "pay_ts", result.alias("result"))


def pays_and_receipts(orders: DataFrame, receipts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Payments with a transaction id, and receipts, prepared for the joins on ``tx_id``."""
    has_tx = F.col("tx_id").isNotNull() & (F.col("tx_id") != "")
    pays = orders.filter((F.col("event_type") == "pay") & has_tx)
    return prefixed(pays, "pay_", ["tx_id"]), prefixed(receipts, "receipt_", ["tx_id"])


def tx_match(orders: DataFrame, receipts: DataFrame, lo: int | str = -3, hi: int | str = 5) -> DataFrame:
    """Payments with their receipts, and both kinds of unmatched records, tagged."""
    pays, got = pays_and_receipts(orders, receipts)
    return reconcile(pays, got, "tx_id", "pay_ts", "receipt_ts", lo, hi)
