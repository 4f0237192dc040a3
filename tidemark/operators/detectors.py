"""Detectors over keyed event sequences: daily click limit, login failures, order payment.

Batch tables and streams take the same arguments. On a stream the rows of a key are handled in
event-time order once the watermark has passed them (see ``tidemark.streaming``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import (
    PAID,
    PAID_LATE,
    PAID_UNKNOWN,
    TIMED_OUT,
    login_fail_message,
    over_limit_message,
)
from ..functions.time import gap_seconds, seconds, utc_day
from .ordered import with_neighbours, with_running_number, with_runs


def _as_list(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def running_count_per_day(
    df: DataFrame,
    keys: str | Sequence[str],
    ts: str,
    order_by: Sequence[str] = (),
    count: str = "count",
) -> DataFrame:
    """Position of every row within its key and UTC day; rows are ordered by ``order_by`` or ``ts``.

    A stream numbers rows in event-time order (then ``order_by``), each once the watermark has passed it, so disorder
    within the delay does not matter; the count of a key and day is kept until that day is over.
    """
    if df.isStreaming:
        from ..streaming.processors import day_numbers_stream

        return day_numbers_stream(df, _as_list(keys), ts, list(order_by), count)
    by = [*_as_list(keys), "day"]
    dated = df.withColumn("day", utc_day(ts))
    return with_running_number(dated, by, list(order_by) or [ts], ts, count)


def cap_per_key_per_day(
    df: DataFrame,
    keys: str | Sequence[str],
    ts: str,
    limit: int,
    order_by: Sequence[str] = (),
    message: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Pass the first ``limit`` rows per key and UTC day; one warning at row ``limit + 1``.

    Rows are ordered by ``order_by`` (an arrival number, say) or ``ts``. On a stream the order
    across micro-batches is the order of arrival.
    """
    keys = _as_list(keys)
    if df.isStreaming:
        from ..streaming.processors import daily_cap

        counted = daily_cap(df, keys, ts, limit, list(order_by) or [ts])
    else:
        # Asking for a bounded rank lets Spark cut every group before the shuffle.
        order = Window.partitionBy(*keys, utc_day(ts)).orderBy(*(list(order_by) or [ts]))
        counted = df.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= limit + 1)
    passed = counted.filter(F.col("_n") <= limit).select(*df.columns)
    warnings = counted.filter(F.col("_n") == limit + 1).select(
        *keys, F.col(ts).alias("at"), F.lit(message or over_limit_message(limit)).alias("message")
    )
    return passed, warnings


def fail_pairs(
    df: DataFrame,
    key: str | Sequence[str],
    status: str,
    ts: str,
    max_gap: int | str = 2,
    order_by: Sequence[str] = (),
    fail: str = "fail",
) -> DataFrame:
    """Two fails in direct succession less than ``max_gap`` apart; any other status breaks a pair.

    A batch takes the rows in order of ``order_by`` (default ``ts``), so an arrival number gives
    the arrival-order rule. A stream always uses event-time order.
    """
    keys, gap = _as_list(key), seconds(max_gap)
    failed = F.col(status).eqNullSafe(fail)
    if df.isStreaming:
        from ..streaming.processors import fail_pairs_stream

        pairs = fail_pairs_stream(df.withColumn("_fail", failed), keys, ts, gap, list(order_by))
    else:
        rows = df.select(*keys, ts, *[c for c in order_by if c != ts], failed.alias("_fail"))
        last = F.struct(F.when(F.col("_fail"), F.col(ts)).alias("at"))
        before = with_neighbours(rows, keys, list(order_by) or [ts], ts, last)
        close = gap_seconds("_before.at", ts) < gap
        pairs = before.filter(F.col("_fail") & close).select(
            *keys, F.col("_before.at").alias("first_fail"), F.col(ts).alias("last_fail")
        )
    return pairs.withColumn("message", F.lit(login_fail_message(gap)))


def fail_runs(
    df: DataFrame,
    key: str | Sequence[str],
    status: str,
    ts: str,
    span: int | str = 2,
    min_fails: int = 2,
    order_by: Sequence[str] = (),
    fail: str = "fail",
) -> DataFrame:
    """At most one row per uninterrupted run of fails: its first and ``min_fails``-th fail, when
    they are less than ``span`` apart."""
    if min_fails < 1:
        raise ValueError("min_fails must be at least 1")
    keys, span_s = _as_list(key), seconds(span)
    failed = F.col(status).eqNullSafe(fail)
    if df.isStreaming:
        from ..streaming.processors import fail_runs_stream

        runs = fail_runs_stream(df.withColumn("_fail", failed), keys, ts, span_s, min_fails, list(order_by))
    else:
        rows = df.select(*keys, ts, *[c for c in order_by if c != ts], failed.alias("_fail"))
        runs = with_runs(rows, keys, list(order_by) or [ts], ts, "_fail")
        within = (F.col("_length") == min_fails) & (gap_seconds("_begin", ts) < span_s)
        runs = runs.filter(within).select(*keys, F.col("_begin").alias("first_fail"), F.col(ts).alias("last_fail"))
    return runs.withColumn("message", F.lit(login_fail_message(span_s)))


def order_pay_status(
    df: DataFrame,
    key: str | Sequence[str],
    kind: str,
    ts: str,
    timeout: int | str = "15 minutes",
    order_by: Sequence[str] = (),
    create: str = "create",
    pay: str = "pay",
    keep_expired: int | str = "1 day",
) -> DataFrame:
    """Outcome of every order: columns key, ``create_ts``, ``pay_ts``, ``result``.

    In event-time order, a create opens an order (a later create replaces an open one) and the
    next pay closes it: paid when less than ``timeout`` after the create, otherwise paid late.
    A pay with no open order is unknown. An order still open at the end, or replaced when already
    expired, has timed out. A create comes before a pay of the same time.

    An order is given up ``timeout + keep_expired`` after its create: it has timed out, and a pay
    from then on is unknown. A stream reports the time-out when its watermark gets there.
    """
    keys, limit = _as_list(key), seconds(timeout)
    rows = df.filter(F.col(kind).isin(create, pay)).select(
        *keys, ts, (F.col(kind) == pay).alias("_pay"), *[c for c in order_by if c != ts]
    )
    if df.isStreaming:
        from ..streaming.processors import order_pay_stream

        return order_pay_stream(rows, keys, ts, limit, seconds(keep_expired), list(order_by))
    event = F.struct(F.col("_pay"), F.col(ts).alias("at"))
    order = [ts, "_pay", *[c for c in order_by if c != ts]]
    seen = with_neighbours(rows, keys, order, ts, event)
    limit_us, keep_us = limit * 1_000_000, (limit + seconds(keep_expired)) * 1_000_000
    waited = F.unix_micros(ts) - F.unix_micros("_before.at")
    opened = F.when(~F.col("_before._pay") & (waited < keep_us), F.col("_before.at"))
    paid = F.when(opened.isNull(), PAID_UNKNOWN).when(waited < limit_us, PAID).otherwise(PAID_LATE)
    until = F.unix_micros("_after.at") - F.unix_micros(ts)
    given_up = until >= F.when(F.col("_after._pay"), keep_us).otherwise(limit_us)
    unpaid = F.when(F.col("_after").isNull() | given_up, TIMED_OUT)
    is_pay = F.col("_pay")
    return seen.select(
        *keys,
        F.when(is_pay, opened).otherwise(F.col(ts)).alias("create_ts"),
        F.when(is_pay, F.col(ts)).alias("pay_ts"),
        F.when(is_pay, paid).otherwise(unpaid).alias("result"),
    ).filter(F.col("result").isNotNull())
