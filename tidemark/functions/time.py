"""Event-time expressions: epoch numbers to timestamps, watermarks, window ends, UTC days."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}

# A stream whose timestamps never go back needs no delay; the others wait for stragglers.
ASCENDING = "0 seconds"
BOUNDED_1S = "1 second"
BOUNDED_3S = "3 seconds"
BOUNDED_1MIN = "1 minute"


def seconds(duration: int | str | timedelta) -> int:
    """Whole seconds of ``90``, ``"5 minutes"``, ``"1 hour 30 minutes"`` or a timedelta."""
    if isinstance(duration, timedelta):
        return int(duration.total_seconds())
    if isinstance(duration, int):
        return duration
    words = duration.lower().split()
    if not words or len(words) % 2:
        raise ValueError(f"not a duration: {duration!r}")
    total = 0
    for number, unit in zip(words[::2], words[1::2]):
        unit = unit.removesuffix("s")
        if unit not in UNIT_SECONDS:
            raise ValueError(f"unknown unit in duration: {duration!r}")
        total += int(number) * UNIT_SECONDS[unit]
    return total


def event_time(epoch: Column | str, unit: str = "s") -> Column:
    if unit not in ("s", "ms"):
        raise ValueError("unit must be 's' or 'ms'")
    col = F.col(epoch) if isinstance(epoch, str) else epoch
    return F.timestamp_seconds(col) if unit == "s" else F.timestamp_millis(col)


def plain_time(ts: str) -> Column:
    """The time without its watermark; a stateful step accepts one column with a watermark only."""
    return F.timestamp_micros(F.unix_micros(ts)).alias(ts)


def with_event_time(
    df: DataFrame, epoch: str, unit: str = "s", delay: int | str = ASCENDING, ts: str = "ts"
) -> DataFrame:
    """Replace an epoch column by the event-time column ``ts`` carrying a watermark.

    Allowed lateness is part of ``delay`` (bound plus lateness); on a batch table the watermark
    has no effect.
    """
    timed = df.withColumn(ts, event_time(epoch, unit))
    if epoch != ts:
        timed = timed.drop(epoch)
    return timed.withWatermark(ts, f"{seconds(delay)} seconds")


def reject_future(
    df: DataFrame, ts: str, max_skew: int | str, now: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split off rows timed more than ``max_skew`` ahead of ``now``.

    One such row would push the watermark ahead and turn all following rows into late ones, so
    a stream applies this before ``withWatermark``. Rows without a time go to the rejects too.
    """
    limit = (F.current_timestamp() if now is None else now) + F.make_interval(secs=F.lit(seconds(max_skew)))
    fine = F.coalesce(F.col(ts) <= limit, F.lit(False))
    return df.filter(fine), df.filter(~fine)


def utc_day(ts: Column | str) -> Column:
    return F.to_date(ts)


def next_utc_midnight(ts: Column | str) -> Column:
    return F.date_trunc("day", ts) + F.expr("INTERVAL 1 DAY")


def aligned(second: Column, step_s: int) -> Column:
    """Largest multiple of ``step_s`` not after ``second`` (integer arithmetic only)."""
    return second - F.pmod(second, F.lit(step_s).cast("bigint"))


def start_range(second: Column, size_s: int, slide_s: int) -> tuple[Column, Column]:
    """First and last start (epoch seconds) of the windows ``[start, start + size)`` around ``second``.

    Windows start at multiples of the slide. The range is empty (first > last) where windows
    leave gaps, i.e. the slide is longer than the window.
    """
    return aligned(second - size_s, slide_s) + slide_s, aligned(second, slide_s)


def window_ends(second: Column, size_s: int, slide_s: int) -> Column:
    """All window ends (epoch seconds) whose window holds ``second``."""
    first, last = start_range(second, size_s, slide_s)
    return steps(first + size_s, last + size_s, slide_s)


def steps(first: Column, last: Column, step_s: int) -> Column:
    """Array ``first, first + step, .., last``, empty if ``first`` is after ``last``."""
    nothing = F.array().cast("array<bigint>")
    return F.when(first <= last, F.sequence(first, last, F.lit(step_s).cast("bigint"))).otherwise(nothing)


def gap_seconds(a: Column | str, b: Column | str) -> Column:
    """Absolute distance of two timestamps in seconds, with microsecond precision."""
    return F.abs(F.unix_micros(a) - F.unix_micros(b)) / 1_000_000


def as_text(ts: Column | str) -> Column:
    """Timestamp as ``yyyy-MM-dd HH:mm:ss.S``."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.S")
