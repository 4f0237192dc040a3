"""Two-stream joins on keys and time: interval join, window join, tagged reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import aligned, plain_time, seconds, steps
from .windows import sliding_ends

MATCHED = "matched"


def prefixed(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    """Give the columns of one side a prefix, so that both sides fit in one flat row."""
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(f"{prefix}{c}") for c in df.columns])


def connected(a: DataFrame, b: DataFrame, tags: tuple[str, str] = ("left", "right"), side: str = "side") -> DataFrame:
    """Both inputs as one, told apart by ``side``, for rules that see the rows of two inputs by key.

    Columns of the same name are shared; a row is null in those of the other input.
    """
    left, right = (df.withColumn(side, F.lit(tag)) for df, tag in zip((a, b), tags))
    return left.unionByName(right, allowMissingColumns=True)


def _offset(ts: str, offset_s: int) -> Column:
    return F.col(ts) + F.expr(f"INTERVAL '{offset_s}' SECOND")


def _right(b: DataFrame, on: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The right side with its key columns renamed, and the remaining columns."""
    renamed = b.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in b.columns])
    return renamed, [c for c in b.columns if c not in on]


def _same(on: Sequence[str]) -> Column:
    condition = F.lit(True)
    for c in on:
        condition = condition & (F.col(c) == F.col(f"_r_{c}"))
    return condition


def _in_range(a_ts: str, b_ts: str, lo_s: int, hi_s: int) -> Column:
    return (F.col(b_ts) >= _offset(a_ts, lo_s)) & (F.col(b_ts) <= _offset(a_ts, hi_s))


def _bin_width(lo_s: int, hi_s: int) -> int:
    return max(4 * (hi_s - lo_s), 1)


def _binned(point: DataFrame, p_ts: str, reach: DataFrame, r_ts: str, lo_s: int, hi_s: int):
    """Add the time bin ``_bin`` to rows and ``_r_bin`` to the bins their partners can be in.

    A partner of a ``reach`` row lies between ``lo`` and ``hi`` after it. Every ``point`` row has
    one bin, so a pair meets once. Joining on key and bin splits a busy key by time; a bin is four
    times as wide as the range, so few rows have to be in two bins.
    """
    width = _bin_width(lo_s, hi_s)
    second = F.unix_seconds(r_ts)
    return (
        point.withColumn("_bin", aligned(F.unix_seconds(p_ts), width)),
        reach.withColumn(
            "_r_bin", F.explode(steps(aligned(second + lo_s, width), aligned(second + hi_s, width), width))
        ),
    )


def interval_join(
    a: DataFrame,
    b: DataFrame,
    on: str | Sequence[str],
    a_ts: str,
    b_ts: str,
    lo: int | str,
    hi: int | str,
    how: str = "inner",
) -> DataFrame:
    """Pairs with equal keys and ``a_ts + lo <= b_ts <= a_ts + hi``, bounds included.

    Columns: keys, the other columns of ``a``, the other columns of ``b`` (their names must
    differ, see :func:`prefixed`). ``how`` is ``inner`` or ``left``. Streams need watermarks.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'; see reconcile for both sides")
    on = [on] if isinstance(on, str) else list(on)
    lo_s, hi_s = seconds(lo), seconds(hi)
    right, rest = _right(b, on)
    condition = _same(on) & _in_range(a_ts, b_ts, lo_s, hi_s)
    left = a
    if not (a.isStreaming or b.isStreaming):
        left, right = _binned(a, a_ts, right, b_ts, -hi_s, -lo_s)
        condition = condition & (F.col("_bin") == F.col("_r_bin"))
    return left.join(right, condition, how).select(*a.columns, *rest)


def window_join(
    a: DataFrame,
    b: DataFrame,
    on: str | Sequence[str],
    a_ts: str,
    b_ts: str,
    size: int | str = 15,
    slide: int | str | None = None,
) -> DataFrame:
    """Pairs with equal keys in the same window; with a slide, once per window they share."""
    on = [on] if isinstance(on, str) else list(on)
    size_s = seconds(size)
    slide_s = seconds(slide) if slide is not None else size_s
    right, rest = _right(b, on)
    if a.isStreaming or b.isStreaming:
        spec = (f"{size_s} seconds", f"{slide_s} seconds")
        left = _window_in_place_of_time(a, a_ts, "_w", spec)
        right = _window_in_place_of_time(right, b_ts, "_r_w", spec)
        end = F.col("_w.end")
    elif slide_s >= size_s:
        left = _ends(a, a_ts, size_s, slide_s).withColumnRenamed("window_end", "_w")
        right = _ends(right, b_ts, size_s, slide_s).withColumnRenamed("window_end", "_r_w")
        end = F.col("_w")
    else:
        # Rows share a window only if they are less than its length apart: match those once, by
        # bins of time, and let each pair give a row per window that it shares.
        left, right = _binned(a, a_ts, right, b_ts, 1 - size_s, size_s - 1)
        one, other = F.unix_seconds(a_ts), F.unix_seconds(b_ts)
        first = aligned(F.greatest(one, other) - size_s, slide_s) + slide_s
        starts = steps(first, aligned(F.least(one, other), slide_s), slide_s)
        pairs = left.join(right, _same(on) & (F.col("_bin") == F.col("_r_bin")) & (F.abs(one - other) < size_s))
        pairs = pairs.select(*a.columns, *rest, F.explode(starts).alias("_start"))
        bounds = [F.timestamp_seconds("_start").alias("window_start"), F.timestamp_seconds(F.col("_start") + size_s).alias("window_end")]
        return pairs.select(*bounds, *a.columns, *rest)
    pairs = left.join(right, _same(on) & (F.col("_w") == F.col("_r_w")), "inner")
    start = end - F.expr(f"INTERVAL '{size_s}' SECOND")
    return pairs.select(start.alias("window_start"), end.alias("window_end"), *a.columns, *rest)


def _window_in_place_of_time(df: DataFrame, ts: str, window: str, spec: tuple[str, str]) -> DataFrame:
    """Add the window, which takes over the watermark of the time."""
    columns = [plain_time(c) if c == ts else c for c in df.columns]
    return df.select(*columns, F.window(ts, *spec).alias(window))


def _ends(df: DataFrame, ts: str, size_s: int, slide_s: int) -> DataFrame:
    if slide_s == size_s:
        return df.withColumn("window_end", F.timestamp_seconds(aligned(F.unix_seconds(ts), size_s) + size_s))
    return sliding_ends(df, ts, size_s, slide_s)


def reconcile(
    a: DataFrame,
    b: DataFrame,
    on: str | Sequence[str],
    a_ts: str,
    b_ts: str,
    lo: int | str = -3,
    hi: int | str = 5,
    tags: tuple[str, str, str] = (MATCHED, "unmatched_pay", "unmatched_receipt"),
) -> DataFrame:
    """All pairs within the interval, and the rows of either side without a partner, tagged.

    Columns as of :func:`interval_join` plus ``output``. ``b_ts`` must not be null.
    """
    on = [on] if isinstance(on, str) else list(on)
    lo_s, hi_s = seconds(lo), seconds(hi)
    both, only_a, only_b = tags
    right, rest = _right(b, on)
    rest_a = [c for c in a.columns if c not in on]
    in_range = _same(on) & _in_range(a_ts, b_ts, lo_s, hi_s)
    if a.isStreaming or b.isStreaming:
        joined = a.join(right, in_range, "full_outer")
        tag = F.when(F.col(b_ts).isNull(), only_a).when(F.col(a_ts).isNull(), only_b).otherwise(both)
        keys = [F.coalesce(F.col(c), F.col(f"_r_{c}")).alias(c) for c in on]
        return joined.select(*keys, *rest_a, *rest, tag.alias("output"))
    # Left outer and left anti joins can be split by Spark where a key and bin are still too
    # large for one task, a full outer join cannot.
    same_bin = F.col("_bin") == F.col("_r_bin")
    left, reach = _binned(a, a_ts, right, b_ts, -hi_s, -lo_s)
    of_a = left.join(reach, in_range & same_bin, "left").select(
        *on, *rest_a, *rest, F.when(F.col(b_ts).isNull(), only_a).otherwise(both).alias("output")
    )
    point, reach = _binned(right, b_ts, a.select(*on, a_ts), a_ts, lo_s, hi_s)
    alone = point.join(reach, in_range & same_bin, "left_anti")
    missing = [F.lit(None).cast(a.schema[c].dataType).alias(c) for c in rest_a]
    of_b = alone.select(*[F.col(f"_r_{c}").alias(c) for c in on], *missing, *rest, F.lit(only_b).alias("output"))
    return of_a.unionByName(of_b)
