"""Counts, averages and other aggregates over tumbling and sliding event-time windows.

All results carry the grouping keys, ``window_start`` and ``window_end``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import aligned, seconds, start_range, steps, window_ends

# The built-in window expression projects every row once per overlapping window inside one
# generated method; far above this overlap that method no longer compiles.
MAX_BUILTIN_OVERLAP = 12

# Types whose sums can be taken back by subtraction without an error.
EXACT_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)

WATERMARK_METADATA = "spark.watermarkDelayMs"


def sliding_ends(df: DataFrame, ts: str, size: int | str, slide: int | str) -> DataFrame:
    """One row per window of ``ts``, with the window end as the column ``window_end``.

    Project to the needed columns first: rows are multiplied by ``size / slide``. On a stream the
    window end takes over the watermark of ``ts``: once that has passed the end, no row can fall
    into the window any more.
    """
    ends = F.explode(window_ends(F.unix_seconds(ts), seconds(size), seconds(slide)))
    watermark = {k: v for k, v in (df.schema[ts].metadata or {}).items() if k == WATERMARK_METADATA}
    end = F.timestamp_seconds("_end").alias("window_end", metadata=watermark or None)
    return df.withColumn("_end", ends).select(*df.columns, end)


def with_windows(df: DataFrame, ts: str, size: int | str, slide: int | str | None = None) -> DataFrame:
    """Give rows a grouping column ``window`` (struct) or, for a large overlap, ``window_end``."""
    size_s = seconds(size)
    slide_s = seconds(slide) if slide is not None else size_s
    if slide_s <= size_s <= MAX_BUILTIN_OVERLAP * slide_s:
        return df.withColumn("window", F.window(ts, f"{size_s} seconds", f"{slide_s} seconds"))
    return sliding_ends(df, ts, size_s, slide_s)


def _bounds(df: DataFrame, keys: Sequence[str], size_s: int, values: Sequence[str | Column]) -> DataFrame:
    if "window" in df.columns:
        start, end = F.col("window.start"), F.col("window.end")
    else:
        end = F.col("window_end")
        start = end - F.make_interval(secs=F.lit(size_s))
    return df.select(*keys, start.alias("window_start"), end.alias("window_end"), *values)


def windowed_agg(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: int | str,
    slide: int | str | None = None,
    **aggregates: Column,
) -> DataFrame:
    """Any aggregate expressions per key and window, grouped-aggregate Pandas UDFs included."""
    out = with_windows(df, ts, size, slide)
    by = "window" if "window" in out.columns else "window_end"
    grouped = out.groupBy(*keys, by).agg(*[a.alias(name) for name, a in aggregates.items()])
    return _bounds(grouped, keys, seconds(size), list(aggregates))


def _sliding_sums(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size_s: int,
    slide_s: int,
    parts: Mapping[str, Column],
    present: str,
) -> DataFrame:
    """Sums over overlapping windows, built from non-overlapping panes.

    Rows are first reduced to one cell per key and pane, so what is shuffled does not grow with
    the overlap. Cells are then placed by key and block of window starts; a cell reaches at most
    two blocks. A busy key is spread over its blocks, and a block holds a fixed number of panes
    whatever the number of raw rows. ``present`` names the part that counts rows.
    """
    keys = list(keys)
    cells = _cells(df, keys, ts, size_s, slide_s, parts)
    placed = _placed(cells, keys, size_s, slide_s, list(parts))
    exact = all(isinstance(placed.schema[p].dataType, EXACT_TYPES) for p in parts)
    summed = (_by_changes if exact else _by_expansion)(placed, keys, slide_s, list(parts), present)
    return summed.select(*keys, *_bounds_of(F.col("_start"), size_s), *parts)


def _bounds_of(start_s: Column, size_s: int) -> list[Column]:
    return [F.timestamp_seconds(start_s).alias("window_start"), F.timestamp_seconds(start_s + size_s).alias("window_end")]


def _cells(
    df: DataFrame, keys: list[str], ts: str, size_s: int, slide_s: int, parts: Mapping[str, Column], more: Sequence[Column] = ()
) -> DataFrame:
    """One row per key and pane (column ``_pane``, its first second), and by ``more``."""
    pane = aligned(F.unix_seconds(ts), gcd(size_s, slide_s)).alias("_pane")
    return df.groupBy(*keys, *more, pane).agg(*[part.alias(name) for name, part in parts.items()])


def _placed(
    cells: DataFrame, keys: list[str], size_s: int, slide_s: int, values: list[str], more: Sequence[str] = ()
) -> DataFrame:
    """Cells by key and block of window starts, with the starts ``[_from, _until)`` in the block that hold them."""
    block_s = slide_s * -(-4 * size_s // slide_s)
    first, last = start_range(F.col("_pane"), size_s, slide_s)
    blocks = F.explode(steps(aligned(first, block_s), aligned(last, block_s), block_s))
    # The partition count is given, because merging partitions that are small before the windows
    # are written out would undo the spread.
    partitions = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block = F.col("_block")
    return (
        cells.select(*keys, *more, *values, first.alias("_first"), last.alias("_last"), blocks.alias("_block"))
        .repartition(partitions, *keys, *more, "_block")
        .select(
            *keys,
            *more,
            *values,
            "_block",
            F.greatest("_first", block).alias("_from"),
            F.least(F.col("_last") + slide_s, block + block_s).alias("_until"),
        )
    )


def _by_changes(placed: DataFrame, keys: list[str], slide_s: int, parts: list[str], present: str) -> DataFrame:
    """A cell adds to the sums at its first window start and takes the same away after its last.

    The running total of these changes is the sum of every window up to the next change, so the
    work grows with cells and results, not with cells times overlap. Needs exact arithmetic.
    """
    up = F.struct(F.col("_from").alias("at"), *[F.col(p).alias(p) for p in parts])
    down = F.struct(F.col("_until").alias("at"), *[(-F.col(p)).alias(p) for p in parts])
    changes = (
        placed.select(*keys, "_block", F.explode(F.array(up, down)).alias("_change"))
        .groupBy(*keys, "_block", F.col("_change.at").alias("_at"))
        .agg(*[F.sum(f"_change.{p}").alias(p) for p in parts])
    )
    in_order = Window.partitionBy(*keys, "_block").orderBy("_at")
    upto = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = changes.select(
        *keys,
        "_at",
        F.lead("_at").over(in_order).alias("_next"),
        *[F.sum(p).over(upto).alias(p) for p in parts],
    ).filter(F.col(present) > 0)
    return totals.select(
        *keys, *parts, F.explode(steps(F.col("_at"), F.col("_next") - slide_s, slide_s)).alias("_start")
    )


def _by_expansion(placed: DataFrame, keys: list[str], slide_s: int, parts: list[str], present: str) -> DataFrame:
    """Every cell once per window, summed inside the block where the copies arise."""
    starts = F.explode(steps(F.col("_from"), F.col("_until") - slide_s, slide_s)).alias("_start")
    return (
        placed.select(*keys, *parts, "_block", starts)
        .groupBy(*keys, "_block", "_start")
        .agg(*[F.sum(p).alias(p) for p in parts])
    )


def windowed_count(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: int | str,
    slide: int | str | None = None,
    count: str = "count",
    closed_only: bool = False,
) -> DataFrame:
    """Rows per key and window.

    On a stream every row is given to each of its windows before it is counted. With ``closed_only`` (for append mode,
    where a count comes once its window has closed) rows are counted in panes first and only the panes' counts are
    given to the windows, so that the overlap multiplies results rather than rows.
    """
    size_s = seconds(size)
    slide_s = seconds(slide) if slide is not None else size_s
    if df.isStreaming and closed_only and slide_s < size_s:
        pane = F.window(ts, f"{gcd(size_s, slide_s)} seconds").alias("_pane")
        cells = df.groupBy(*keys, pane).agg(F.count(F.lit(1)).alias(count))
        cells = cells.select(*keys, F.window_time("_pane").alias(ts), count)
        return windowed_agg(cells, keys, ts, size_s, slide_s, **{count: F.sum(count)})
    if df.isStreaming or slide_s >= size_s:
        return windowed_agg(df.select(*keys, ts), keys, ts, size_s, slide_s, **{count: F.count(F.lit(1))})
    return _sliding_sums(df, keys, ts, size_s, slide_s, {count: F.count(F.lit(1))}, present=count)


def windowed_avg(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    ts: str,
    size: int | str,
    slide: int | str | None = None,
    average: str = "average",
) -> DataFrame:
    """Average of ``value`` per key and window; null values do not count."""
    size_s = seconds(size)
    slide_s = seconds(slide) if slide is not None else size_s
    if df.isStreaming or slide_s >= size_s:
        return windowed_agg(df.select(*keys, ts, value), keys, ts, size_s, slide_s, **{average: F.avg(value)})
    number = F.col(value)
    if not isinstance(df.schema[value].dataType, EXACT_TYPES):
        number = number.cast("double")
    parts = {
        "_sum": F.coalesce(F.sum(number), F.lit(0)),
        "_n": F.count(value),
        "_rows": F.count(F.lit(1)),
    }
    sums = _sliding_sums(df, keys, ts, size_s, slide_s, parts, present="_rows")
    mean = F.when(F.col("_n") > 0, F.col("_sum") / F.col("_n")).alias(average)
    return sums.select(*keys, "window_start", "window_end", mean)


def windowed_extremes(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    ts: str,
    size: int | str,
    slide: int | str | None = None,
    lowest: str = "lowest",
    highest: str = "highest",
) -> DataFrame:
    """Least and greatest ``value`` per key and window; null where a window's values are all null.

    A least value cannot be taken back when a pane leaves a window, and rows are not multiplied by the overlap either.
    Time is cut into chunks of the window's length, so that a window is the end of one chunk and the beginning of the
    next. Running extremes over the panes of a chunk, forwards and backwards, then give each of its two parts. The work
    grows with panes and results, and a busy key is spread over its chunks. Rows without a time are in no window.
    """
    keys, size_s = list(keys), seconds(size)
    slide_s = seconds(slide) if slide is not None else size_s
    extremes = {lowest: F.min(value), highest: F.max(value)}
    if df.isStreaming or slide_s >= size_s:
        return windowed_agg(df.select(*keys, ts, value), keys, ts, size_s, slide_s, **extremes)
    parts = {"_low": extremes[lowest], "_high": extremes[highest], "_rows": F.count(F.lit(1))}
    cells = _cells(df, keys, ts, size_s, slide_s, parts).filter(F.col("_pane").isNotNull())
    windows = _by_changes(_placed(cells, keys, size_s, slide_s, ["_rows"]), keys, slide_s, ["_rows"], "_rows")

    chunk = lambda at: aligned(at, size_s).alias("_chunk")
    nothing = [F.lit(None).cast(cells.schema[c].dataType).alias(c) for c in ("_low", "_high")]
    start, end = F.col("_start"), F.col("_start") + size_s
    no_start = F.lit(None).cast("bigint").alias("_start")
    panes = cells.select(*keys, chunk(F.col("_pane")), F.col("_pane").alias("_at"), F.lit(0).alias("_kind"), no_start, "_low", "_high")
    # Kind 1 looks from the window's start to the end of the chunk, kind -1 from the chunk's beginning to its end.
    sides = F.explode(F.array(F.struct(start.alias("at"), F.lit(1).alias("kind")), F.struct(end.alias("at"), F.lit(-1).alias("kind"))))
    asked = windows.select(*keys, "_start", sides.alias("_side"))
    asked = asked.select(*keys, chunk(F.col("_side.at")), F.col("_side.at").alias("_at"), F.col("_side.kind").alias("_kind"), "_start", *nothing)
    rows = panes.union(asked)
    group = Window.partitionBy(*keys, "_chunk")
    forwards = group.orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    backwards = group.orderBy(F.desc("_at"), "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    part = lambda pick, c: F.when(F.col("_kind") == 1, pick(c).over(backwards)).when(F.col("_kind") == -1, pick(c).over(forwards))
    seen = rows.select(*keys, "_start", part(F.min, "_low").alias("_low"), part(F.max, "_high").alias("_high"))
    merged = seen.filter(F.col("_start").isNotNull()).groupBy(*keys, "_start")
    merged = merged.agg(F.min("_low").alias(lowest), F.max("_high").alias(highest))
    return merged.select(*keys, *_bounds_of(start, size_s), lowest, highest)


def windowed_distinct(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    ts: str,
    size: int | str,
    slide: int | str | None = None,
    count: str = "count",
) -> DataFrame:
    """Distinct values per key and window, null not counted (0 where all values of a window are null).

    A value counts in the windows that hold any of its panes. Of every pane only the windows are taken that the value's
    pane before it does not reach, so that these ranges do not overlap and add up by running changes: the work grows
    with distinct values per pane and results, not with the overlap. Rows without a time are in no window.
    """
    keys, size_s = list(keys), seconds(size)
    slide_s = seconds(slide) if slide is not None else size_s
    if df.isStreaming or slide_s >= size_s:
        return windowed_agg(df.select(*keys, ts, value), keys, ts, size_s, slide_s, **{count: F.count_distinct(value)})
    cells = _cells(df, keys, ts, size_s, slide_s, {"_rows": F.lit(1).cast("bigint")}, [F.col(value).alias("_value")])
    # Null has ranges like a value: windows that hold nothing else are there, and count 0.
    placed = _placed(cells.filter(F.col("_pane").isNotNull()), keys, size_s, slide_s, ["_rows"], ["_value"])
    before = F.lag("_until").over(Window.partitionBy(*keys, "_value", "_block").orderBy("_from", "_until"))
    fresh = placed.withColumn("_from", F.greatest("_from", before)).filter(F.col("_from") < F.col("_until"))
    fresh = fresh.withColumn(count, F.col("_value").isNotNull().cast("bigint"))
    summed = _by_changes(fresh, keys, slide_s, [count, "_rows"], "_rows")
    return summed.select(*keys, *_bounds_of(F.col("_start"), size_s), count)


def page_views(df: DataFrame, ts: str, size: int | str = "1 hour", label: str = "pv") -> DataFrame:
    """Rows per tumbling window under a constant label."""
    ones = windowed_agg(df.select(ts), [], ts, size, None, count=F.sum(F.lit(1)))
    return ones.select(F.lit(label).alias("label"), "window_start", "window_end", "count")
