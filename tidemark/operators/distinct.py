"""Distinct visitors per window: exact, by bitmap position, approximate, and running."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import bitmap_position
from ..functions.time import plain_time, seconds
from .ordered import with_running_number
from .windows import windowed_agg

METHODS = ("exact", "bitmap", "approx")


def _identity(id_col: str, method: str) -> Column:
    return bitmap_position(id_col) if method == "bitmap" else F.col(id_col)


def unique_count(
    df: DataFrame,
    id_col: str,
    ts: str,
    size: int | str = "1 hour",
    method: str = "exact",
    rsd: float = 0.05,
) -> DataFrame:
    """Distinct ids per tumbling window.

    ``bitmap`` counts distinct positions in a 2^28-bit map, so ids whose hashes collide count
    once; ``approx`` is HyperLogLog++ with relative error ``rsd``.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    narrow = df.select(ts, _identity(id_col, method).alias("_id"))
    if method == "approx":
        return windowed_agg(narrow, [], ts, size, count=F.approx_count_distinct("_id", rsd))
    if not df.isStreaming:
        return windowed_agg(narrow, [], ts, size, count=F.count_distinct("_id"))
    size_s = seconds(size)
    first_seen = narrow.withColumn("window", F.window(ts, f"{size_s} seconds")).dropDuplicates(["window", "_id"])
    counted = first_seen.groupBy("window").agg(F.count("_id").alias("count"))
    return counted.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "count"
    )


def window_bitmaps(df: DataFrame, id_col: str, ts: str, size: int | str = "1 hour") -> DataFrame:
    """The 2^28-bit maps of tumbling windows as values that can be stored and merged: a row per window and bucket.

    Columns ``window_start``, ``window_end``, ``bucket`` and ``bitmap`` (4 kB each, 32,768 positions); buckets without a
    bit have no row. Bits are set before the shuffle, which so carries bitmaps instead of ids.
    """
    rows = df.select(ts, bitmap_position(id_col).alias("_position")).where("_position IS NOT NULL")
    rows = rows.select(ts, F.bitmap_bucket_number("_position").alias("bucket"), F.bitmap_bit_position("_position").alias("_bit"))
    return windowed_agg(rows, ["bucket"], ts, size, bitmap=F.bitmap_construct_agg("_bit"))


def merged_unique_count(bitmaps: DataFrame, size: int | str = "1 day") -> DataFrame:
    """Distinct positions per larger window (a multiple of the bitmaps' own) out of ``window_bitmaps``."""
    merged = windowed_agg(bitmaps, ["bucket"], "window_start", size, bits=F.bitmap_or_agg("bitmap"))
    counted = merged.groupBy("window_start", "window_end").agg(F.sum(F.bitmap_count("bits")).alias("count"))
    return counted.select("window_start", "window_end", "count")


def first_sights(
    stream: DataFrame, id_col: str, ts: str, size: int | str = "1 hour", method: str = "exact"
) -> DataFrame:
    """On a stream: one row per window and id, given out when the id is first met.

    ``streaming.running_unique_sink`` numbers them as they come.
    """
    window = F.window(ts, f"{seconds(size)} seconds")
    rows = stream.select(window.alias("window"), _identity(id_col, method).alias("id"), plain_time(ts).alias("first_seen"))
    return rows.dropDuplicates(["window", "id"]).select(
        F.col("window.end").alias("window_end"), "id", "first_seen"
    )


def running_unique_count(
    df: DataFrame,
    id_col: str,
    ts: str,
    size: int | str = "1 hour",
    order_by: Sequence[str] = (),
    method: str = "exact",
) -> DataFrame:
    """Every first sight of an id in its window, with the distinct count reached at that row.

    Rows are taken in order of ``ts``, then ``order_by``.
    """
    size_s = seconds(size)
    window = F.window(ts, f"{size_s} seconds")
    order = [ts, *order_by]
    rows = df.select(window.getField("end").alias("window_end"), _identity(id_col, method).alias("id"), *order)
    # Times are combined in a hash aggregate; only what ties with the first time is compared further.
    first = rows.groupBy("window_end", "id").agg(F.min(ts).alias(ts), *[F.min_by(c, F.struct(*order)).alias(c) for c in order_by])
    counted = with_running_number(first, ["window_end"], order, ts, "count", max(1, size_s // 60))
    return counted.select("window_end", "id", F.col(ts).alias("first_seen"), F.col("count").cast("bigint").alias("count"))
