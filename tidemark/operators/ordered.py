"""Look-back, look-ahead, running numbers and sequences in ordered groups, without one task per group.

A window function keeps a whole group in one task, which a key with a large share of all rows would stall. Here every
group is always cut into bins of time, and a bin learns what it needs of the others from one small row per key and bin,
or from a copy of its neighbour's rows where the rule has a time limit. No job runs while a query is built, nothing is
collected or broadcast, and the plan has the same size whatever the data.

Bins need an order that begins with the time. For an order of one's own (an arrival number, say) a group is one bin.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BIN = "_bin"
#: Width of a bin, where no time limit gives one.
BIN_SECONDS = 3600


def with_bins(df: DataFrame, ts: str, order: Sequence[str], width_s: int = BIN_SECONDS) -> DataFrame:
    """The column ``_bin``: the number of the row's bin of time, or 0 where the order is not by time."""
    number = F.floor(F.unix_micros(ts) / (width_s * 1_000_000)) if order[0] == ts else F.lit(0)
    return df.withColumn(BIN, number.cast("bigint"))


def per_bin(keys: Sequence[str], order: Sequence[str]):
    """Window over the rows of a key and bin, in order."""
    return Window.partitionBy(*keys, BIN).orderBy(*order)


def over_bins(keys: Sequence[str]):
    """Window over the bins of a key, for tables with one row per key and bin."""
    return Window.partitionBy(*keys).orderBy(BIN)


def join_bins(rows: DataFrame, bins: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with what is known of their bin; null is a key like any other."""
    renamed = bins.withColumnsRenamed({c: f"_b_{c}" for c in [*keys, BIN]})
    same = F.col(BIN).eqNullSafe(F.col(f"_b_{BIN}"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_b_{k}"))
    return rows.join(renamed, same).drop(*[f"_b_{c}" for c in [*keys, BIN]])


def with_neighbours(df: DataFrame, keys: Sequence[str], order: Sequence[str], ts: str, value: Column) -> DataFrame:
    """``_before`` and ``_after``: ``value`` of the rows before and after, null at the ends of the group."""
    rows = with_bins(df, ts, order).withColumn("_value", value)
    at = F.struct(*order)
    ends = rows.groupBy(*keys, BIN).agg(F.min_by("_value", at).alias("_first"), F.max_by("_value", at).alias("_last"))
    ends = ends.select(
        *keys,
        BIN,
        F.lag("_last").over(over_bins(keys)).alias("_earlier"),
        F.lead("_first").over(over_bins(keys)).alias("_later"),
    )
    window = per_bin(keys, order)
    near = rows.withColumn("_back", F.lag("_value").over(window)).withColumn("_ahead", F.lead("_value").over(window))
    joined = join_bins(near, ends, keys)
    joined = joined.withColumn("_before", F.coalesce("_back", "_earlier")).withColumn("_after", F.coalesce("_ahead", "_later"))
    return joined.drop("_value", "_back", "_ahead", "_earlier", "_later", BIN)


def with_running_number(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], ts: str, name: str, width_s: int = BIN_SECONDS
) -> DataFrame:
    """``name``: the row's number in its group, from 1."""
    rows = with_bins(df, ts, order, width_s)
    sizes = rows.groupBy(*keys, BIN).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = F.sum("_rows").over(over_bins(keys).rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(*keys, BIN, F.coalesce(earlier, F.lit(0)).alias("_earlier"))
    numbered = rows.withColumn("_number", F.row_number().over(per_bin(keys, order)))
    joined = join_bins(numbered, sizes, keys)
    return joined.withColumn(name, F.col("_earlier") + F.col("_number")).drop("_earlier", "_number", BIN)


def with_runs(df: DataFrame, keys: Sequence[str], order: Sequence[str], ts: str, flag: str) -> DataFrame:
    """``_length`` and ``_begin`` on flagged rows: place in the uninterrupted run of flagged rows, and its first time.

    The run that is open at the end of a bin goes on into the next; runs over many bins add up the counts of all bins
    since the last interruption.
    """
    rows = with_bins(df, ts, order)
    window = per_bin(keys, order)
    breaks = F.sum(F.when(F.col(flag), 0).otherwise(1)).over(window.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("_breaks", breaks)
    upto = Window.partitionBy(*keys, BIN, "_breaks").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_here", F.sum(F.when(F.col(flag), 1).otherwise(0)).over(upto))
    rows = rows.withColumn("_start", F.first(F.when(F.col(flag), F.col(ts)), ignorenulls=True).over(upto))

    # What a bin hands on is what its last row has reached.
    last = F.max_by(F.struct("_here", "_start"), F.struct(*order)).alias("_last")
    bins = rows.groupBy(*keys, BIN).agg(last, (F.max("_breaks") > 0).cast("int").alias("_stopped"))
    bins = bins.select(*keys, BIN, "_stopped", F.col("_last._here").alias("_n"), F.col("_last._start").alias("_from"))
    bins = bins.withColumn("_part", F.sum("_stopped").over(over_bins(keys)))
    since = Window.partitionBy(*keys, "_part").orderBy(BIN).rowsBetween(Window.unboundedPreceding, 0)
    bins = bins.withColumn("_open", F.sum("_n").over(since))
    bins = bins.withColumn("_since", F.first("_from", ignorenulls=True).over(since))
    bins = bins.select(
        *keys,
        BIN,
        F.lag("_open", 1, 0).over(over_bins(keys)).alias("_open"),
        F.lag("_since").over(over_bins(keys)).alias("_since"),
    )
    joined = join_bins(rows, bins, keys)
    goes_on = (F.col("_breaks") == 0) & (F.col("_open") > 0)
    return joined.select(
        *df.columns,
        F.when(F.col(flag), F.col("_here") + F.when(goes_on, F.col("_open")).otherwise(0)).alias("_length"),
        F.when(F.col(flag), F.when(goes_on, F.col("_since")).otherwise(F.col("_start"))).alias("_begin"),
    )


def with_next_bin(df: DataFrame, ts: str, order: Sequence[str], width_s: int) -> DataFrame:
    """Every row in its own bin (``_own``) and, as a look-ahead, in the one before.

    A rule with a time limit of at most ``width_s`` sees in a bin all that its own rows need.
    """
    rows = with_bins(df, ts, order, width_s)
    copies = F.array(F.struct(F.lit(True).alias("own"), F.lit(0).alias("step")), F.struct(F.lit(False).alias("own"), F.lit(1).alias("step")))
    rows = rows.withColumn("_copy", F.explode(copies))
    return rows.withColumn(BIN, F.col(BIN) - F.col("_copy.step")).withColumn("_own", F.col("_copy.own")).drop("_copy")
