"""Sequences of events per key within a time limit, with time-outs of unfinished ones."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import seconds
from .ordered import BIN, with_next_bin

NEXT = "next"
FOLLOWED_BY = "followed_by"
MATCHED = "matched"
TIMEOUT = "timeout"


@dataclass(frozen=True)
class Step:
    """One event of a sequence.

    ``next`` asks for the directly following event of the key; ``followed_by`` skips events up to
    the first that fits. The first step's contiguity has no meaning.
    """

    name: str
    condition: Column
    contiguity: str = FOLLOWED_BY


def match_sequence(
    df: DataFrame,
    keys: str | Sequence[str],
    ts: str,
    steps: Sequence[Step],
    within: int | str,
    order_by: Sequence[str] = (),
    on_timeout: bool = True,
) -> DataFrame:
    """One row per first-step event that completes the sequence or runs out of time.

    Events of a key are taken in order of ``ts``, then ``order_by``. All steps must lie less than
    ``within`` after the first. Columns: keys, ``<step>_ts`` per step, ``output`` (``matched`` or
    ``timeout``); a timed-out row has null for the steps it did not reach. A start whose strict
    ``next`` step meets another event in time yields nothing.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if len(steps) < 2 or any(s.contiguity not in (NEXT, FOLLOWED_BY) for s in steps):
        raise ValueError("need at least two steps, each 'next' or 'followed_by'")
    within_s = seconds(within)
    tie = [c for c in order_by if c != ts]
    if all(s.contiguity == FOLLOWED_BY for s in steps[1:]):
        # Events that are no step cannot change a relaxed sequence: leave them in the scan.
        useful = steps[0].condition
        for s in steps[1:]:
            useful = useful | s.condition
        df = df.filter(useful)
    flags = [F.coalesce(s.condition, F.lit(False)).alias(f"_is{i}") for i, s in enumerate(steps)]
    rows = df.select(*keys, ts, *tie, *flags)
    if df.isStreaming:
        from ..streaming.processors import match_sequence_stream

        found = match_sequence_stream(
            rows, keys, ts, [s.name for s in steps], [s.contiguity for s in steps], within_s, tie
        )
    else:
        found = _match_batch(rows, keys, ts, tie, steps, within_s)
    return found if on_timeout else found.filter(F.col("output") == MATCHED)


def _match_batch(
    rows: DataFrame,
    keys: list[str],
    ts: str,
    tie: list[str],
    steps: Sequence[Step],
    within_s: int,
) -> DataFrame:
    """Work from the last step back: every event learns how the sequence goes on from it.

    Keys are cut into bins of the time limit, each with a copy of the next bin's rows, which is all that a start in
    the bin can reach in time.

    ``_tail{i}`` of an event fitting step i holds the times ``t{i}, t{i+1}, ..`` of the steps as
    far as they were found, and in ``broke`` the time of the event that failed a strict step.
    """
    rows = with_next_bin(rows, ts, [ts, *tie], max(1, within_s))
    # Reading backwards turns "first of all following" into a running last, linear in rows.
    backwards = Window.partitionBy(*keys, BIN).orderBy(*[F.col(c).desc() for c in (ts, *tie)])
    following = backwards.rowsBetween(Window.unboundedPreceding, -1)
    last = len(steps) - 1
    never = F.lit(None).cast("timestamp")

    def tail_from(i: int, further: Callable[[int], Column], broke: Column) -> Column:
        times = [F.col(ts).alias(f"t{i}")] + [further(j).alias(f"t{j}") for j in range(i + 1, last + 1)]
        return F.struct(*times, broke.alias("broke"))

    rows = rows.withColumn(f"_tail{last}", F.when(F.col(f"_is{last}"), tail_from(last, None, never)))
    for i in range(last - 1, -1, -1):
        further = F.col(f"_tail{i + 1}")
        if steps[i + 1].contiguity == FOLLOWED_BY:
            rows = rows.withColumn("_ahead", F.last(further, ignorenulls=True).over(following))
            tail, broke = F.col("_ahead"), never
        else:
            next_event = F.struct(F.col(ts).alias("at"), further.alias("tail"))
            rows = rows.withColumn("_ahead", F.lag(next_event).over(backwards))
            tail, broke = F.col("_ahead.tail"), F.col("_ahead.at")
        going_on = tail_from(i, lambda j: tail.getField(f"t{j}"), tail.getField("broke"))
        stuck = tail_from(i, lambda j: never, broke)
        here = F.when(tail.isNotNull(), going_on).otherwise(stuck)
        rows = rows.withColumn(f"_tail{i}", F.when(F.col(f"_is{i}"), here))

    limit_us = within_s * 1_000_000
    start = F.unix_micros(ts)
    in_time = lambda at: F.unix_micros(at) - start < limit_us
    times = [F.col(f"_tail0.t{i}") for i in range(last + 1)]
    broke = F.col("_tail0.broke")
    # Times only grow along the steps, and greatest() skips the missing ones.
    output = (
        F.when(~in_time(F.greatest(*times)), TIMEOUT)
        .when(times[last].isNotNull(), MATCHED)
        .when(broke.isNull() | ~in_time(broke), TIMEOUT)
    )
    step_times = [F.when(in_time(at), at).alias(f"{step.name}_ts") for step, at in zip(steps, times)]
    return (
        rows.filter(F.col("_is0") & F.col("_own"))
        .select(*keys, *step_times, output.alias("output"))
        .filter(F.col("output").isNotNull())
    )
