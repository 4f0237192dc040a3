"""Sliding counts of streams in keyed state: a ring of pane counts per key, a running total, and a timer per slide."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import gcd

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from ..functions.time import seconds
from .processors import _ddl

#: With more windows due than this, the panes are read at one go instead of one by one.
AT_ONCE = 16


class SlidingCounts(StatefulProcessor):
    """Gives each window's count once the watermark has passed its end. All times are seconds.

    State of a key: the counts of its panes that a window to come still needs; the start of the next window and the
    total of the one before. The next window adds the panes that enter it and takes away those that left, which are
    then removed. A key without rows in a whole window has no state.
    """

    def __init__(self, fields: Sequence[str], size: int, slide: int):
        self.fields, self.size, self.slide, self.pane = list(fields), size, slide, gcd(size, slide)

    def init(self, handle) -> None:
        self.handle = handle
        self.panes = handle.getMapState("panes", "pane BIGINT", "n BIGINT")
        self.next = handle.getValueState("next", "start BIGINT, total BIGINT")

    def _first_start(self, pane: int) -> int:
        return (pane - self.size) // self.slide * self.slide + self.slide

    def _set(self, start: int, total: int) -> None:
        self.next.update((start, total))
        self.handle.registerTimer((start + self.size) * 1000)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        earliest = None
        for row in rows:
            pane, n = row["pane_s"], row["n"]
            if self.panes.containsKey((pane,)):
                n += self.panes.getValue((pane,))[0]
            self.panes.updateValue((pane,), (n,))
            earliest = pane if earliest is None else min(earliest, pane)
        if earliest is not None and not self.next.exists():
            self._set(self._first_start(earliest), 0)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.next.exists():
            return iter([])
        start, total = self.next.get()
        mark = timerValues.getCurrentWatermarkInMs() // 1000
        if (start + self.size) * 1000 < expiredTimerInfo.getExpiryTimeInMs():
            return iter([])
        held = None
        if (mark - self.size - start) // self.slide > AT_ONCE:
            held = {pane: n for (pane,), (n,) in self.panes.iterator()}

        def taken(begin: int, remove: bool) -> int:
            found = 0
            for pane in range(begin, begin + self.slide, self.pane):
                if held is None:
                    n = self.panes.getValue((pane,))[0] if self.panes.containsKey((pane,)) else 0
                else:
                    n = held.pop(pane, 0) if remove else held.get(pane, 0)
                if n and remove:
                    self.panes.removeKey((pane,))
                found += n
            return found

        result, out = Row(*self.fields), []
        while start + self.size <= mark:
            total += taken(start + self.size - self.slide, False)
            total -= taken(start - self.slide, True)
            if total:
                out.append(result(*key, start, total))
            start += self.slide
            if not total:
                # The panes of the last slide have all been taken away; what is left begins later.
                left = held if held is not None else [pane for (pane,) in self.panes.keys()]
                later = [pane for pane in left if pane >= start + self.size - self.slide]
                if not later:
                    self.next.clear()
                    self.panes.clear()
                    return iter(out)
                start = max(start, self._first_start(min(later)))
        self._set(start, total)
        return iter(out)


def sliding_counts(
    df: DataFrame, keys: Sequence[str], ts: str, size: int | str, slide: int | str, count: str = "count"
) -> DataFrame:
    """Rows per key and sliding window of a stream with a watermark, in append mode: each window once, when it closes.

    Rows are counted in panes first (combined before the shuffle, so a busy key costs its task one row per pane); the
    panes' counts then go to the keyed state. Neither rows nor panes are multiplied by the overlap: only results are
    one per window.
    """
    size_s, slide_s = seconds(size), seconds(slide)
    names = [f"key{i}" for i in range(len(keys))]
    pane = F.window(ts, f"{gcd(size_s, slide_s)} seconds").alias("pane")
    cells = df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)], pane).agg(F.count(F.lit(1)).alias("n"))
    cells = cells.select(*names, F.window_time("pane").alias("at"), F.unix_seconds("pane.start").alias("pane_s"), "n")
    processor = SlidingCounts([*names, "start_s", "total"], size_s, slide_s)
    counted = cells.groupBy(*names).transformWithState(
        processor, f"{_ddl(cells, names)}, start_s BIGINT, total BIGINT", "append", "EventTime"
    )
    return counted.select(
        *[F.col(n).alias(k) for k, n in zip(keys, names)],
        F.timestamp_seconds("start_s").alias("window_start"),
        F.timestamp_seconds(F.col("start_s") + size_s).alias("window_end"),
        F.col("total").alias(count),
    )
