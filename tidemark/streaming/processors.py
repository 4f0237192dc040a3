"""Per-key state for the detectors on streams.

Spark gives the rows of a key in no particular order within a micro-batch. ``InOrder`` therefore
keeps them until the watermark has passed them and hands them to a small rule in event-time
order, so a stream and a batch table give the same rows. State is bounded by what the watermark
delay and the rule's own time limit hold back. The state store has to be the RocksDB one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from ..functions.text import PAID, PAID_LATE, PAID_UNKNOWN, TIMED_OUT
from ..functions.time import utc_day
from ..operators.patterns import MATCHED, NEXT, TIMEOUT

Rows = list[tuple]
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_MS = 86_400_000
#: Rows of one entry of the state, and the width of a time slice.
APPEND_ROWS = 1000
SLICE_US = 1_000_000
TIME = "at_us"


def use_rocksdb(spark) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _nulls_first(row: tuple) -> list:
    return [(value is not None, value) for value in row]


class InOrder(StatefulProcessor):
    """Calls ``advance`` with the rows the watermark has passed, oldest first.

    Times are microseconds. ``memory`` is what the rule keeps between calls, as a list of tuples. Waiting rows lie in
    slices of time, so that a call reads the slices that are due (and an index with one entry per slice), not all rows;
    of the slice that the watermark has only begun the rest is written back.
    """

    memory_schema: str
    fields: list[str]  # of a result row: the keys, then what the rule gives

    def __init__(self, columns: Sequence[str], column_types: Sequence[str]):
        self.columns = list(columns)
        self.row_schema = ", ".join(f"c{i} {kind}" for i, kind in enumerate(column_types))

    def advance(self, memory: Rows, rows: Rows, mark: int) -> tuple[Rows, Rows, int | None]:
        """Results, new memory, and the time from which on to be called again without new rows."""
        raise NotImplementedError

    def init(self, handle) -> None:
        self.handle = handle
        row = ", ".join(c.replace(" ", ": ", 1) for c in self.row_schema.split(", "))
        self.waiting = handle.getMapState("waiting", "slice BIGINT, part BIGINT", f"rows ARRAY<STRUCT<{row}>>")
        self.index = handle.getListState("slices", "slice BIGINT, parts BIGINT, earliest BIGINT")
        self.memory = handle.getListState("memory", self.memory_schema)
        self.wake = handle.getValueState("wake", "at BIGINT")

    def _wake_after(self, time_us: int) -> None:
        at = time_us // 1000 + 1
        if self.wake.exists():
            planned = self.wake.get()[0]
            if planned <= at:
                return
            self.handle.deleteTimer(planned)
        self.handle.registerTimer(at)
        self.wake.update((at,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        index, batch, size, earliest = self._slices(), {}, 0, None
        for row in rows:
            values = tuple(row[c] for c in self.columns)
            earliest = values[0] if earliest is None else min(earliest, values[0])
            batch.setdefault(values[0] // SLICE_US, []).append(values)
            size += 1
            if size == APPEND_ROWS:
                self._put(index, batch)
                batch, size = {}, 0
        self._put(index, batch)
        if earliest is not None:
            self._store(self.index, [(s, *entry) for s, entry in index.items()])
            self._wake_after(earliest)
        return iter([])

    def _slices(self) -> dict[int, tuple[int, int]]:
        """The number of parts and the earliest time of every slice with waiting rows."""
        return {s: (parts, at) for s, parts, at in self.index.get()} if self.index.exists() else {}

    def _put(self, index: dict, batch: dict[int, Rows]) -> None:
        for number, rows in batch.items():
            parts, at = index.get(number, (0, rows[0][0]))
            self.waiting.updateValue((number, parts), (rows,))
            index[number] = parts + 1, min(at, *(row[0] for row in rows))

    def _take_until(self, mark: int) -> tuple[Rows, int | None]:
        """Waiting rows before ``mark``, in order, and the earliest time of those that stay."""
        index, ready, begun = self._slices(), [], {}
        for number in [s for s in index if s * SLICE_US < mark]:
            parts, _ = index.pop(number)
            for part in range(parts):
                for row in self.waiting.getValue((number, part))[0]:
                    values = tuple(row)
                    if values[0] < mark:
                        ready.append(values)
                    else:
                        begun.setdefault(number, []).append(values)
                self.waiting.removeKey((number, part))
        self._put(index, begun)
        self._store(self.index, [(s, *entry) for s, entry in index.items()])
        return sorted(ready, key=_nulls_first), min((at for _, at in index.values()), default=None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.wake.exists() or self.wake.get()[0] != expiredTimerInfo.getExpiryTimeInMs():
            return iter([])
        self.wake.clear()
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        ready, earliest = self._take_until(mark)
        memory = list(self.memory.get()) if self.memory.exists() else []
        results, memory, due = self.advance(memory, ready, mark)
        self._store(self.memory, memory)
        times = [at for at in (earliest, due) if at is not None]
        if times:
            self._wake_after(min(times))
        result = Row(*self.fields)
        return iter([result(*key, *r) for r in results])

    @staticmethod
    def _store(state, rows: Rows) -> None:
        if rows:
            state.put(rows)
        elif state.exists():
            state.clear()


class DayNumbers(InOrder):
    """Rows of a key and day, numbered; the number reached is forgotten when the day is over."""

    memory_schema = "n BIGINT, until BIGINT"

    def advance(self, memory, rows, mark):
        found, (n, until) = [], memory[0] if memory else (0, 0)
        for at, *values in rows:
            n += 1
            until = (at // (DAY_MS * 1000) + 1) * DAY_MS * 1000
            found.append((at, *values, n))
        return (found, [(n, until)], until) if mark <= until else (found, [], None)


class FailPairs(InOrder):
    memory_schema = "at BIGINT"

    def __init__(self, *layout, gap_us: int):
        super().__init__(*layout)
        self.gap_us = gap_us

    def advance(self, memory, rows, mark):
        found, before = [], memory[0][0] if memory else None
        for at, *_, failed in rows:
            if failed and before is not None and at - before < self.gap_us:
                found.append((before, at))
            before = at if failed else None
        return found, [] if before is None else [(before,)], None


class FailRuns(InOrder):
    memory_schema = "length BIGINT, first BIGINT"

    def __init__(self, *layout, span_us: int, min_fails: int):
        super().__init__(*layout)
        self.span_us, self.min_fails = span_us, min_fails

    def advance(self, memory, rows, mark):
        found = []
        length, first = memory[0] if memory else (0, 0)
        for at, *_, failed in rows:
            if not failed:
                length = 0
                continue
            first = at if length == 0 else first
            length += 1
            if length == self.min_fails and at - first < self.span_us:
                found.append((first, at))
        return found, [(length, first)] if length else [], None


class OrderPay(InOrder):
    memory_schema = "opened BIGINT"

    def __init__(self, *layout, timeout_us: int, keep_us: int):
        super().__init__(*layout)
        self.timeout_us, self.keep_us = timeout_us, keep_us

    def advance(self, memory, rows, mark):
        found, opened = [], memory[0][0] if memory else None
        for at, is_pay, *_ in rows:
            if not is_pay:
                if opened is not None and at - opened >= self.timeout_us:
                    found.append((opened, None, TIMED_OUT))
                opened = at
                continue
            if opened is not None and at - opened >= self.timeout_us + self.keep_us:
                found.append((opened, None, TIMED_OUT))
                opened = None
            if opened is None:
                found.append((None, at, PAID_UNKNOWN))
            else:
                found.append((opened, at, PAID if at - opened < self.timeout_us else PAID_LATE))
                opened = None
        if opened is None:
            return found, [], None
        due = opened + self.timeout_us + self.keep_us
        if due < mark:
            return [*found, (opened, None, TIMED_OUT)], [], None
        return found, [(opened,)], due


class StepSequence(InOrder):
    """Unfinished sequences, held by how many steps they have; all of one stage go on together."""

    memory_schema = "times ARRAY<BIGINT>"

    def __init__(self, *layout, contiguity: Sequence[str], within_us: int):
        super().__init__(*layout)
        self.contiguity, self.within_us = list(contiguity), within_us

    def _row(self, times: list[int], output: str) -> tuple:
        return (*times, *[None] * (len(self.contiguity) - len(times)), output)

    def _expire(self, stages: list[list], now: int, found: Rows) -> None:
        for stage in stages:
            live = 0
            while live < len(stage) and now - stage[live][0] >= self.within_us:
                found.append(self._row(stage[live], TIMEOUT))
                live += 1
            del stage[:live]

    def advance(self, memory, rows, mark):
        n, found = len(self.contiguity), []
        # stages[i]: sequences with i + 1 steps done, in order of their start
        stages = [[] for _ in range(n - 1)]
        for (times,) in memory:
            stages[len(times) - 1].append(list(times))
        for row in rows:
            at, fits = row[0], row[-n:]
            self._expire(stages, at, found)
            for i in range(n - 2, -1, -1):
                if fits[i + 1]:
                    further = [[*times, at] for times in stages[i]]
                    if i + 2 == n:
                        found.extend(self._row(times, MATCHED) for times in further)
                    else:
                        stages[i + 1].extend(further)
                    stages[i] = []
                elif self.contiguity[i + 1] == NEXT:
                    stages[i] = []
            if fits[0]:
                stages[0].append([at])
        self._expire(stages, mark - 1, found)
        open_ones = [times for stage in stages for times in stage]
        due = min((times[0] for times in open_ones), default=None)
        return found, [(times,) for times in open_ones], None if due is None else due + self.within_us


class DailyCap(StatefulProcessor):
    """First rows per key and day, numbered up to one past the limit."""

    def __init__(self, order: Sequence[str], columns: Sequence[str], limit: int):
        self.order, self.columns, self.limit = list(order), list(columns), limit

    def init(self, handle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "n BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        before = self.seen.get()[0] if self.seen.exists() else 0
        room, first = self.limit + 1 - before, None
        if room > 0:
            for chunk in rows:
                both = chunk if first is None else pd.concat([first, chunk])
                first = both.sort_values(self.order, kind="stable").head(room)
        if first is None or first.empty:
            return iter([])
        if not before:
            self.handle.registerTimer((int(key[-1]) + 1) * DAY_MS)
        self.seen.update((before + len(first),))
        numbered = first[self.columns].assign(n=range(before + 1, before + len(first) + 1))
        return iter([numbered])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        return iter([])


def _types(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [df.schema[c].dataType.simpleString() for c in names]


def _ddl(df: DataFrame, names: Sequence[str]) -> str:
    return ", ".join(f"`{c}` {kind}" for c, kind in zip(names, _types(df, names)))


def in_order(
    df: DataFrame, keys: list[str], ts: str, columns: list[str], make: Callable[..., InOrder], results: str
) -> DataFrame:
    """Hand the rows of each key, as tuples (time, columns..), to an ``InOrder`` rule.

    ``make`` gets the layout the rule passes on to ``InOrder.__init__``; ``results`` is the DDL of
    its result columns. This is the way to add further rules of one's own.
    """
    names = [f"in{i}" for i in range(len(columns))]
    values = [F.col(c).alias(name) for c, name in zip(columns, names)]
    timed = df.select(*keys, ts, F.unix_micros(ts).alias(TIME), *values)
    rule = make([TIME, *names], ["bigint", *_types(timed, names)])
    rule.fields = [*keys, *[column.split()[0] for column in results.split(", ")]]
    return timed.groupBy(*keys).transformWithState(rule, f"{_ddl(df, keys)}, {results}", "append", "EventTime")


def _at(name: str, alias: str):
    return F.timestamp_micros(name).alias(alias)


def day_numbers_stream(df, keys, ts, order_by, count) -> DataFrame:
    own = {k: f"key{i}" for i, k in enumerate(keys)}
    rest = [c for c in [*[c for c in order_by if c in df.columns], *df.columns] if c != ts and c not in keys]
    rest = list(dict.fromkeys(rest))
    named = df.select(*[F.col(k).alias(n) for k, n in own.items()], F.unix_date(utc_day(ts)).alias("day_number"), ts, *rest)
    types = [named.schema[c].dataType.simpleString() for c in rest]
    results = ", ".join(["row_us BIGINT", *[f"out{i} {kind}" for i, kind in enumerate(types)], "n BIGINT"])
    found = in_order(named, [*own.values(), "day_number"], ts, rest, DayNumbers, results)
    given = {**{k: F.col(n) for k, n in own.items()}, ts: F.timestamp_micros("row_us")}
    given |= {c: F.col(f"out{i}") for i, c in enumerate(rest)}
    columns = [given[c].alias(c) for c in df.columns]
    return found.select(*columns, F.date_from_unix_date("day_number").alias("day"), F.col("n").alias(count))


def fail_pairs_stream(df, keys, ts, gap_s, order_by) -> DataFrame:
    columns = [c for c in order_by if c != ts] + ["_fail"]
    make = lambda *layout: FailPairs(*layout, gap_us=gap_s * 1_000_000)
    pairs = in_order(df, keys, ts, columns, make, "first_us BIGINT, last_us BIGINT")
    return pairs.select(*keys, _at("first_us", "first_fail"), _at("last_us", "last_fail"))


def fail_runs_stream(df, keys, ts, span_s, min_fails, order_by) -> DataFrame:
    columns = [c for c in order_by if c != ts] + ["_fail"]
    make = lambda *layout: FailRuns(*layout, span_us=span_s * 1_000_000, min_fails=min_fails)
    runs = in_order(df, keys, ts, columns, make, "first_us BIGINT, last_us BIGINT")
    return runs.select(*keys, _at("first_us", "first_fail"), _at("last_us", "last_fail"))


def order_pay_stream(df, keys, ts, timeout_s, keep_s, order_by) -> DataFrame:
    columns = ["_pay", *[c for c in order_by if c != ts]]
    make = lambda *layout: OrderPay(*layout, timeout_us=timeout_s * 1_000_000, keep_us=keep_s * 1_000_000)
    found = in_order(df, keys, ts, columns, make, "create_us BIGINT, pay_us BIGINT, result STRING")
    return found.select(*keys, _at("create_us", "create_ts"), _at("pay_us", "pay_ts"), "result")


def match_sequence_stream(df, keys, ts, names, contiguity, within_s, tie) -> DataFrame:
    columns = [*tie, *[f"_is{i}" for i in range(len(names))]]
    make = lambda *layout: StepSequence(*layout, contiguity=contiguity, within_us=within_s * 1_000_000)
    times = ", ".join(f"t{i} BIGINT" for i in range(len(names)))
    found = in_order(df, keys, ts, columns, make, f"{times}, output STRING")
    return found.select(*keys, *[_at(f"t{i}", f"{name}_ts") for i, name in enumerate(names)], "output")


def daily_cap(df, keys, ts, limit, order_by) -> DataFrame:
    # Column names reach Python as field names, which excludes some; numbered names are safe.
    inner = {c: f"in{i}" for i, c in enumerate(df.columns)}
    named = df.select(*[F.col(c).alias(i) for c, i in inner.items()], F.unix_date(F.to_date(ts)).alias("day"))
    columns = list(inner.values())
    processor = DailyCap([inner[c] for c in order_by], columns, limit)
    schema = f"{_ddl(named, columns)}, n BIGINT"
    numbered = named.groupBy(*[inner[k] for k in keys], "day").transformWithStateInPandas(
        processor, schema, "append", "EventTime", eventTimeColumnName=inner[ts]
    )
    return numbered.select(*[F.col(i).alias(c) for c, i in inner.items()], F.col("n").alias("_n"))
