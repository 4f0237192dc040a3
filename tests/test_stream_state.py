"""Keyed sliding counts, numbered days and corrected rankings: a stream in disorder gives what the batch gives."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F
from streams import as_stream, before_end, drain, drain_into, lines

from tidemark.operators import running_count_per_day, top_n, windowed_count
from tidemark.plans import jobs
from tidemark.plans.catalog import QUERIES
from tidemark.streaming import CompactedLog, corrected_top_n, sliding_counts, write_corrected_top_n

T0 = 1_700_000_000
DISORDER = {"delay": "5 minutes", "swap": 3}


@pytest.fixture(scope="module")
def events(spark):
    """120 events in two clumps with hours in between, some at the same time."""
    n = F.col("id")
    gap = F.when(n < 60, 0).otherwise(9 * 3600)
    kinds = F.array(*[F.lit(k) for k in ("CLICK", "INSTALL", "UNINSTALL", None)])
    rows = spark.range(120).select(
        n.alias("event_id"),
        F.timestamp_micros((F.lit(T0) + F.floor(n / 2) * 47 + gap) * 1_000_000 + (n % 2) * 250_000).alias("ts"),
        F.pmod(F.xxhash64(n), F.lit(3)).alias("user_id"),
        F.lit(7).cast("bigint").alias("ad_id"),
        F.concat(F.lit("p"), F.pmod(F.xxhash64(n + 9), F.lit(2)).cast("string")).alias("province"),
        F.when(n % 17 != 0, F.concat(F.lit("c"), (n % 2).cast("string"))).alias("channel"),
        F.element_at(kinds, (F.pmod(F.xxhash64(n + 99), F.lit(4)) + 1).cast("int")).alias("behavior"),
    )
    return spark.createDataFrame(rows.collect(), rows.schema)


@pytest.fixture(autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.mark.parametrize("size, slide", [("10 minutes", "20 seconds"), ("25 seconds", "10 seconds"), ("1 hour", "25 minutes")])
def test_sliding_counts_in_keyed_state(events, size, slide):
    counted = sliding_counts(as_stream(events, **DISORDER), ["channel"], "ts", size, slide)
    expected = windowed_count(events, ["channel"], "ts", size, slide)
    assert lines(before_end(drain(counted), "window_end")) == lines(expected)


def test_default_jobs_of_streams(events):
    counted = jobs.channel_counts(as_stream(events, **DISORDER))
    assert "Expand" not in (plan := counted._jdf.queryExecution().analyzed().toString()) and "Generate" not in plan
    assert lines(before_end(drain(counted), "window_end")) == lines(jobs.channel_counts(events))
    clicks, _ = jobs.ad_clicks_by_province(as_stream(events, delay="5 minutes", user_id=0, ad_id=7), limit=15)
    assert "Generate" not in clicks._jdf.queryExecution().analyzed().toString()
    expected, _ = jobs.ad_clicks_by_province(events, limit=15)
    assert lines(before_end(drain(clicks), "window_end")) == lines(expected)


def test_numbers_of_a_day(events):
    number = lambda df: running_count_per_day(df, "user_id", "ts", ["event_id"], "n")
    ordered = lambda df: running_count_per_day(df, "user_id", "ts", ["ts", "event_id"], "n")
    given = before_end(drain(number(as_stream(events, **DISORDER))), "ts")
    assert given.columns == ordered(events).columns
    assert lines(given) == lines(ordered(events)) and given.select("day").distinct().count() == 2


def test_late_rows_correct_a_ranking(spark, events):
    out, state = tempfile.mkdtemp(prefix="tidemark-out-"), tempfile.mkdtemp(prefix="tidemark-state-")
    log, batches = CompactedLog(out, every=3), []
    counts = lambda df: windowed_count(df, ["user_id"], "ts", "30 minutes", "10 minutes")

    def sink(changes, batch_id):
        log.append(changes, batch_id)
        log.append(changes, batch_id)  # as after a failure
        batches.append(changes.collect())
        assert len(log.tables(spark)) <= 3

    step = corrected_top_n(sink, state, "count", "user_id", 2)
    late = F.when(F.col("event_id") % 10 == 3, F.col("event_id") + 35).otherwise(F.col("event_id"))
    arrival = events.withColumn("arrives", F.timestamp_seconds(late)).orderBy("arrives")
    folder = tempfile.mkdtemp(prefix="tidemark-stream-")
    for i in range(8):  # rows that come three to four files after their neighbours in time
        arrival.where((F.unix_seconds("arrives") >= i * 20) & (F.unix_seconds("arrives") < (i + 1) * 20)).coalesce(1).write.parquet(f"{folder}/{i}")
    stream = spark.readStream.schema(arrival.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(folder)
    drain_into(counts(stream.withWatermark("ts", "2 days")), step, "update")
    taken_back = [r for rows in batches for r in rows if r["change"] == -1]
    assert taken_back and len(batches) > 6
    final = log.read(spark)
    assert [r["change"] for r in final.select("change").distinct().collect()] == [1]
    assert lines(final.drop("change")) == lines(top_n(counts(events), "window_end", "count", "user_id", 2))
    total = {}
    for rows in batches:
        for r in rows:
            key = tuple(r)[:-1]
            total[key] = total.get(key, 0) + r["change"]
            assert total[key] in (0, 1)
    assert len({k for k, n in total.items() if n}) == final.count()
    assert sum(name.startswith("base-") for name in os.listdir(out)) == 1


def _in_files(df, parts, delay):
    """A stream whose files hold the rows of ``parts``, one micro-batch each."""
    folder = tempfile.mkdtemp(prefix="tidemark-stream-")
    for i, part in enumerate(parts):
        df.where(part).coalesce(1).write.parquet(f"{folder}/{i}")
        for name in os.listdir(f"{folder}/{i}"):
            os.utime(f"{folder}/{i}/{name}", (1_700_000_000 + i, 1_700_000_000 + i))
    stream = df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", 1)
    return stream.option("recursiveFileLookup", "true").parquet(folder).withWatermark("ts", delay)


def test_corrected_hot_items_hold_no_row_per_item_and_window(spark, events):
    """What a view leaves behind is one row per item and pane, not one in each of twelve windows."""
    views = events.withColumn("item_id", F.col("user_id") * 1000 + F.col("event_id") % 7).withColumn("behavior", F.lit("pv"))
    out, state = tempfile.mkdtemp(prefix="tidemark-out-"), tempfile.mkdtemp(prefix="tidemark-state-")
    log, held = CompactedLog(out, every=2), []
    stream = _in_files(views, [F.col("event_id") % 5 == i for i in range(5)], "20 days")
    query = jobs.write_corrected_hot_items(stream, log.append, state).trigger(availableNow=True).start()
    query.awaitTermination()
    for progress in query.recentProgress:
        held.append(sum(s["numRowsTotal"] for s in progress["stateOperators"]))
    panes = views.select("item_id", F.window("ts", "5 minutes")).distinct().count()
    assert len(held) >= 5 and max(held) <= panes
    kept = CompactedLog(f"{state}/panes").read(spark)
    assert kept.count() == panes and kept.agg(F.sum("change")).first()[0] == views.count()
    assert lines(log.read(spark).drop("change")) == lines(jobs.hot_items(views))


@pytest.mark.parametrize("size, slide", [("25 minutes", "10 minutes"), ("20 minutes", "20 minutes")])
def test_corrected_rankings_from_panes_are_those_of_windows(spark, events, size, slide):
    """The same changes, micro-batch by micro-batch, as from the counts per window, late and too late rows included."""
    hours = [F.col("event_id").between(i * 12, i * 12 + 11) for i in range(10)]
    early = lambda i: (F.col("event_id") % 7 == i) & (F.col("event_id") < 50)
    stays = ~((F.col("event_id") % 7).isin(1, 2, 3) & (F.col("event_id") < 50))
    parts = [p & stays for p in hours[:5]] + [hours[5] | early(1), hours[6] | early(2), hours[7], hours[8] | early(3), hours[9]]
    found = []
    for write in (
        lambda stream, sink, state: write_corrected_top_n(stream, sink, state, "user_id", "ts", size, slide, 2),
        lambda stream, sink, state: windowed_count(stream, ["user_id"], "ts", size, slide).writeStream.outputMode("update").foreachBatch(
            corrected_top_n(sink, state, "count", "user_id", 2)
        ),
    ):
        given = {}

        def sink(changes, batch_id):
            given[batch_id] = lines(changes)

        state = tempfile.mkdtemp(prefix="tidemark-state-")
        write(_in_files(events, parts, "15 minutes"), sink, state).trigger(availableNow=True).start().awaitTermination()
        found.append({k: v for k, v in given.items() if v})
    assert found[0] == found[1] and len(found[0]) >= 8
    total = {}
    for row in (r for rows in found[0].values() for r in rows):
        total[row[1:]] = total.get(row[1:], 0) + int(row[0])
    assert set(total.values()) <= {0, 1}
    # Rows that come after their windows have closed are left out.
    whole = top_n(windowed_count(events, ["user_id"], "ts", size, slide), "window_end", "count", "user_id", 2)
    assert {k for k, n in total.items() if n} != {tuple(r) for r in lines(whole)}


def test_views_that_come_decades_late_count(spark):
    """Every file of the query's stream holds views of 1995 and of 2024."""
    folder = tempfile.mkdtemp(prefix="tidemark-in-")
    n = F.col("id")
    at = F.when(n % 2 == 0, T0).otherwise(T0 - 29 * 365 * 86400) + n * 60
    rows = spark.range(60).select(
        n.alias("event_id"), F.timestamp_seconds(at).alias("ts"), n.alias("user_id"), F.lit("view").alias("event_type"),
        F.lit(1.0).alias("value"), F.format_string('{"k": %d}', n % 4).alias("props"),
    )
    rows.write.parquet(f"{folder}/events.parquet")
    assert lines(QUERIES["corrected_hot_items"](spark, folder)) == lines(QUERIES["hot_items"](spark, folder))


def test_a_repeated_micro_batch_gives_the_same_changes(spark, events):
    """Also where its panes have been folded before the failure."""
    state = tempfile.mkdtemp(prefix="tidemark-state-")
    steps, given = [], []

    class Writer:
        foreachBatch = steps.append

        def outputMode(self, mode):
            return self

    class Rows:
        schema = events.schema
        select = lambda self, *columns: self
        writeStream = Writer()

    write_corrected_top_n(Rows(), lambda changes, i: given.append(lines(changes)), state, "user_id", "ts", "30 minutes", "10 minutes", 2, every=2)
    for i in range(3):
        batch = events.where(F.col("event_id") % 3 == i)
        steps[0](batch, i)
        if i < 2:
            steps[0](batch, i)
    assert given[0] == given[1] and given[2] == given[3] and given[2] and given[4]
    assert sorted(os.listdir(f"{state}/panes")) == ["base-1", "part-2"]


class Held:
    """State of one key in memory, counting the rows that are read from it."""

    def __init__(self):
        self.entries, self.read = {}, 0

    def exists(self):
        return bool(self.entries)

    def get(self):
        found = self.entries[None]
        return iter(found) if isinstance(found, list) else found

    def put(self, rows):
        self.entries[None] = list(rows)

    def update(self, value):
        self.entries[None] = value

    def clear(self):
        self.entries.clear()

    def updateValue(self, key, value):
        self.entries[key] = value

    def getValue(self, key):
        self.read += len(self.entries[key][0])
        return self.entries[key]

    def removeKey(self, key):
        del self.entries[key]


def test_waiting_rows_are_read_about_once():
    from tidemark.streaming.processors import FailPairs

    class Handle:
        timers = set()
        getListState = getMapState = getValueState = lambda self, *args: Held()

        def registerTimer(self, at):
            self.timers.add(at)

        def deleteTimer(self, at):
            self.timers.discard(at)

    class Mark:
        def __init__(self, at):
            self.getCurrentWatermarkInMs = self.getExpiryTimeInMs = lambda: at

    rule, handle, n = FailPairs(["at_us", "failed"], ["bigint", "boolean"], gap_us=2_000_000), Handle(), 4000
    rule.fields = ["key", "first", "last"]
    rule.init(handle)
    rows = [{"at_us": i * 250_000, "failed": i % 3 > 0} for i in range(n)]
    for begin in range(0, n, 1000):
        list(rule.handleInputRows((1,), reversed(rows[begin : begin + 1000]), None))
    found = []
    while handle.timers:
        at = min(handle.timers)
        handle.timers.remove(at)
        at += 700
        rule.wake.update((at,))
        found += rule.handleExpiredTimer((1,), Mark(at), Mark(at))
    assert [(r["first"], r["last"]) for r in found] == [((i - 1) * 250_000, i * 250_000) for i in range(2, n, 3)]
    assert rule.waiting.read < 3 * n and not rule.waiting.entries
