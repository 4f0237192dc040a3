"""A stream gives the rows of the batch table, over several micro-batches, with some disorder."""

from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import functions as F
from streams import as_stream, before_end, drain, drain_into, lines

from tidemark.operators import (
    Step,
    cap_per_key_per_day,
    connected,
    fail_pairs,
    fail_runs,
    first_sights,
    interval_join,
    match_sequence,
    order_pay_status,
    parquet_sink,
    reconcile,
    top_n,
    unique_count,
    window_join,
    windowed_agg,
    windowed_avg,
    windowed_count,
    write_outputs,
)
from tidemark.plans import jobs
from tidemark.streaming import ranked_sink, read_latest, running_top_n, running_unique_sink, upsert_log
from tidemark.streaming.processors import InOrder, in_order

T0 = 1_700_000_000


@pytest.fixture(scope="module")
def events(spark):
    """300 events of 6 users over about two and a half hours, on whole and half seconds."""
    n = F.col("id")
    mixed = lambda salt, size: F.pmod(F.xxhash64(n + salt), F.lit(size))
    kinds = F.array(*[F.lit(k) for k in ("click", "view", "error", "error", "purchase", "view", "signup")])
    rows = spark.range(300).select(
        n.alias("event_id"),
        F.timestamp_micros((F.lit(T0) + n * 30) * 1_000_000 + (n % 2) * 500_000).alias("ts"),
        mixed(0, 6).alias("user_id"),
        mixed(1000, 9).alias("item_id"),
        F.element_at(kinds, (mixed(5000, 7) + 1).cast("int")).alias("kind"),
        (n % 11).cast("double").alias("value"),
    )
    return spark.createDataFrame(rows.collect(), rows.schema)


@pytest.fixture(autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


DISORDER = {"delay": "5 minutes", "swap": 3}


def test_sliding_counts(events):
    for size, slide in (("1 hour", "5 minutes"), ("10 minutes", "20 seconds")):
        count = lambda df: windowed_count(df, ["item_id"], "ts", size, slide)
        stream = before_end(drain(count(as_stream(events, **DISORDER))), "window_end")
        assert lines(stream) == lines(count(events))


def test_closed_sliding_counts_from_panes(events):
    for size, slide in (("1 hour", "5 minutes"), ("10 minutes", "5 seconds"), ("1 hour", "20 seconds")):
        stream = windowed_count(as_stream(events, **DISORDER), ["item_id"], "ts", size, slide, closed_only=True)
        plan = stream._jdf.queryExecution().analyzed().toString()
        assert plan.count("Aggregate") == 2
        given = before_end(drain(stream), "window_end")
        assert lines(given) == lines(windowed_count(events, ["item_id"], "ts", size, slide))


def test_average(events):
    average = lambda df: windowed_avg(df, "value", ["kind"], "ts", "1 hour", "15 minutes")
    stream = before_end(drain(average(as_stream(events, **DISORDER))), "window_end")
    assert lines(stream) == lines(average(events))


@pytest.mark.parametrize("method", ["exact", "bitmap", "approx"])
def test_unique_visitors(events, method):
    count = lambda df: unique_count(df, "user_id", "ts", "30 minutes", method)
    stream = before_end(drain(count(as_stream(events, **DISORDER))), "window_end")
    assert lines(stream) == lines(count(events))


def test_ranking_of_closed_windows(events):
    folder = tempfile.mkdtemp(prefix="tidemark-out-")
    counts = lambda df: windowed_count(df, ["item_id"], "ts", "1 hour", "10 minutes")
    sink = ranked_sink(parquet_sink(folder), "count", "item_id", 3)
    drain_into(counts(as_stream(events, **DISORDER)), sink, "append")
    result = events.sparkSession.read.parquet(folder).drop("batch_id")
    expected = top_n(counts(events), "window_end", "count", "item_id", 3)
    assert lines(before_end(result, "window_end")) == lines(expected)


def test_late_rows_correct_counts_already_given(events):
    folder = tempfile.mkdtemp(prefix="tidemark-out-")
    counts = lambda df: windowed_count(df, ["item_id"], "ts", "20 minutes").drop("window_start")
    drain_into(counts(as_stream(events, **DISORDER)), upsert_log(folder), "update")
    latest = read_latest(events.sparkSession, folder, ["item_id", "window_end"])
    assert lines(before_end(latest, "window_end")) == lines(counts(events))


def test_running_top_n_ends_at_the_final_ranking(events):
    out, state = tempfile.mkdtemp(prefix="tidemark-out-"), tempfile.mkdtemp(prefix="tidemark-state-")
    counts = lambda df: windowed_count(df, ["item_id"], "ts", "1 hour", "10 minutes")
    step = running_top_n(parquet_sink(out), state, "count", "item_id", 3)
    drain_into(counts(as_stream(events, **DISORDER)), step, "update")
    given = events.sparkSession.read.parquet(out)
    newest = given.groupBy("window_end").agg(F.max("batch_id").alias("batch_id"))
    final = given.join(newest, ["window_end", "batch_id"]).drop("batch_id")
    expected = top_n(counts(events), "window_end", "count", "item_id", 3)
    assert lines(before_end(final, "window_end")) == lines(expected)
    assert given.count() > final.count()


def test_hot_items_and_urls_of_a_stream(events):
    for write, batch, rows in (
        (jobs.write_hot_items, jobs.hot_items, events.withColumn("behavior", F.lit("pv"))),
        (jobs.write_hot_urls, jobs.hot_urls, events.select("ts", F.lit("GET").alias("method"), F.format_string("/i/%d", "item_id").alias("url"))),
    ):
        out = tempfile.mkdtemp(prefix="tidemark-out-")
        always = {c: v for c, v in (("behavior", "pv"), ("method", "GET"), ("url", "/i/0")) if c in rows.columns}
        stream = as_stream(rows, **DISORDER, **always)
        write(stream, parquet_sink(out), slide="5 minutes").trigger(availableNow=True).start().awaitTermination()
        given = before_end(events.sparkSession.read.parquet(out).drop("batch_id"), "window_end")
        assert lines(given) == lines(batch(rows, slide="5 minutes"))


def _minutes(spark, rows, columns):
    """Rows with their time in minutes; one file, and so one micro-batch, per list."""
    for batch in rows:
        df = spark.createDataFrame(batch, columns)
        yield df.withColumn("ts", F.timestamp_seconds(F.lit(T0 // 3600 * 3600) + F.col("minute") * 60)).drop("minute")


def _run(spark, parts, job, step, mode):
    folder, checkpoint = tempfile.mkdtemp(prefix="tidemark-in-"), tempfile.mkdtemp(prefix="tidemark-cp-")
    parts = list(parts)
    for number, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(parts[0].schema).parquet(folder).withWatermark("ts", "3 hours")
        writer = job(stream).writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(step)
        writer.trigger(availableNow=True).start().awaitTermination()


def test_late_rows_meet_the_ranking_of_their_window(spark):
    """A row far ahead must not make a window forget its ranks while the watermark lets rows in."""
    out, state = tempfile.mkdtemp(prefix="tidemark-out-"), tempfile.mkdtemp(prefix="tidemark-state-")
    batches = [[(5, 1)] * 5 + [(6, 2)] * 4, [(130, 9)], [(7, 3), (8, 2), (9, 2)]]
    job = lambda df: windowed_count(df, ["item_id"], "ts", "1 hour")
    step = running_top_n(parquet_sink(out), state, "count", "item_id", 2)
    _run(spark, _minutes(spark, batches, "minute INT, item_id BIGINT"), job, step, "update")
    first = F.timestamp_seconds(F.lit(T0 // 3600 * 3600 + 3600))
    given = spark.read.parquet(out).filter(F.col("window_end") == first)
    newest = given.agg(F.max("batch_id")).first()[0]
    assert newest >= 2
    last = given.filter(F.col("batch_id") == newest)
    assert [(r["rank"], r["item_id"], r["count"]) for r in last.orderBy("rank").collect()] == [(1, 2, 6), (2, 1, 5)]


def test_late_ids_go_on_with_the_numbers_of_their_window(spark):
    out, state = tempfile.mkdtemp(prefix="tidemark-out-"), tempfile.mkdtemp(prefix="tidemark-state-")
    batches = [[(5, 1), (6, 2), (7, 1)], [(130, 9)], [(8, 3), (9, 2)]]
    job = lambda df: first_sights(df, "user_id", "ts", "1 hour", "exact")
    _run(spark, _minutes(spark, batches, "minute INT, user_id BIGINT"), job, running_unique_sink(parquet_sink(out), state), "append")
    first = F.timestamp_seconds(F.lit(T0 // 3600 * 3600 + 3600))
    given = spark.read.parquet(out).filter(F.col("window_end") == first)
    assert sorted((r["count"], r["id"]) for r in given.collect()) == [(1, 1), (2, 2), (3, 3)]


def test_daily_cap_and_its_counts(events):
    rows = events.select("event_id", "ts", "user_id")
    cap = lambda df: cap_per_key_per_day(df, "user_id", "ts", 20, ["ts", "event_id"])
    passed, warnings = cap(rows)
    stream_passed = before_end(drain(cap(as_stream(rows))[0]), "ts")
    stream_warnings = before_end(drain(cap(as_stream(rows))[1]), "at")
    assert lines(stream_passed) == lines(passed)
    assert lines(stream_warnings) == lines(warnings)
    assert warnings.count() > 0


def test_counts_after_daily_cap(events):
    rows = events.select("event_id", "ts", "user_id")
    job = lambda df: windowed_count(
        cap_per_key_per_day(df, "user_id", "ts", 20, ["ts", "event_id"])[0], ["user_id"], "ts", "1 hour", "10 minutes"
    )
    assert lines(before_end(drain(job(as_stream(rows))), "window_end")) == lines(job(rows))


def test_fail_pairs(events):
    pairs = lambda df: fail_pairs(df, "user_id", "kind", "ts", "10 minutes", ["ts", "event_id"], fail="error")
    assert lines(drain(pairs(as_stream(events, **DISORDER)))) == lines(pairs(events))
    assert pairs(events).count() > 0


def test_fail_runs(events):
    runs = lambda df: fail_runs(df, "user_id", "kind", "ts", "20 minutes", 2, ["ts", "event_id"], fail="error")
    assert lines(drain(runs(as_stream(events, **DISORDER)))) == lines(runs(events))
    assert runs(events).count() > 0


def test_order_pay_status(events):
    status = lambda df: order_pay_status(
        df, "user_id", "kind", "ts", "15 minutes", ["event_id"], "click", "purchase"
    )
    stream = as_stream(events, kind="click", **DISORDER)
    assert lines(drain(status(stream))) == lines(status(events))
    assert len({r["result"] for r in status(events).select("result").distinct().collect()}) == 4


@pytest.mark.parametrize("second", ["next", "followed_by"])
@pytest.mark.parametrize("third", ["next", "followed_by"])
def test_sequences(events, second, third):
    is_kind = lambda k: F.col("kind") == k
    steps = [Step("a", is_kind("view")), Step("b", is_kind("error"), second), Step("c", is_kind("click"), third)]
    match = lambda df: match_sequence(df, "user_id", "ts", steps, "25 minutes", ["event_id"])
    stream = as_stream(events, kind="view", **DISORDER)
    assert lines(drain(match(stream))) == lines(match(events))


@pytest.fixture(scope="module")
def sides(events):
    pays = events.filter("event_id % 3 <> 0").select(F.col("item_id").alias("tx"), F.col("ts").alias("pay_ts"))
    receipts = events.filter("event_id % 2 = 0").select(
        F.col("item_id").alias("tx"), F.expr("ts + INTERVAL '20' SECOND").alias("receipt_ts"), "event_id"
    )
    return pays, receipts


def test_joins(sides):
    pays, receipts = sides
    jobs = [
        lambda a, b: interval_join(a, b, "tx", "pay_ts", "receipt_ts", -60, 100),
        lambda a, b: window_join(a, b, "tx", "pay_ts", "receipt_ts", "2 minutes"),
        lambda a, b: reconcile(a, b, "tx", "pay_ts", "receipt_ts", -60, 100),
    ]
    for job in jobs:
        streamed = drain(job(as_stream(pays, ts="pay_ts"), as_stream(receipts, ts="receipt_ts")))
        ended = F.coalesce(*[F.col(c) for c in ("pay_ts", "receipt_ts")]) < F.lit("2099-01-01").cast("timestamp")
        assert lines(streamed.filter(ended)) == lines(job(pays, receipts))
        assert job(pays, receipts).count() > 0


def test_outputs_by_tag(sides):
    pays, receipts = sides
    out = tempfile.mkdtemp(prefix="tidemark-out-")
    tags = ("matched", "unmatched_pay", "unmatched_receipt")
    job = lambda a, b: reconcile(a, b, "tx", "pay_ts", "receipt_ts", -60, 100)
    stream = job(as_stream(pays, ts="pay_ts"), as_stream(receipts, ts="receipt_ts"))
    sinks = {tag: parquet_sink(f"{out}/{tag}") for tag in tags}
    writer = write_outputs(stream, sinks, f"{out}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    batch = job(pays, receipts)
    for tag in tags:
        ended = F.coalesce("pay_ts", "receipt_ts") < F.lit("2099-01-01").cast("timestamp")
        written = pays.sparkSession.read.parquet(f"{out}/{tag}").drop("batch_id").filter(ended)
        assert lines(written) == lines(batch.filter(F.col("output") == tag).drop("output"))


def test_any_aggregate(events):
    profile = lambda df: windowed_agg(df, ["kind"], "ts", "1 hour", top=F.max("value"), low=F.min("item_id"))
    stream = before_end(drain(profile(as_stream(events, **DISORDER))), "window_end")
    assert lines(stream) == lines(profile(events))


def test_distinct_ids_are_numbered_as_they_come(events):
    out, state = tempfile.mkdtemp(prefix="tidemark-out-"), tempfile.mkdtemp(prefix="tidemark-state-")
    sights = first_sights(as_stream(events, **DISORDER), "user_id", "ts", "30 minutes", "exact")
    drain_into(sights, running_unique_sink(parquet_sink(out), state), "append")
    given = before_end(events.sparkSession.read.parquet(out), "window_end")
    windows = given.groupBy("window_end").agg(
        F.max("count").alias("count"), F.count_distinct("count").alias("steps"), F.count_distinct("id").alias("ids")
    )
    assert windows.filter("count <> steps or count <> ids").isEmpty()
    expected = unique_count(events, "user_id", "ts", "30 minutes").select("window_end", "count")
    assert lines(windows.select("window_end", "count")) == lines(expected)


def test_a_rule_of_ones_own_over_two_inputs(sides):
    class LastReceipt(InOrder):
        """For every pay, the receipt of the same key seen last before it."""

        memory_schema = "receipt BIGINT"

        def advance(self, memory, rows, mark):
            found, receipt = [], memory[0][0] if memory else None
            for at, side, event_id in rows:
                if side == "right":
                    receipt = event_id
                else:
                    found.append((at, receipt))
            return found, [] if receipt is None else [(receipt,)], None

    pays, receipts = (df.withColumnRenamed(c, "ts") for df, c in zip(sides, ("pay_ts", "receipt_ts")))
    both = lambda a, b: connected(a, b).select("tx", "ts", "side", "event_id")
    stream = in_order(
        both(as_stream(pays), as_stream(receipts)),
        ["tx"],
        "ts",
        ["side", "event_id"],
        LastReceipt,
        "pay_us BIGINT, receipt BIGINT",
    )
    expected, last = [], {}
    for r in sorted(both(pays, receipts).collect(), key=lambda r: (r.ts, r.side)):
        if r.side == "right":
            last[r.tx] = r.event_id
        else:
            expected.append((r.tx, last.get(r.tx)))
    got = [(r.tx, r.receipt) for r in drain(stream).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
