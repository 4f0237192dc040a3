"""Micro-batch sinks: final rankings, rankings under way, and counts that are corrected later."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import ITEM_REPORT, ReportFormat
from ..operators.ordered import with_running_number
from ..operators.outputs import Sink
from ..operators.ranking import latest_per_key, top_n


def ranked_sink(
    sink: Sink,
    metric: str,
    tie_break: str | Sequence[str],
    n: int,
    report: bool = False,
    fmt: ReportFormat = ITEM_REPORT,
    partition: str = "window_end",
) -> Sink:
    """For windowed counts in append mode: all counts of a window come in the micro-batch that
    closes it, so ranking the micro-batch ranks the window. Use with ``foreachBatch``."""

    def rank(batch: DataFrame, batch_id: int) -> None:
        sink(top_n(batch, partition, metric, tie_break, n, report, fmt), batch_id)

    return rank


def upsert_log(path: str) -> Sink:
    """For windowed counts in update mode: keep every emission, numbered by its micro-batch."""

    def append(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn("version", F.lit(batch_id).cast("bigint"))
        numbered.write.mode("overwrite").parquet(f"{path}/part={batch_id}")

    return append


def read_latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest emission per key out of an upsert log."""
    return latest_per_key(spark.read.parquet(path).drop("part"), keys, "version").drop("version")


def running_top_n(
    sink: Sink,
    state_path: str,
    metric: str,
    tie_break: str,
    n: int,
    partition: str = "window_end",
) -> Callable[[DataFrame, int], None]:
    """For windowed counts in update mode: after every micro-batch, the current top n of each
    window that changed.

    Counts only grow, so an item outside the top n can enter it only by an update of its own. It
    is therefore enough to keep the n rows per open window, as one small table per micro-batch in
    the shared folder ``state_path``; a repeated micro-batch starts from the same table. A window
    is kept until the query's own watermark has passed its end, after which Spark lets no row in.
    Ties keep the smaller ``tie_break``.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.select(partition, tie_break, metric, F.lit(True).alias("_new"))
        before = _state_before(spark, state_path, batch_id)
        if before is not None:
            rows = rows.unionByName(before.withColumn("_new", F.lit(False)))
        merged = rows.groupBy(partition, tie_break).agg(
            F.max(metric).alias(metric), F.bool_or("_new").alias("_new")
        )
        ranked = top_n(merged.withColumn("_entry", F.struct(tie_break, "_new")), partition, metric, "_entry", n)
        current = ranked.select(partition, F.col("_entry.*"), metric, "rank")
        changed = F.bool_or("_new").over(Window.partitionBy(partition))
        stored = _store(current.withColumn("_changed", changed).drop("_new"), f"{state_path}/rows={batch_id}")
        kept = _open_windows(stored, partition).select(partition, tie_break, metric)
        _store(kept, f"{state_path}/state={batch_id}")
        sink(stored.filter("_changed").drop("_changed"), batch_id)
        _forget(spark, state_path, batch_id)

    return step


def running_unique_sink(sink: Sink, state_path: str) -> Callable[[DataFrame, int], None]:
    """For ``first_sights``: number the distinct ids of every window as they come, 1, 2, 3, ..

    The count reached per open window is kept between micro-batches as for ``running_top_n``.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = _store(batch, f"{state_path}/rows={batch_id}")
        order = ["first_seen", "id"]
        numbered = with_running_number(rows, ["window_end"], order, "first_seen", "_n", 60)
        counts = rows.groupBy("window_end").agg(F.count(F.lit(1)).alias("count"))
        before = _state_before(spark, state_path, batch_id)
        if before is None:
            numbered = numbered.withColumnRenamed("_n", "count")
        else:
            total = F.col("_n") + F.coalesce("count", F.lit(0))
            numbered = numbered.join(before, "window_end", "left").withColumn("count", total).drop("_n")
            counts = counts.unionByName(before).groupBy("window_end").agg(F.sum("count").alias("count"))
        _store(_open_windows(counts, "window_end"), f"{state_path}/state={batch_id}")
        sink(numbered.select("window_end", "id", "first_seen", "count"), batch_id)
        _forget(spark, state_path, batch_id)

    return step


def _store(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _state_before(spark: SparkSession, state_path: str, batch_id: int) -> DataFrame | None:
    return spark.read.parquet(f"{state_path}/state={batch_id - 1}") if batch_id else None


def _open_windows(df: DataFrame, window_end: str) -> DataFrame:
    """Rows of windows that the running query's watermark has not passed; all of them if it is not known.

    The watermark is that of the last finished micro-batch, which is never ahead of the current one.
    """
    spark = df.sparkSession
    query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    query = spark.streams.get(query_id) if query_id else None
    progress = query.lastProgress if query is not None else None
    watermark = (progress["eventTime"] or {}).get("watermark") if progress else None
    return df if watermark is None else df.filter(F.col(window_end) > F.lit(watermark).cast("timestamp"))


def _forget(spark: SparkSession, state_path: str, batch_id: int, kinds: Sequence[str] = ("rows", "state")) -> None:
    """Empty the tables two micro-batches back; the one before is needed if this one is repeated."""
    for kind in kinds:
        if batch_id >= 2:
            old = f"{state_path}/{kind}={batch_id - 2}"
            schema = spark.read.parquet(f"{state_path}/{kind}={batch_id}").schema
            spark.createDataFrame([], schema).write.mode("overwrite").parquet(old)
