"""Rankings that late rows correct: a log of what leaves and enters every window's top n, and its compaction."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.time import aligned, seconds, start_range
from ..operators.outputs import Sink
from ..operators.ranking import top_n
from ..operators.windows import WATERMARK_METADATA, _by_changes, _cells, _placed
from .sinks import _forget, _open_windows, _state_before, _store

#: -1: the row no longer holds, 1: it holds from now on.
CHANGE = "change"


def corrected_top_n(
    sink: Sink, state_path: str, metric: str, tie_break: str, n: int, partition: str = "window_end"
) -> Callable[[DataFrame, int], None]:
    """For windowed counts in update mode: every micro-batch gives the changes of the rankings, late corrections included.

    A row (window, rank, entry, metric) that was given out before and does not hold any more comes with ``change`` -1,
    a new one with 1, so that the sum of all changes is the ranking. What a micro-batch leaves as it was gives no rows.
    As counts only grow, the ``n`` rows of an open window are all that has to be kept (see ``running_top_n``); a window
    that the watermark has passed is final and forgotten. A repeated micro-batch gives the same changes again.
    """
    columns = [partition, tie_break, metric, "rank"]

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _state_before(spark, state_path, batch_id)
        rows = batch.select(partition, tie_break, metric)
        if before is None:
            current = _store(top_n(rows, partition, metric, tie_break, n).select(columns), f"{state_path}/rows={batch_id}")
            changes = current.withColumn(CHANGE, F.lit(1))
        else:
            before = before.select(columns)
            newest = rows.unionByName(before.drop("rank")).groupBy(partition, tie_break).agg(F.max(metric).alias(metric))
            current = _store(top_n(newest, partition, metric, tie_break, n).select(columns), f"{state_path}/rows={batch_id}")
            both = before.withColumn(CHANGE, F.lit(-1)).union(current.withColumn(CHANGE, F.lit(1)))
            changes = both.groupBy(columns).agg(F.sum(CHANGE).cast("int").alias(CHANGE)).where(f"{CHANGE} <> 0")
        _store(_open_windows(current, partition), f"{state_path}/state={batch_id}")
        sink(changes, batch_id)
        _forget(spark, state_path, batch_id)

    return step


def write_corrected_top_n(
    rows: DataFrame,
    sink: Sink,
    state_path: str,
    entry: str,
    ts: str,
    size: int | str,
    slide: int | str,
    n: int,
    metric: str = "count",
    partition: str = "window_end",
    every: int = 16,
) -> DataStreamWriter:
    """``corrected_top_n`` over the sliding counts of a stream's rows, without a row per row and window in any state.

    What is kept are the counts per entry and pane, as a ``CompactedLog`` in ``state_path``, folded after ``every``. A micro-batch is reduced to
    panes first, and only panes near its own are read back; the windows of these are counted with and without the new
    panes, and the two rankings give the changes. Windows that the new panes do not reach have two equal rankings, even
    where their own panes are not all there. As in Spark's own windows, a row counts in those of its windows that the
    watermark of the micro-batch before has not passed, and a window that it has passed is final; panes that are only
    in such windows are forgotten when the log is folded.
    """
    size_s, slide_s = seconds(size), seconds(slide)
    reach_s = slide_s * -(-size_s // slide_s)
    delay_ms = (rows.schema[ts].metadata or {}).get(WATERMARK_METADATA)
    log = CompactedLog(f"{state_path}/panes", every)
    pane = F.col("_pane")

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _state_before(spark, state_path, batch_id)
        # The latest time in the micro-batches up to the last one, and up to the one before it.
        seen, earlier = (None, None) if before is None else before.first()
        mark = None if delay_ms is None or earlier is None else earlier // 1000 - delay_ms
        is_open = lambda end_s: F.lit(True) if mark is None else end_s * 1000 > mark
        held = is_open(start_range(pane, size_s, slide_s)[1] + size_s)

        parts = {CHANGE: F.count(F.lit(1)), "_latest": F.max(F.unix_micros(ts))}
        cells = _cells(batch.where(F.col(ts).isNotNull()), [entry], ts, size_s, slide_s, parts)
        cells = _store(cells, f"{state_path}/rows={batch_id}")
        latest = F.greatest(F.max("_latest"), F.lit(seen).cast("bigint")).alias("seen")
        _store(cells.agg(latest).withColumn("earlier", F.lit(seen).cast("bigint")), f"{state_path}/state={batch_id}")
        new = cells.where(held).select(entry, "_pane", CHANGE)
        log.append(new, batch_id, held)

        block = aligned(pane, reach_s)
        blocks = F.explode(F.array(block - reach_s, block, block + reach_s)).alias("_near")
        near = new.select(blocks).distinct()
        now = log.changes(spark).where(held).join(near, block == F.col("_near"), "left_semi")
        now = now.select(entry, "_pane", F.col(CHANGE).alias("_now"), F.col(CHANGE).alias("_before"))
        both = now.union(new.select(entry, "_pane", F.lit(0).cast("bigint"), -F.col(CHANGE)))
        counts = ["_now", "_before"]
        sums = _by_changes(_placed(both, [entry], size_s, slide_s, counts), [entry], slide_s, counts, "_now")
        sides = [F.struct(F.lit(c).alias(CHANGE), F.col(name).alias("n")) for c, name in ((1, "_now"), (-1, "_before"))]
        end_s = F.col("_start") + size_s
        sums = sums.where(is_open(end_s)).select(entry, end_s.alias("_end"), F.explode(F.array(*sides)).alias("_side"))
        sums = sums.where("_side.n > 0").select(
            entry, F.timestamp_seconds("_end").alias(partition), f"_side.{CHANGE}", F.col("_side.n").alias(metric)
        )
        ranked = top_n(sums, [partition, CHANGE], metric, entry, n)
        changes = ranked.groupBy(partition, entry, metric, "rank").agg(F.sum(CHANGE).cast("int").alias(CHANGE))
        sink(_store(changes.where(f"{CHANGE} <> 0"), f"{state_path}/changes={batch_id}"), batch_id)
        _forget(spark, state_path, batch_id, ("rows", "state", "changes"))

    return rows.select(entry, ts).writeStream.outputMode("update").foreachBatch(step)


class CompactedLog:
    """A log of changes in the shared folder ``path``: one table per micro-batch, folded together after every ``every``.

    ``append`` is a sink. A reader sees the newest folded table and at most ``every`` tables of single micro-batches,
    however long the stream has run. Tables are removed only once the table that holds their sum is complete, and a
    repeated micro-batch that has been folded already is left out, so each change counts once.
    """

    def __init__(self, path: str, every: int = 16):
        self.path, self.every = path, every

    def append(self, batch: DataFrame, batch_id: int, held: Column | None = None) -> None:
        """Rows that are not ``held`` are left out when tables are folded."""
        spark = batch.sparkSession
        base, parts = self._tables(spark)
        if base is not None and base >= batch_id:
            return
        batch.write.mode("overwrite").parquet(f"{self.path}/part-{batch_id}")
        self._remove(spark, [f"part-{p}" for p in parts if base is not None and p <= base])
        if (batch_id + 1) % self.every == 0:
            net = self.read(spark) if held is None else self.read(spark).where(held)
            net.write.mode("overwrite").parquet(f"{self.path}/base-{batch_id}")
            self._remove(spark, [f"part-{p}" for p in [*parts, batch_id]])
            if base is not None:
                self._remove(spark, [f"base-{base}"])

    def tables(self, spark: SparkSession) -> list[str]:
        """The folders that a reader has to read."""
        base, parts = self._tables(spark)
        return [f"{self.path}/base-{base}"] * (base is not None) + [f"{self.path}/part-{p}" for p in parts if base is None or p > base]

    def read(self, spark: SparkSession) -> DataFrame:
        """What holds after all changes so far (with ``change`` 1, or as often as it was entered)."""
        changes = self.changes(spark)
        keys = [c for c in changes.columns if c != CHANGE]
        total = F.sum(CHANGE).cast(changes.schema[CHANGE].dataType)
        return changes.groupBy(keys).agg(total.alias(CHANGE)).where(f"{CHANGE} <> 0")

    def changes(self, spark: SparkSession) -> DataFrame:
        """All changes so far, as far as they are not folded yet."""
        return spark.read.parquet(*self.tables(spark))

    def _folder(self, spark: SparkSession):
        folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return folder, folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _tables(self, spark: SparkSession) -> tuple[int | None, list[int]]:
        folder, files = self._folder(spark)
        found = {"base": [], "part": []}
        for status in files.listStatus(folder) if files.exists(folder) else []:
            kind, _, number = status.getPath().getName().partition("-")
            if kind in found and files.exists(status.getPath().suffix("/_SUCCESS")):
                found[kind].append(int(number))
        return max(found["base"], default=None), sorted(found["part"])

    def _remove(self, spark: SparkSession, names: list[str]) -> None:
        folder, files = self._folder(spark)
        for name in names:
            files.delete(folder.suffix(f"/{name}"), True)
