"""Top-n rows per group and their text report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import ITEM_REPORT, ReportFormat, ranked_line, report_text


def top_n(
    df: DataFrame,
    partition: str | Sequence[str],
    metric: str,
    tie_break: str | Sequence[str],
    n: int,
    report: bool = False,
    fmt: ReportFormat = ITEM_REPORT,
) -> DataFrame:
    """The ``n`` rows with the largest ``metric`` per partition, as the column ``rank``.

    Ranking at most ``n`` rows lets Spark cut every group to ``n`` rows before the shuffle (for
    ``n`` below ``spark.sql.optimizer.windowGroupLimitThreshold``), so a group of any size reaches
    its task as ``n`` rows per input task. Any type that can be sorted is a metric; null comes
    last. With ``report`` the result is one text per partition instead; the first partition column
    is its time.
    """
    partition = [partition] if isinstance(partition, str) else list(partition)
    ties = [tie_break] if isinstance(tie_break, str) else list(tie_break)
    rows = df.select(*partition, *ties, metric)
    order = Window.partitionBy(*partition).orderBy(F.col(metric).desc(), *[F.col(t).asc() for t in ties])
    ranked = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
    return ranked_report(ranked, partition, ties[0], metric, fmt) if report else ranked


def ranked_report(
    ranked: DataFrame, partition: Sequence[str], entry: str, metric: str, fmt: ReportFormat = ITEM_REPORT
) -> DataFrame:
    """One text per partition out of rows that hold its ranks 1..n."""
    line = ranked_line(F.col("rank"), F.col(entry), F.col(metric), fmt)
    lines = F.sort_array(F.collect_list(F.struct(F.col("rank"), line.alias("line"))))
    texts = ranked.groupBy(*partition).agg(lines.alias("_lines"))
    return texts.select(
        *partition, report_text(F.col(partition[0]), F.col("_lines.line"), fmt).alias("report")
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Keep the row with the highest ``version`` per key: a corrected count replaces the older.

    A version occurs once per key. Columns are picked one by one, so that fixed-width columns
    stay in a hash aggregate.
    """
    values = [c for c in df.columns if c not in keys and c != version]
    newest = df.groupBy(*keys).agg(
        F.max(version).alias(version), *[F.max_by(v, version).alias(v) for v in values]
    )
    return newest.select(*df.columns)
