"""Several outputs of one result, told apart by a tag column."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Sink = Callable[[DataFrame, int], None]


def split_outputs(df: DataFrame, tags: Iterable[str], tag_col: str = "output") -> dict[str, DataFrame]:
    """The rows of each tag, without the tag column; works on batch tables and streams."""
    return {tag: df.filter(F.col(tag_col) == tag).drop(tag_col) for tag in tags}


def write_outputs(stream: DataFrame, sinks: Mapping[str, Sink], checkpoint: str, tag_col: str = "output"):
    """A stream writer that hands every micro-batch to one sink per tag; call ``.start()`` on it."""

    def deliver(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for tag, rows in split_outputs(batch, sinks, tag_col).items():
                sinks[tag](rows, batch_id)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)


def parquet_sink(path: str) -> Sink:
    """Write each micro-batch to its own folder, so a repeated batch replaces itself."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def tagged(df: DataFrame, tag: str, tag_col: str = "output") -> DataFrame:
    """Put a constant tag in front of a result, for sinks shared by several results."""
    return df.select(F.lit(tag).alias(tag_col), "*")
