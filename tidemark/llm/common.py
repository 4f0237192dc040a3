"""Small helpers shared by the operators: tables in the shared folder, byte-sized batches, bounded caches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame

from tidemark.session import shared_dir

#: ASCII white space, as the contracts of word-based operators spell it.
SPACE = r"[\x20\x09-\x0D]+"


def new_path(df: DataFrame, name: str) -> str:
    return f"{shared_dir(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = path or new_path(df, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(df: DataFrame, path: str) -> None:
    """Give up the rows of a table in the shared folder that is not read again: an empty one takes its place."""
    df.sparkSession.createDataFrame([], df.schema).write.mode("overwrite").parquet(path)


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the values of a text or binary column in a piece take about ``limit`` bytes."""
    offset, size, begin = batch.schema.get_field_index(column), 0, 0
    lengths = pa.compute.binary_length(batch.column(offset)).fill_null(0).to_numpy(zero_copy_only=False)
    for i, n in enumerate(lengths):
        size += int(n)
        if size >= limit:
            yield batch.slice(begin, i + 1 - begin)
            begin, size = i + 1, 0
    if begin < batch.num_rows:
        yield batch.slice(begin)


class Bounded(dict):
    """A cache ``key -> make(key)`` that starts again when it has ``limit`` entries."""

    def __init__(self, make, limit: int = 200_000):
        super().__init__()
        self._make, self._limit = make, limit

    def __missing__(self, key):
        if len(self) >= self._limit:
            self.clear()
        value = self[key] = self._make(key)
        return value
