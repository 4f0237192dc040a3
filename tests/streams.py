"""Run a table as a stream of several micro-batches and collect what comes out."""

from __future__ import annotations

import datetime as dt
import itertools
import os
import tempfile

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_names = itertools.count()
FAR = dt.datetime(2100, 1, 1, tzinfo=dt.timezone.utc)


def as_stream(
    df: DataFrame, delay: str = "0 seconds", batches: int = 4, ts: str = "ts", swap: int = 0, **beat
) -> DataFrame:
    """Rows in time order, cut into files that arrive one by one; a far-future row closes the end.

    That row is null but for its time and ``beat``: Spark moves filters before the watermark, so
    it has to pass those of the job.
    ``swap`` exchanges neighbours that many rows apart across the whole input, to get disorder.
    """
    spark = df.sparkSession
    rows = df.orderBy(ts).collect()
    if swap:
        for i in range(0, len(rows) - swap, swap * 2):
            rows[i], rows[i + swap] = rows[i + swap], rows[i]
    folder = tempfile.mkdtemp(prefix="tidemark-stream-")
    size = max(1, -(-len(rows) // batches))
    chunks = [rows[i : i + size] for i in range(0, len(rows), size)]
    beat = {c: None for c in df.columns} | beat | {ts: FAR}
    tables = [[r.asDict() for r in chunk] for chunk in chunks] + [[beat]]
    schema = pa.schema([(f.name, _arrow(f.dataType.simpleString())) for f in df.schema.fields])
    for number, content in enumerate(tables):
        for row in content:
            if row[ts].tzinfo is None:
                row[ts] = row[ts].replace(tzinfo=dt.timezone.utc)
        path = f"{folder}/{number:03d}.parquet"
        pq.write_table(pa.Table.from_pylist(content, schema), path)
        os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    return stream.withWatermark(ts, delay)


def _arrow(kind: str) -> pa.DataType:
    return {
        "bigint": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "string": pa.string(),
        "timestamp": pa.timestamp("us", tz="UTC"),
    }[kind]


def drain(stream: DataFrame, mode: str = "append") -> DataFrame:
    name = f"drained_{next(_names)}"
    query = stream.writeStream.outputMode(mode).format("memory").queryName(name)
    query.trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.table(name)


def drain_into(stream: DataFrame, sink, mode: str) -> None:
    query = stream.writeStream.outputMode(mode).foreachBatch(sink)
    query.trigger(availableNow=True).start().awaitTermination()


def lines(df: DataFrame) -> list[tuple]:
    columns = sorted(df.columns)
    return sorted(tuple(str(v) for v in row) for row in df.select(*columns).collect())


def before_end(df: DataFrame, column: str) -> DataFrame:
    """Without what the closing row itself gives rise to."""
    return df.filter(F.col(column) < F.lit("2099-01-01").cast("timestamp"))
