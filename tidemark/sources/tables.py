"""Tables in columnar files, with event times as UTC timestamps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import use_utc


def utc_timestamps(df: DataFrame) -> DataFrame:
    """Zone-less timestamps become UTC instants, the type watermarks and windows ask for."""
    zoneless = {f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)}
    return df.select(*[F.col(c).cast("timestamp").alias(c) if c in zoneless else F.col(c) for c in df.columns])


def zoneless_timestamps(df: DataFrame) -> DataFrame:
    """The way back, for results that are compared with or written to zone-less columns."""
    instants = {f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)}
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in instants else F.col(c) for c in df.columns])


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return utc_timestamps(use_utc(spark).read.parquet(f"{folder}/{name}.parquet"))
