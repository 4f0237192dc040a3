"""Text records to typed columns; lines that do not fit are returned, not lost."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Access-log time format and endings of static files.
ACCESS_LOG_TIME = "dd/MM/yyyy:HH:mm:ss"
STATIC_ENDINGS = (".css", ".js", ".png", ".ico")


def _parsed_once(df: DataFrame, value_col: str, sep: str, fields: Callable[[Column], list[Column]]) -> DataFrame:
    """``_line`` and its fields as the struct ``_row``, evaluated once per line.

    A filter on plain parsed columns would be pushed below the projection with its own copy of
    the parse; it cannot pass the generator of a one-element array.
    """
    parts = df.select(F.col(value_col).alias("_line"), F.split(F.col(value_col), sep).alias("_parts"))
    row = F.struct(*fields(F.col("_parts")))
    return parts.select("_line", F.explode(F.array(row)).alias("_row"))


def parse_delimited(
    df: DataFrame, schema: T.StructType, value_col: str = "value", sep: str = ","
) -> tuple[DataFrame, DataFrame]:
    """Lines to columns by position: (rows, rejects).

    A line is rejected when it has too few fields or a field is not of its type. Further fields
    are ignored; an empty string field stays an empty string.
    """
    typed = lambda parts: [F.get(parts, i).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)]
    parsed = _parsed_once(df, value_col, re.escape(sep), typed)
    fits = F.lit(True)
    for f in schema.fields:
        fits = fits & F.col("_row").getField(f.name).isNotNull()
    rows = parsed.filter(fits).select("_row.*")
    return rows, parsed.filter(~fits).select(F.col("_line").alias(value_col))


def parse_access_log(df: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Space-separated access-log lines to ip, user_id, ts, method, url: (rows, rejects).

    Times are read as UTC; the zone field after the time is not used.
    """
    def typed(parts: Column) -> list[Column]:
        field = lambda i: F.trim(F.get(parts, i))
        return [
            field(0).alias("ip"),
            field(1).alias("user_id"),
            F.try_to_timestamp(field(3), F.lit(ACCESS_LOG_TIME)).alias("ts"),
            field(5).alias("method"),
            field(6).alias("url"),
        ]

    parsed = _parsed_once(df, value_col, " ", typed)
    fits = F.col("_row.ts").isNotNull() & F.col("_row.url").isNotNull()
    return parsed.filter(fits).select("_row.*"), parsed.filter(~fits).select(F.col("_line").alias(value_col))


def exclude_static_assets(df: DataFrame, url_col: str = "url") -> DataFrame:
    """Drop addresses that end in a static-file suffix (case matters, a query string protects)."""
    static = F.lit(False)
    for ending in STATIC_ENDINGS:
        static = static | F.col(url_col).endswith(ending)
    return df.filter(~static)
