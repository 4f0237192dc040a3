"""Lines from files, sockets and message topics, and back, through Spark's own connectors."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import use_utc

KINDS = ("file", "kafka", "socket")

# Spark always hands over bytes and sets its own (de)serializers.
_SET_BY_SPARK = {"key.deserializer", "value.deserializer", "key.serializer", "value.serializer"}


def load_properties(path: str) -> dict[str, str]:
    """Key/value lines of a properties file; ``#`` and ``!`` start comments."""
    properties = {}
    with open(path, encoding="utf-8") as lines:
        for line in lines:
            line = line.strip()
            if line and line[0] not in "#!":
                name, _, value = line.partition("=")
                properties[name.strip()] = value.strip()
    return properties


def _kafka(properties: Mapping[str, str], topic_option: str) -> dict[str, str]:
    options = {}
    for name, value in properties.items():
        if name in _SET_BY_SPARK:
            continue
        if name == "topic":
            options[topic_option] = value
        elif name == "auto.offset.reset":
            options["startingOffsets"] = value
        elif "." in name:
            options[f"kafka.{name}"] = value
        else:
            options[name] = value
    return options


def source_options(kind: str, properties: Mapping[str, str]) -> dict[str, str]:
    """Reader options for client properties such as ``bootstrap.servers`` or ``host``/``port``."""
    if kind == "kafka":
        options = _kafka(properties, "subscribe")
        missing = {"subscribe", "kafka.bootstrap.servers"} - set(options)
    elif kind == "socket":
        options, missing = dict(properties), {"host", "port"} - set(properties)
    elif kind == "file":
        options, missing = dict(properties), {"path"} - set(properties)
    else:
        raise ValueError(f"kind must be one of {KINDS}")
    if missing:
        raise ValueError(f"{kind} source lacks {sorted(missing)}")
    return options


def sink_options(kind: str, properties: Mapping[str, str]) -> dict[str, str]:
    """Writer options; a topic needs the message brokers, files need a path."""
    if kind == "kafka":
        options = _kafka({k: v for k, v in properties.items() if k != "auto.offset.reset"}, "topic")
        missing = {"topic", "kafka.bootstrap.servers"} - set(options)
    elif kind == "file":
        options, missing = dict(properties), {"path"} - set(properties)
    elif kind == "console":
        options, missing = dict(properties), set()
    else:
        raise ValueError("kind must be 'kafka', 'file' or 'console'")
    if missing:
        raise ValueError(f"{kind} sink lacks {sorted(missing)}")
    return options


def read_lines(
    spark: SparkSession, kind: str, properties: Mapping[str, str], streaming: bool = True
) -> DataFrame:
    """A table or stream with the single string column ``value``."""
    options = source_options(kind, properties)
    if kind == "socket" and not streaming:
        raise ValueError("a socket can only be read as a stream")
    reader = use_utc(spark).readStream if streaming else use_utc(spark).read
    lines = reader.format("text" if kind == "file" else kind).options(**options).load()
    return lines.select(F.col("value").cast("string").alias("value"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, streaming: bool = False) -> DataFrame:
    """Delimited files through Spark's CSV reader: typed by ``schema``, bad lines kept in ``_bad``."""
    full = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    reader = use_utc(spark).readStream if streaming else use_utc(spark).read
    return (
        reader.schema(full)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_bad")
        .csv(path)
    )


def publish_lines(df: DataFrame, properties: Mapping[str, str], value_col: str = "value"):
    """Writer that sends one message per line to a topic: ``.save()`` a table, ``.start()`` a stream."""
    messages = df.select(F.col(value_col).cast("string").alias("value"))
    writer = messages.writeStream if df.isStreaming else messages.write
    return writer.format("kafka").options(**sink_options("kafka", properties))
