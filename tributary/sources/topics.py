"""Topics and line streams as DataFrames.

A topic is a Kafka topic when ``kafka_servers`` is given (needs the Kafka
connector on the classpath), otherwise a folder of JSON-lines message files
``<base>/topic=<name>/`` as written by ``sinks.topics``.  Either way the
result has ``key`` and ``value`` text columns, decoded with a fixed schema
by ``functions.codec``; offsets live in the query checkpoint, not in a
consumer group.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary import schemas as S
from tributary.functions.codec import decode_frame

MESSAGE = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])


def topic_path(base: str, topic: str) -> str:
    return os.path.join(base, f"topic={topic}")


def ensure_folder(spark: SparkSession, path: str) -> None:
    """Create a folder in whatever file system its path names (a stream cannot watch a missing one)."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(where)


def read_messages(spark: SparkSession, topic: str, base: str | None = None,
                  kafka_servers: str | None = None, stream: bool = True,
                  starting_offsets: str = "earliest") -> DataFrame:
    """``(key, value)`` messages of one topic, as a stream or a bounded read."""
    if kafka_servers:
        reader = spark.readStream if stream else spark.read
        df = (reader.format("kafka").option("kafka.bootstrap.servers", kafka_servers)
              .option("subscribe", topic).option("startingOffsets", starting_offsets).load())
        return df.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
    path = topic_path(base, topic)
    ensure_folder(spark, path)
    if stream:
        return spark.readStream.schema(MESSAGE).json(path)
    return spark.read.schema(MESSAGE).json(path)


def read_topic(spark: SparkSession, topic: str, schema: T.StructType = S.BANK_TX,
               base: str | None = None, kafka_servers: str | None = None, stream: bool = True,
               mode: str = "FAILFAST") -> DataFrame:
    """Decoded records of one topic (S4/S5): JSON with a fixed schema."""
    msgs = read_messages(spark, topic, base, kafka_servers, stream)
    return decode_frame(msgs, "value", schema=schema, mode=mode)


def read_lines(spark: SparkSession, path: str | None = None, host: str | None = None,
               port: int | None = None) -> DataFrame:
    """Unbounded text lines (S2) as a one-column ``value`` stream: from a folder
    of text files, or as a client of a line server at ``host:port``."""
    if host:
        return spark.readStream.format("socket").option("host", host).option("port", port).load()
    return spark.readStream.text(path)
