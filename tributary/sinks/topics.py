"""Topic writers.

A topic is either a Kafka topic (``format("kafka")``, needs the connector on
the classpath) or a directory of JSON-lines message files, one sub-folder per
topic; both take a frame of ``(topic, key, value)``.  Several routes of one
operator are written by **one** write with a computed ``topic`` column, never
one pass per route.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary import schemas as S
from tributary.functions.codec import to_messages
from tributary.functions.ledger import route_after_debit2


def topic_for_status(status: Column) -> Column:
    """After-debit routing (pending-list design): DEBIT_SUCCESS back to the raw
    topic for its credit, everything else to the completed topic."""
    return (F.when(route_after_debit2(status) == "raw", F.lit(S.TOPIC_RAW))
            .otherwise(F.lit(S.TOPIC_COMPLETED)))


def routed_messages(tx: DataFrame, key: Column | None = None) -> DataFrame:
    """``(topic, key, value)`` frame for a routed write of transfers."""
    framed = tx.withColumn("topic", topic_for_status(F.col("status")))
    return to_messages(framed, key=key, keep=("topic",))


def text_messages(df: DataFrame, text: Column, topic: str | None = None) -> DataFrame:
    """K2: string messages whose key and value are both the text."""
    out = df.select(text.cast("string").alias("key"), text.cast("string").alias("value"))
    return out.withColumn("topic", F.lit(topic)) if topic else out


def _print_all(df: DataFrame) -> None:
    """Print every row, fetched one partition at a time."""
    for row in df.toLocalIterator():
        print(*row, sep=" | ")


def print_rows(df: DataFrame, label: str | None = None, stream: bool | None = None):
    """K1: print every row on the driver, optionally prefixed with a label; a
    stream prints each micro-batch."""
    framed = df.select(F.lit(label).alias("label"), "*") if label else df
    if stream if stream is not None else df.isStreaming:
        from tributary.session import scratch_path
        return (framed.writeStream.foreachBatch(lambda batch, _: _print_all(batch))
                .option("checkpointLocation", scratch_path(df.sparkSession, "console")).start())
    _print_all(framed)
    return None


def write_topics(messages: DataFrame, target: str, kafka_servers: str | None = None,
                 mode: str = "append") -> None:
    """Batch write of a message frame.  With ``kafka_servers`` it goes to Kafka
    (topic per row); otherwise to ``target/topic=<name>/`` JSON-lines files."""
    if kafka_servers:
        (messages.selectExpr("topic", "CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
         .write.format("kafka").option("kafka.bootstrap.servers", kafka_servers).save())
        return
    messages.write.mode(mode).partitionBy("topic").json(target)


def start_topic_stream(messages: DataFrame, target: str, checkpoint: str,
                       kafka_servers: str | None = None, trigger: dict | None = None):
    """Streaming twin of ``write_topics``; the checkpoint makes restarts resume."""
    trigger = trigger or {"availableNow": True}
    if kafka_servers:
        writer = (messages.selectExpr("topic", "CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
                  .writeStream.format("kafka").option("kafka.bootstrap.servers", kafka_servers))
    else:
        writer = messages.writeStream.format("json").partitionBy("topic").option("path", target)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
