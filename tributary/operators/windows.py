"""Time windows (tumbling, sliding, session, all-window) on event time.

All are built-in Spark grouping expressions, so the same code runs on a
batch DataFrame and on a stream (add ``withWatermark`` first for a stream).
Counts and sums aggregate partially before the shuffle; session windows
are first built inside each input split, then merged per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _aggs(value_col: str):
    return [F.count(F.lit(1)).alias("n"),
            F.round(F.sum(value_col), 2).alias("total")]


def tumbling(df: DataFrame, ts: str, size: str, keys: list[str], value_col: str) -> DataFrame:
    return (df.groupBy(F.window(ts, size).alias("w"), *keys).agg(*_aggs(value_col))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *keys, "n", "total"))


def sliding(df: DataFrame, ts: str, size: str, slide: str, keys: list[str], value_col: str) -> DataFrame:
    return (df.groupBy(F.window(ts, size, slide).alias("w"), *keys).agg(*_aggs(value_col))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *keys, "n", "total"))


def session(df: DataFrame, ts: str, gap: str, keys: list[str], value_col: str) -> DataFrame:
    """Sessions per key: a session closes after ``gap`` without events; its end
    is the last event time plus the gap.

    Two levels so that a hot key is never sessionized in one task:
    1. sessions inside each input split (grouped by split id and key, so one
       key's rows are spread over as many groups as there are splits);
    2. per key, partial sessions that overlap are merged (gaps-and-islands
       over intervals; one row per partial session, not per event).
    """
    part = df.withColumn("_pid", F.spark_partition_id())
    local = (part.groupBy("_pid", *keys, F.session_window(ts, gap).alias("w"))
             .agg(F.count(F.lit(1)).alias("_n"), F.sum(value_col).alias("_t"))
             .select(*keys, F.col("w.start").alias("_s"), F.col("w.end").alias("_e"), "_n", "_t"))
    before = (Window.partitionBy(*keys).orderBy("_s", "_e")
              .rowsBetween(Window.unboundedPreceding, -1))
    upto = (Window.partitionBy(*keys).orderBy("_s", "_e")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    prev_end = F.max("_e").over(before)
    starts = F.when(prev_end.isNull() | (F.col("_s") >= prev_end), F.lit(1)).otherwise(F.lit(0))
    numbered = local.withColumn("_new", starts).withColumn("_sid", F.sum("_new").over(upto))
    return (numbered.groupBy(*keys, "_sid")
            .agg(F.min("_s").alias("session_start"), F.max("_e").alias("session_end"),
                 F.sum("_n").alias("n"), F.round(F.sum("_t"), 2).alias("total"))
            .select(*keys, "session_start", "session_end", "n", "total"))


def window_all(df: DataFrame, ts: str, size: str, value_col: str) -> DataFrame:
    """Non-keyed window: one group per window over the whole stream."""
    return tumbling(df, ts, size, [], value_col)
