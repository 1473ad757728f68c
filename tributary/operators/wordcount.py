"""Word tokenizing and counting, bounded and running.

Word counts aggregate with a partial (map-side) HashAggregate before the
shuffle, so a very frequent word costs one row per task, not one per
occurrence.  The running count uses a range-blocked prefix sum so that a
frequent word is never ordered inside a single task (``operators.running``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.text import word_array
from tributary.operators.running import blocked_running_sum, quantile_blocks


def tokenize(df: DataFrame, text_col: str = "text", keep: tuple = ()) -> DataFrame:
    """One row per non-empty word: ``(*keep, pos, word, one)``.

    ``pos`` is the index of the word in the split array of its text (empty
    pieces included), which gives a stable order of words inside one text.
    """
    pieces = df.select(*keep, F.posexplode(word_array(F.col(text_col))).alias("pos", "word"))
    return (pieces.where(F.length("word") > 0)
            .select(*keep, "pos", "word", F.lit(1).alias("one")))


def word_count(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``(word, cnt)`` over all texts."""
    return (tokenize(df, text_col).groupBy("word")
            .agg(F.count(F.lit(1)).alias("cnt")))


def word_count_running(df: DataFrame, order_cols: list[str], text_col: str = "text") -> DataFrame:
    """One output row per word occurrence with the count of that word so far.

    The per-record form of a keyed running sum: occurrences are ordered by
    ``order_cols`` then word position (unique).  The order is cut into
    quantile slices of records, so a frequent word is counted slice by slice
    in parallel and then offset by the counts of the slices before it; the
    words of one record always share a slice.
    """
    # a number that never falls along (first, second): the first counts in steps
    # wider than the range of the second, as it is in the data.  Rounding to a
    # double keeps the order (it can only tie records, which then share a slice).
    # Slices are cut on records, before tokenizing.
    record = F.col(order_cols[0]).cast("decimal(38,0)")
    if len(order_cols) > 1:
        second = F.col(order_cols[1])
        low, high = df.agg(F.min(second), F.max(second)).first()
        step = (high - low + 1) if low is not None else 1
        record = (F.col(order_cols[0]).cast("decimal(19,0)") * F.lit(step).cast("decimal(18,0)")
                  + (second - F.lit(low if low is not None else 0)).cast("decimal(18,0)"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocked = quantile_blocks(df, record, n)
    tokens = tokenize(blocked, text_col, keep=tuple(order_cols) + ("_qblk",))
    out = blocked_running_sum(tokens, keys=["word"], order_cols=list(order_cols) + ["pos"],
                              block_col="_qblk", value_col="one", out_col="running_count")
    return out.select(*order_cols, "pos", "word",
                      F.col("running_count").cast("long").alias("running_count"))


def lookup_words(counts: DataFrame, keys: DataFrame) -> DataFrame:
    """Counts of the requested words (a request list, broadcast as such); a word
    never seen gets a null count.  Only requested words are aggregated."""
    wanted = counts.join(F.broadcast(keys.select("word").distinct()), on="word", how="left_semi")
    return keys.join(wanted, on="word", how="left").select("word", "cnt")
