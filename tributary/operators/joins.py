"""Joins that replace the connected/broadcast stream operators and the state lookups.

Broadcasting is only done for a side whose size is proven small: a literal
request list, or a shuffle stage whose measured output AQE finds under the
broadcast threshold at run time.  Otherwise the join stays a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def latest_per_key(events: DataFrame, key: str, value_cols: list[str], order_cols: list[str]) -> DataFrame:
    """Last value per key by ``order_cols`` (an upsert into a map, replayed).

    ``max_by`` aggregates partially before the shuffle, so a hot key costs one
    row per task.
    """
    order = F.struct(*[F.col(c) for c in order_cols])
    vals = F.struct(*[F.col(c) for c in value_cols])
    return (events.groupBy(key).agg(F.max_by(vals, order).alias("_v"))
            .select(key, *[F.col("_v")[c].alias(c) for c in value_cols]))


def block_by_control(data: DataFrame, control: DataFrame, key) -> DataFrame:
    """Data rows whose key never appears on the control side (left anti join).

    ``key`` is a column name or a list of them.  The control side is reduced
    to distinct keys first (partial aggregation).
    """
    cols = [key] if isinstance(key, str) else list(key)
    keys = control.select(*cols).distinct()
    # No hint: the distinct keys are a shuffle stage, and AQE broadcasts them
    # only when that stage's measured output is under the broadcast threshold
    # (a checked size, with the shuffle join beyond it), without computing
    # the control side twice.
    return data.join(keys, on=cols, how="left_anti")


def enrich(rows: DataFrame, state: DataFrame, key: str) -> DataFrame:
    """Attach the state of each row's key (null when the key has no state)."""
    return rows.join(state, on=key, how="left")


def lookup(keys: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Point lookups: one output row per requested key, nulls when unknown.

    ``keys`` is a request list of the caller's, broadcast as such.  The semi
    join comes first: Catalyst moves it below an aggregation by ``key``, so
    only the requested keys' rows are aggregated."""
    wanted = table.join(F.broadcast(keys.select(key).distinct()), on=key, how="left_semi")
    return keys.join(wanted, on=key, how="left")


def range_keys(spark, range_text: str, key: str = "account") -> DataFrame:
    """Expand ``"a-b"`` to the keys a..b with their position in the range."""
    from tributary.functions.ledger import expand_range
    return (spark.createDataFrame([(range_text,)], "r string")
            .select(F.posexplode(expand_range(F.col("r"))).alias("pos", key)))


def cogroup_counts(left: DataFrame, right: DataFrame, key: str, left_name: str,
                   right_name: str) -> DataFrame:
    """coGroup reduced to per-key sizes of both sides (full outer join of two
    pre-aggregated sides)."""
    lc = left.groupBy(key).agg(F.count(F.lit(1)).alias(left_name))
    rc = right.groupBy(key).agg(F.count(F.lit(1)).alias(right_name))
    return (lc.join(rc, on=key, how="full_outer")
            .select(key, F.coalesce(F.col(left_name), F.lit(0)).alias(left_name),
                    F.coalesce(F.col(right_name), F.lit(0)).alias(right_name)))

