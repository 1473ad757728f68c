"""Keyed running sums that stay parallel when one key is very hot.

A plain ``sum().over(partitionBy(key).orderBy(...))`` orders every row of a
key inside one task.  Here the order is cut into blocks (a column that never
decreases along the order, e.g. a time bucket), and the sum is computed in
two levels:

1. inside each ``(key, block)``: a local running sum (window);
2. per key: an exclusive prefix sum over the block totals (one row per
   block, pre-aggregated map-side before the shuffle);

and the two are added after an equi-join on ``(key, block)``.  The largest
group ordered in one task is one key inside one block, and the second level
only holds one row per block.  AQE turns the join into a broadcast at run
time when the offsets turn out small; otherwise it stays a shuffle join.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def blocked_running_sum(df: DataFrame, keys: list[str], order_cols: list, block_col: str,
                        value_col: str, out_col: str) -> DataFrame:
    """Add ``out_col`` = inclusive running sum of ``value_col`` per ``keys``.

    Rows are ordered by ``order_cols`` inside a key; ``block_col`` must be
    non-decreasing in that order and ``order_cols`` must be unique per key.
    """
    local_w = (Window.partitionBy(*keys, block_col).orderBy(*order_cols)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = df.withColumn("_local_sum", F.sum(value_col).over(local_w))

    totals = df.groupBy(*keys, block_col).agg(F.sum(value_col).alias("_block_total"))
    prefix_w = (Window.partitionBy(*keys).orderBy(block_col)
                .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*keys, block_col,
                            F.coalesce(F.sum("_block_total").over(prefix_w),
                                       F.lit(0)).alias("_offset"))

    joined = local.join(offsets, on=[*keys, block_col], how="inner")
    return (joined.withColumn(out_col, F.col("_offset") + F.col("_local_sum"))
            .drop("_offset", "_local_sum"))


def quantile_blocks(df: DataFrame, order_value: Column, num_blocks: int, out_col: str = "_qblk",
                    tie_value: Column | None = None) -> DataFrame:
    """Add ``out_col``: the quantile slice of a numeric order value.

    Cut points come from one ``approxQuantile`` pass over the order value, so
    every slice holds about ``1/num_blocks`` of all rows; ``Bucketizer``
    assigns slices by binary search in the JVM.  A key's rows inside one
    slice are therefore at most one slice, however skewed the key.  The cut
    points are computed once on the driver (``num_blocks - 1`` numbers) and
    are fixed values in the plan, so every branch that reads them agrees.

    A value that comes out at several cut points holds more than a slice by
    itself (a bulk load with one instant).  Its rows are cut again by
    ``tie_value``, a number that orders them, at as many quantiles.
    """
    from pyspark.ml.feature import Bucketizer
    tmp = df.withColumn("_ord", order_value.cast("double"))
    probs = [i / num_blocks for i in range(1, num_blocks)]
    found = tmp.approxQuantile("_ord", probs, 1.0 / (10 * num_blocks)) if probs else []
    finite = [c for c in found if c not in (float("-inf"), float("inf"))]
    splits = [float("-inf")] + sorted(set(finite)) + [float("inf")]
    if len(splits) < 3:
        return df.withColumn(out_col, F.lit(0).cast("long"))
    bucketed = Bucketizer(splits=splits, inputCol="_ord", outputCol="_bkt", handleInvalid="keep").transform(tmp)
    block = F.col("_bkt").cast("long")
    tied = {v: n for v, n in Counter(finite).items() if n > 1} if tie_value is not None else {}
    if tied:
        cuts = _tie_cuts(tmp, tied, tie_value)
        part = F.lit(0)
        for v, own in cuts.items():
            at = splits.index(v)
            # a slice begins with its tied value; what is larger follows all parts of it
            inside = F.size(F.filter(F.array(*[F.lit(c) for c in own]), lambda c: c <= tie_value.cast("double")))
            part = (F.when(F.col("_ord") == v, inside).when(F.col("_bkt") == at, F.lit(len(own) + 1)).otherwise(part))
        block = block * (num_blocks + 1) + part
    return bucketed.withColumn(out_col, block.cast("long")).drop("_ord", "_bkt")


def _tie_cuts(rows: DataFrame, tied: dict[float, int], tie_value: Column) -> dict[float, list[float]]:
    """By tied value, the quantiles of its rows' second order value: no more in all than there are slices."""
    most = max(tied.values()) + 1
    shares = F.array(*[F.lit(i / most) for i in range(1, most)])
    found = (rows.where(F.col("_ord").isin(list(tied))).groupBy("_ord")
             .agg(F.percentile_approx(tie_value.cast("double"), shares, F.lit(10 * most)).alias("cuts")).collect())
    return {r["_ord"]: sorted(set(r["cuts"])) for r in found if r["cuts"]}


def ordered_running_sum(df: DataFrame, keys: list[str], order_cols: list, value_col: str,
                        out_col: str, order_value: Column | None = None,
                        num_blocks: int | None = None, tie_value: Column | None = None) -> DataFrame:
    """``blocked_running_sum`` with quantile blocks of the order.

    ``order_value`` is a numeric expression that never decreases along
    ``order_cols`` (default: the first order column); rows it ties on are
    ordered by ``tie_value`` (default: the second order column, if it is a number).  Every
    (key, block) group is at most about ``1/num_blocks`` of all rows, and the
    per-key prefix level holds at most ``num_blocks`` rows per key.
    """
    n = int(num_blocks or df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    value = order_value if order_value is not None else F.col(order_cols[0])
    if tie_value is None and len(order_cols) > 1 and isinstance(df.schema[order_cols[1]].dataType, T.NumericType):
        tie_value = F.col(order_cols[1])
    blocked = quantile_blocks(df, value, n, tie_value=tie_value)
    out = blocked_running_sum(blocked, keys, order_cols, "_qblk", value_col, out_col)
    return out.drop("_qblk")
