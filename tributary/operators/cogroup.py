"""coGroup for user code: a function over the rows of one key on two sides.

Ordinary keys go to the function whole.  A key with more than ``block_rows``
rows on a side is cut, in one of two ways:

* with an ``order``, a number for each left and each right row, both sides are
  cut along it into common ranges of about ``block_rows`` rows, and every row is
  in one range.  The function is called for the left and the right rows of each
  range; what it has to know of the right rows of *later* ranges, which all lie
  strictly behind its left rows, comes with the left rows as sums (``beyond``).
  Rows sent grow with the input.  Nulls lie behind all numbers, like NaN;
* without one, or where one place of the order has too many rows, into blocks on
  both sides.  The function is called for every pair of a left and a right
  block, so that each left row meets each right row of its key exactly once.  A
  row is then sent once for each block of the other side: for a function that
  has to see all pairs there is no less.

No call gets more than about ``block_rows`` rows of a side.  A side without rows
is one empty block.  Many keys travel together, about ``block_rows`` rows at a
time, and are parted where the function is called.

A function whose result is a list of row pairs (a join of any kind) can be used
as it is.  One that counts or sums per key or per left row gives partial results
for a cut key; ``merge`` adds them up, and it is applied to the results of all
keys, so cut and whole keys come out alike.

How often a key occurs is counted with partial aggregation; the driver holds a
row for each busy key and one for each of its ranges, of ``block_rows`` rows.
The ranges' borders come from a sample, which decides their sizes only, never a
result.  Null keys group together.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_ROWS = 50_000
SAMPLED = 64             # rows of the sample for each range
_KEY, _RANGE, _LEFT, _RIGHT, _BUCKET = "__key", "__range", "__left", "__right", "__bucket"
_HIDDEN = [_KEY, _RANGE, _LEFT, _RIGHT, _BUCKET]


def _keys(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``__key``, of one type and one value for equal keys."""
    kind = left.select(key).unionAll(right.select(key)).schema[0].dataType
    value = F.col(key).cast(kind)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = value + F.lit(0.0).cast(kind)           # -0.0 is 0.0
    elif isinstance(kind, (T.StructType, T.ArrayType)):
        value = F.when(value.isNotNull(), F.to_json(F.struct(value)))
    return left.withColumn(_KEY, value), right.withColumn(_KEY, value)


def _place(order: str | Column) -> Column:
    value = F.expr(order) if isinstance(order, str) else order
    return F.coalesce(value.cast("double"), F.lit(float("nan")))


def _borders(sides: list[DataFrame], block_rows: int) -> dict[int, np.ndarray]:
    """Borders of ranges of about ``block_rows`` rows of (id, place), by id."""
    share = min(1.0, SAMPLED / block_rows)
    step = max(1, int(share * block_rows))
    rows = sides[0].unionAll(sides[1]).sample(share, seed=7)
    cuts = (rows.groupBy("id").agg(F.sort_array(F.collect_list("place")).alias("s")).where(F.size("s") > step)
            .select("id", F.expr(f"transform(sequence({step}, size(s) - 1, {step}), i -> s[i])").alias("cuts")))
    return {r.id: np.unique(np.array(r.cuts, dtype=np.float64)) for r in cuts.collect()}


def _range(borders: dict[int, np.ndarray]):
    @F.pandas_udf("int")
    def number(ids: pd.Series, place: pd.Series) -> pd.Series:
        of, at = ids.fillna(-1).to_numpy().astype(np.int64), place.to_numpy()
        out = np.zeros(len(of), dtype=np.int32)
        for i in np.unique(of).tolist():
            if i in borders:
                mine = of == i
                out[mine] = np.searchsorted(borders[i], at[mine], side="right")
        return pd.Series(out)
    return number


def _joined(rows: DataFrame, table: DataFrame, on: dict[str, str]) -> DataFrame:
    """``rows`` with the columns of a small ``table`` whose keys ``on`` they equal."""
    same = None
    for mine, other in on.items():
        equal = F.col(mine).eqNullSafe(F.col(other))
        same = equal if same is None else same & equal
    return rows.join(F.broadcast(table), same, "left").drop(*on.values())


def _dealt(side: DataFrame, columns: list[Column], own: str, other: str, buckets: int) -> DataFrame:
    """Rows with their block, once for each block of the other side."""
    mine, theirs = F.coalesce(F.col(f"n{own}"), F.lit(1)), F.coalesce(F.col(f"n{other}"), F.lit(1))
    row = side.withColumn("__row", F.xxhash64(F.monotonically_increasing_id())).withColumn(own, F.pmod("__row", mine).cast("int"))
    cell = F.when(F.col("id").isNull(), F.pmod(F.xxhash64(_KEY), F.lit(buckets))).otherwise(
        F.xxhash64(_KEY, _RANGE, _LEFT, _RIGHT))
    return (row.withColumn(other, F.explode(F.sequence(F.lit(0), (theirs - 1).cast("int"))))
            .withColumn(_BUCKET, cell).select(*columns, *_HIDDEN))


def _cells(x: pa.Table, y: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the rows' cells (key, range, left, right); equal for equal cells of both sides."""
    both = pa.concat_tables([x.select(_HIDDEN[:4]), y.select(_HIDDEN[:4])])
    coded = both.column(_KEY).combine_chunks().dictionary_encode(null_encoding="encode")
    coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
    number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    for c in _HIDDEN[1:4]:
        _, part = np.unique(both.column(c).to_numpy(), return_inverse=True)
        _, number = np.unique(number * (int(part.max(initial=0)) + 1) + part, return_inverse=True)
    return number[:x.num_rows], number[x.num_rows:]


def _called(function: Callable[[pa.Table, pa.Table], pa.Table]):
    """``function`` for every cell of two sides."""
    def call(x: pa.Table, y: pa.Table) -> pa.Table:
        a, b = _cells(x, y)
        i, j = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
        cells = np.unique(np.concatenate((a, b)))
        ends = lambda cell, order: np.searchsorted(cell[order], np.append(cells, cells[-1] + 1)).tolist()
        m, n = ends(a, i), ends(b, j)
        x, y = x.drop_columns(_HIDDEN).take(i).combine_chunks(), y.drop_columns(_HIDDEN).take(j).combine_chunks()
        made = [function(x.slice(m[k], m[k + 1] - m[k]), y.slice(n[k], n[k + 1] - n[k])) for k in range(len(cells))]
        some = [t for t in made if t.num_rows]
        return pa.concat_tables(some, promote_options="default").combine_chunks() if some else made[0]
    return call


def cogroup(left: DataFrame, right: DataFrame, key: str, function: Callable[[pa.Table, pa.Table], pa.Table], schema: str,
            merge: Callable[[DataFrame], DataFrame] | None = None, block_rows: int = BLOCK_ROWS,
            order: tuple[str | Column, str | Column] | None = None,
            beyond: dict[str, str | Column] | None = None) -> DataFrame:
    """``function(left rows, right rows)`` of every key (or of its ranges or pairs of blocks), as one table of ``schema``.

    ``order``: the places of left and right rows, numbers.  ``beyond``: names and
    values of right rows; the function finds the sums of the values over the
    right rows of later ranges, as doubles, in columns of these names of its left
    rows (0 for a key that isn't cut).
    """
    spark, beyond = left.sparkSession, beyond or {}
    taken = [[F.col(c) for c in side.columns] for side in (left, right)]
    a, b = _keys(left, right, key)
    kind = a.schema[_KEY]
    one, none = F.lit(1), F.lit(0)
    counted = (a.select(_KEY, one.alias("l"), none.alias("r")).unionAll(b.select(_KEY, none.alias("l"), one.alias("r")))
               .groupBy(_KEY).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
               .where((F.col("l") > block_rows) | (F.col("r") > block_rows)).collect())
    total = a.select(_KEY).unionAll(b.select(_KEY)).count()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(4 * parts, -(-total // block_rows))
    busy = spark.createDataFrame([(r[_KEY], i) for i, r in enumerate(counted)],
                                 T.StructType([T.StructField("__busy", kind.dataType), T.StructField("id", T.IntegerType())]))
    a, b = (_joined(side, busy, {_KEY: "__busy"}) for side in (a, b))
    names = list(beyond)
    if order and counted:
        a, b = a.withColumn("place", _place(order[0])), b.withColumn("place", _place(order[1]))
        number = _range(_borders([side.where("id IS NOT NULL").select("id", "place") for side in (a, b)], block_rows))
        a, b = (side.withColumn(_RANGE, number("id", "place")) for side in (a, b))
        value = lambda v: (F.expr(v) if isinstance(v, str) else v).cast("double")
        sized = a.where("id IS NOT NULL").select("id", _RANGE, one.alias("l"), none.alias("r"),
                                                 *[F.lit(0.0).alias(c) for c in names])
        sized = (sized.unionAll(b.where("id IS NOT NULL").select("id", _RANGE, none.alias("l"), one.alias("r"),
                                                                 *[value(v).alias(c) for c, v in beyond.items()]))
                 .groupBy("id", _RANGE).agg(*[F.sum(c).alias(c) for c in ("l", "r", *names)]))
        later = W.partitionBy("id").orderBy(_RANGE).rowsBetween(1, W.unboundedFollowing)
        ranges = sized.select("id", _RANGE, "l", "r", *[F.sum(c).over(later).alias(c) for c in names]).collect()
    else:
        a, b = a.withColumn(_RANGE, none), b.withColumn(_RANGE, none)
        ranges = [(i, 0, r.l, r.r, *[0.0] * len(names)) for i, r in enumerate(counted)]
    cells = spark.createDataFrame(
        [(i, k, max(1, -(-l // block_rows)), max(1, -(-r // block_rows)), *sums) for i, k, l, r, *sums in ranges],
        ", ".join(["__id int", "__at int", f"n{_LEFT} int", f"n{_RIGHT} int", *[f"`{c}` double" for c in names]]))
    a = _joined(a, cells, {"id": "__id", _RANGE: "__at"})
    b = _joined(b, cells.drop(*names), {"id": "__id", _RANGE: "__at"})
    # sums go to the first of a row's pairs of blocks
    sums = [F.when(F.col(_RIGHT) == 0, F.coalesce(F.col(f"`{c}`"), F.lit(0.0))).otherwise(F.lit(0.0)).alias(c) for c in names]
    a = _dealt(a, [*taken[0], *sums], _LEFT, _RIGHT, buckets)
    b = _dealt(b, taken[1], _RIGHT, _LEFT, buckets)
    out = a.groupBy(_BUCKET).cogroup(b.groupBy(_BUCKET)).applyInArrow(_called(function), schema)
    return merge(out) if merge else out
