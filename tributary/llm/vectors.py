"""Whole-number vectors: what the vector operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

BOUND = 1 << 25      # components are cut to +-BOUND: sums of squares over 1,024 components then fit 64 bits
LONGEST = (1 << 63) - 1


def is_usable(vector: Column) -> Column:
    """True for a vector that is not null and has no null or non-finite component."""
    value = lambda c: c.cast("double")
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(value(c)) | (F.abs(value(c)) == float("inf")))
    return vector.isNotNull() & ~bad


def whole(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component as array<int>, cut to +-``BOUND``."""
    return F.transform(vector, lambda c: F.floor(F.greatest(F.lit(float(-BOUND)), F.least(
        F.lit(float(BOUND)), c.cast("double") * scale))).cast("int"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The lists of an Arrow column, all of ``width`` whole numbers, as rows (int64)."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def lists(rows: np.ndarray) -> pa.Array:
    """Rows of whole numbers as an Arrow column of int32 lists."""
    ends = np.arange(len(rows) + 1, dtype=np.int32) * (rows.shape[1] if rows.ndim == 2 else 0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.reshape(-1).astype(np.int32)))


def squared_distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared Euclidean distances of all rows of ``x`` to all ``points`` (int64)."""
    top = max(np.abs(x).max(initial=0), np.abs(points).max(initial=0)) + 1
    if 4 * int(top) ** 2 * max(1, x.shape[1]) < 1 << 52:       # whole in doubles
        a, b = x.astype(np.float64), points.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    return np.stack([((x - p) ** 2).sum(1) for p in points], axis=1)


def nearest(x: np.ndarray, points: np.ndarray, step: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest point of every row; ties to the lower index."""
    at, far = np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=np.int64)
    for k in range(0, len(x), step):
        d = squared_distances(x[k:k + step], points)
        at[k:k + step] = d.argmin(axis=1)
        far[k:k + step] = d.min(axis=1)
    return at, far


def joined(numbers: Iterable[int]) -> bytes:
    """Decimal numbers joined by commas."""
    return ",".join(str(int(n)) for n in numbers).encode()


def long_sum(column: Column) -> Column:
    """A sum of whole numbers that cannot overflow on its way, cut to the ends of a long."""
    total = F.sum(column.cast("decimal(38,0)"))
    return F.greatest(F.lit(-LONGEST), F.least(F.lit(LONGEST).cast("decimal(38,0)"), total)).cast("long")
