"""Centroid clustering over subvector dictionaries.

Vectors become whole numbers (floor of ``scale`` times a component) and are cut
into blocks of ``BLOCK`` dimensions.  The distinct subvectors of each block are
its dictionary; every vector is kept as one code per block, which loses
nothing.  A round works out the exact squared distance of every distinct
subvector to every centroid's block once; a vector's distances are sums of
those partial distances, looked up by its codes.  Each centroid then becomes the
floor of its vectors' mean, added up per task from the codes before anything
is shuffled.

Where the dictionaries and their partial distances take at most ``SHARED``
bytes (counted before anything is collected), they are broadcast, and a round is
one pass over the table of codes without a shuffle.  Beyond that bound nothing
of them passes through the driver: the codes stand in a table of one row per
vector and block, partial distances are made where the dictionary lies, and a
round joins both by (block, code) and adds up by vector.  Both ways give the
same rows.  Centroids and their sums, k x dimensions numbers, always go through
the driver.

Defined results: rows whose vector is null, has another length than
``dimensions``, or holds a null or non-finite component take no part; scaled
components beyond +-2**25 are cut to that bound.  The first centroids are the
vectors of the smallest SHA-256 of ``1:<id>``; equal ids are ordered by vector,
rows without an id come last.  Equal distances go to the smaller number; a
centroid without vectors stays.  Rows with equal ids and repeated rows are
clustered each; with fewer rows than ``k`` there are as many centroids as rows;
an empty table gives an empty table.  Extra columns are not read, whatever
their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.common import quoted, write_out
from tributary.llm.vectors import BOUND, is_usable, joined, lists, long_sum, matrix, squared_distances, whole

BLOCK = 2                 # dimensions of a block: 1 or 2, so that a subvector fits one 64-bit number
SHARED = 32 << 20         # bytes of dictionaries and partial distances that may be broadcast
PART = 4096
_BASE = 2 * BOUND + 1
_SUMS = "cluster int, component int, total long, n long"


def packed(v: np.ndarray) -> np.ndarray:
    """Rows of vectors as one number per block, in the order of the subvectors."""
    if v.shape[1] % BLOCK:
        v = np.concatenate((v, np.zeros((len(v), 1), dtype=np.int64)), axis=1)
    out = v[:, ::BLOCK] + BOUND
    for j in range(1, BLOCK):
        out = out * _BASE + (v[:, j::BLOCK] + BOUND)
    return out


def unpacked(keys: np.ndarray) -> np.ndarray:
    """The subvectors of packed numbers."""
    out = np.empty((len(keys), BLOCK), dtype=np.int64)
    for j in reversed(range(BLOCK)):
        out[:, j] = keys % _BASE - BOUND
        keys = keys // _BASE
    return out


def _blocks(points: np.ndarray) -> list[np.ndarray]:
    """The part of each point in every block; a last block that is too short is filled with zeros."""
    if points.shape[1] % BLOCK:
        points = np.concatenate((points, np.zeros((len(points), 1), dtype=np.int64)), axis=1)
    return [points[:, b:b + BLOCK] for b in range(0, points.shape[1], BLOCK)]


def _distinct(dimensions: int):
    """(v) -> (block, sub): the distinct subvectors of each batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, keys in enumerate(packed(matrix(batch.column(0), dimensions)).T):
                found = np.unique(keys)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), b, dtype=np.int32)), pa.array(found)],
                                                 names=["block", "sub"])
    return run


def _encoded(words: list[np.ndarray], dimensions: int):
    """(id, v) -> (id, codes): the place of each block's subvector in its dictionary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = packed(matrix(batch.column(1), dimensions))
            codes = np.stack([np.searchsorted(w, keys[:, b]) for b, w in enumerate(words)], axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists(codes)], names=["id", "codes"])
    return run


def partial_distances(words: list[np.ndarray], points: np.ndarray) -> list[np.ndarray]:
    """By block: distances of its distinct subvectors (rows) to the centroids' blocks (columns)."""
    return [squared_distances(unpacked(w), p) for w, p in zip(words, _blocks(points), strict=True)]


def _summed(codes: np.ndarray, partial: list[np.ndarray]) -> np.ndarray:
    out = partial[0][codes[:, 0]]
    for b in range(1, len(partial)):
        out = out + partial[b][codes[:, b]]
    return out


def _by_cluster(v: np.ndarray, cluster: np.ndarray, k: int) -> np.ndarray:
    """Sums of the rows of each cluster; at most ``PART`` rows, so all sums are whole in a double."""
    return ((np.arange(k)[:, None] == cluster[None, :]).astype(np.float64) @ v.astype(np.float64)).astype(np.int64)


def _round(shared, k: int, dimensions: int):
    """(id, codes) -> the sums of each centroid's vectors in this task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, partial = shared.value
        subs = [unpacked(w) for w in words]
        total, n = np.zeros((k, len(words) * BLOCK), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, PART):
                part = batch.slice(at, PART)
                codes = matrix(part.column(1), len(words))
                cluster = _summed(codes, partial).argmin(axis=1)
                v = np.concatenate([sub[codes[:, b]] for b, sub in enumerate(subs)], axis=1)
                total += _by_cluster(v, cluster, k)
                n += np.bincount(cluster, minlength=k)
        each = np.repeat(np.arange(k, dtype=np.int32), dimensions)
        yield pa.RecordBatch.from_arrays(
            [pa.array(each), pa.array(np.tile(np.arange(dimensions, dtype=np.int32), k)),
             pa.array(total[:, :dimensions].reshape(-1)), pa.array(n[each])],
            names=["cluster", "component", "total", "n"])
    return run


def _assigned(shared):
    """(id, codes) -> (id, cluster, distance)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, partial = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, PART):
                part = batch.slice(at, PART)
                d = _summed(matrix(part.column(1), len(words)), partial)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(d.argmin(axis=1).astype(np.int32)), pa.array(d.min(axis=1))],
                    names=["id", "cluster", "distance"])
    return run


def _moved(points: np.ndarray, sums: DataFrame) -> np.ndarray:
    """Centroids at the floor of their vectors' mean."""
    out = points.copy()
    found = sums.groupBy("cluster", "component").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).where("n > 0")
    for r in found.collect():
        out[r.cluster, r.component] = int(r.total) // r.n
    return out


class Broadcast:
    """Rounds with the dictionaries broadcast; rows: (id, v) in a table."""

    def __init__(self, rows: DataFrame, words: DataFrame, dimensions: int):
        self.spark, self.dimensions = rows.sparkSession, dimensions
        found = words.select("block", "sub").toArrow()
        block, sub = found.column("block").to_numpy(), found.column("sub").to_numpy()
        self.words = [np.sort(sub[block == b]) for b in range(-(-dimensions // BLOCK))]
        self.codes = write_out(self.spark, rows.select("id", "v").mapInArrow(
            _encoded(self.words, dimensions), rows.select("id").schema.add("codes", T.ArrayType(T.IntegerType()))), "cluster-codes")

    def _shared(self, points: np.ndarray):
        return self.spark.sparkContext.broadcast((self.words, partial_distances(self.words, points)))

    def move(self, points: np.ndarray) -> np.ndarray:
        return _moved(points, self.codes.mapInArrow(
            _round(self._shared(points), len(points), self.dimensions), _SUMS))

    def assign(self, points: np.ndarray) -> DataFrame:
        kind = self.codes.select("id").schema
        return self.codes.mapInArrow(_assigned(self._shared(points)),
                                     kind.add("cluster", T.IntegerType()).add("distance", T.LongType()))


class Joined:
    """Rounds with dictionaries of any size: codes and partial distances meet in a join."""

    def __init__(self, rows: DataFrame, words: DataFrame, dimensions: int):
        self.rows, self.dimensions, spark = rows, dimensions, rows.sparkSession
        self.words = write_out(spark, words.select("block", "sub").withColumn(
            "code", F.monotonically_increasing_id()), "cluster-words")

        def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys = packed(matrix(batch.column(1), dimensions))
                for b in range(keys.shape[1]):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), pa.array(np.full(len(keys), b, dtype=np.int32)), pa.array(keys[:, b])],
                        names=["uid", "block", "sub"])

        long = rows.select("uid", "v").mapInArrow(split, "uid long, block int, sub long")
        self.codes = write_out(spark, long.join(self.words, ["block", "sub"]).select("uid", "block", "code"),
                               "cluster-codes")

    def _nearest(self, points: np.ndarray) -> DataFrame:
        """(uid, cluster, distance)."""
        blocks = _blocks(points)

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                block, sub = batch.column(0).to_numpy(), unpacked(batch.column(1).to_numpy())
                d = np.zeros((len(block), len(points)), dtype=np.int64)
                for b in np.unique(block).tolist():
                    d[block == b] = squared_distances(sub[block == b], blocks[b])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), *[pa.array(d[:, c]) for c in range(len(points))]],
                    names=["block", "code", *[f"d{c}" for c in range(len(points))]])

        names = [f"d{c}" for c in range(len(points))]
        partial = self.words.mapInArrow(measure, "block int, code long, " + ", ".join(f"{c} long" for c in names))
        sums = (self.codes.join(partial, ["block", "code"]).groupBy("uid").agg(*[F.sum(c).alias(c) for c in names]))
        least = F.array_min(F.array(*[F.struct(F.col(c).alias("d"), F.lit(i).alias("c")) for i, c in enumerate(names)]))
        return sums.select("uid", least.alias("x")).select(
            "uid", F.col("x.c").alias("cluster"), F.col("x.d").alias("distance"))

    def move(self, points: np.ndarray) -> np.ndarray:
        placed = self.rows.select("uid", "v").join(self._nearest(points), "uid").select("cluster", "v")
        k, dimensions = len(points), self.dimensions

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, n = np.zeros((k, dimensions), dtype=np.int64), np.zeros(k, dtype=np.int64)
            for batch in batches:
                for at in range(0, batch.num_rows, PART):
                    part = batch.slice(at, PART)
                    cluster = part.column(0).to_numpy()
                    total += _by_cluster(matrix(part.column(1), dimensions), cluster, k)
                    n += np.bincount(cluster, minlength=k)
            each = np.repeat(np.arange(k, dtype=np.int32), dimensions)
            yield pa.RecordBatch.from_arrays(
                [pa.array(each), pa.array(np.tile(np.arange(dimensions, dtype=np.int32), k)),
                 pa.array(total.reshape(-1)), pa.array(n[each])], names=["cluster", "component", "total", "n"])

        return _moved(points, placed.mapInArrow(add, _SUMS))

    def assign(self, points: np.ndarray) -> DataFrame:
        return self.rows.select("uid", "id").join(self._nearest(points), "uid").drop("uid")


def cluster(df: DataFrame, id_col: str, vector_col: str, k: int = 16, rounds: int = 3, scale: int = 64,
            dimensions: int = 64, shared: int = SHARED) -> tuple[DataFrame, np.ndarray]:
    """((id, cluster, distance) of every usable row, centroids)."""
    spark = df.sparkSession
    vector: Column = quoted(vector_col)
    rows = write_out(spark, df.where(is_usable(vector) & (F.size(vector) == dimensions)).select(
        F.monotonically_increasing_id().alias("uid"), quoted(id_col).alias("id"), whole(vector, scale).alias("v")),
        "cluster-rows")
    order = F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")).cast("binary"), 256)
    seeds = rows.select("v", order.alias("h")).orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()
    points = np.array([r.v for r in seeds], dtype=np.int64).reshape(len(seeds), dimensions)
    if not len(points):
        empty = rows.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return empty, points
    words = write_out(spark, rows.select("v").mapInArrow(_distinct(dimensions), "block int, sub long").distinct(),
                      "cluster-dictionary")
    small = words.count() * 8 * (1 + len(points)) <= shared
    way = (Broadcast if small else Joined)(rows, words, dimensions)
    for _ in range(rounds):
        points = way.move(points)
    return way.assign(points), points


def report(assigned: DataFrame, points: np.ndarray) -> DataFrame:
    """``assigned`` with cluster_inertia, inertia and centroid_sha256 added."""
    spark = assigned.sparkSession
    out = write_out(spark, assigned, "clusters")
    digests = spark.createDataFrame([(c, hashlib.sha256(joined(p)).hexdigest()) for c, p in enumerate(points)],
                                    "of int, centroid_sha256 string")
    per = out.groupBy(F.col("cluster").alias("of")).agg(long_sum(F.col("distance")).alias("cluster_inertia"),
                                                        F.sum(F.col("distance").cast("decimal(38,0)")).alias("own"))
    # a row for each centroid
    whole_sum = F.least(F.lit((1 << 63) - 1).cast("decimal(38,0)"), F.sum("own").over(W.partitionBy())).cast("long")
    per = per.withColumn("inertia", whole_sum).drop("own").join(digests, "of")
    return (out.join(F.broadcast(per), F.col("cluster") == F.col("of"))
            .select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
