import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F

from tributary.llm import centroids, vectors

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, k, rounds, scale, dims):
    """Rows (id, cluster, distance, inertia of the cluster, of all, digest), by plain loops."""
    ok = [(i, [max(-vectors.BOUND, min(vectors.BOUND, math.floor(scale * x))) for x in v]) for i, v in rows
          if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    seed = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    points = [v for _, v in sorted(ok, key=seed)[:k]]
    place = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, p)), c) for c, p in enumerate(points))
    for _ in range(rounds):
        members = {}
        for _, v in ok:
            members.setdefault(place(v)[1], []).append(v)
        points = [[sum(x) // len(members[c]) for x in zip(*members[c])] if c in members else p
                  for c, p in enumerate(points)]
    found = [(i, *place(v)) for i, v in ok]
    of = lambda c: sum(d for _, d, e in found if e == c)
    digest = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    return sorted(((i, c, d, of(c), sum(x for _, x, _ in found), digest[c]) for i, d, c in found), key=str)


def run(spark, rows, k=16, rounds=3, scale=64, dims=64, shared=centroids.SHARED, extra=()):
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(1).alias(c) for c in extra])
    out = centroids.report(*centroids.cluster(df, "vec_id", "embedding", k, rounds, scale, dims, shared))
    assert out.columns == ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted(map(tuple, out.collect()), key=str)


def rows_of(n, dims, seed, copies=0):
    rng = random.Random(seed)
    out = [(i, [rng.gauss(0, 0.2) for _ in range(dims)]) for i in range(n)]
    return out + [(n + i, out[3][1]) for i in range(copies)]


def test_both_ways_equal_plain_lloyd(spark):
    rows = rows_of(150, 64, 1, copies=80)
    want = brute(rows, 16, 3, 64, 64)
    assert run(spark, rows) == want
    assert run(spark, rows, shared=0) == want


def test_odd_dimensions_and_large_components(spark):
    rows = rows_of(60, 5, 2) + [(70 + i, [10.0 ** (3 * i)] * 5) for i in range(6)]
    want = brute(rows, 7, 2, 1000, 5)
    for shared in (0, centroids.SHARED):
        assert run(spark, rows, 7, 2, 1000, 5, shared) == want


def test_odd_rows_take_no_part(spark):
    rows = rows_of(30, 4, 3) + [(100, None), (101, [1.0] * 3), (102, [1.0] * 5), (103, [1.0, None, 1.0, 1.0]),
                                (104, [float("nan")] * 4), (105, [float("-inf")] * 4), (106, []),
                                (None, [0.5] * 4), (None, [0.1] * 4), (5, [0.3] * 4), (5, [0.3] * 4)]
    want = brute(rows, 40, 3, 64, 4)
    extra = ["id", "uid", "v", "h", "codes", "cluster", "block", "sub", "code", "of", "d0", "a.b"]
    assert run(spark, rows, 40, 3, 64, 4, extra=extra) == want
    assert run(spark, rows, 40, 3, 64, 4, shared=0, extra=extra) == want


def test_empty_tables(spark):
    assert run(spark, []) == [] and run(spark, [(1, None)], shared=0) == []


def test_packing_loses_nothing():
    v = np.random.default_rng(1).integers(-vectors.BOUND, vectors.BOUND + 1, (200, 6))
    keys = centroids.packed(v)
    back = np.concatenate([centroids.unpacked(keys[:, b]) for b in range(keys.shape[1])], axis=1)
    assert (back == v).all()
    edge = np.array([[-vectors.BOUND, vectors.BOUND], [vectors.BOUND, vectors.BOUND]])
    assert (centroids.unpacked(centroids.packed(edge)[:, 0]) == edge).all()
