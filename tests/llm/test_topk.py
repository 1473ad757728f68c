import math
import random

import numpy as np
from pyspark.sql import functions as F

from tributary.llm import topk


def brute(rows, every, k):
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, qv in {(i, tuple(v)) for i, v in ok if i % every == 0}:
        scored = sorted((-sum(a * b for a, b in zip(qv, v, strict=False)), i) for i, v in ok if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def rows_of(n, dims, seed, copies=0):
    rng = random.Random(seed)
    out = [(i, [rng.gauss(0, 0.2) for _ in range(dims)]) for i in range(n)]
    return out + [(n + i, out[3][1]) for i in range(copies)]


def run(spark, rows, every=5, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return sorted(map(tuple, topk.search(df, "vec_id", "embedding", F.col("vec_id") % every == 0, **more).collect()))


def test_equals_brute_force_over_many_shards_and_blocks(spark):
    rows = rows_of(200, 16, 1, copies=60)
    assert run(spark, rows, k=5, shard=37, block=11) == brute(rows, 5, 5)


def test_odd_vectors_take_no_part(spark):
    rows = rows_of(12, 4, 2) + [(100, None), (105, [1.0, None, 1.0, 1.0]), (110, [float("nan")] * 4),
                                (115, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4), (120, []), (125, [1.0])]
    assert run(spark, rows) == brute(rows, 5, 5)


def test_fewer_rows_than_k_ties_and_repeated_rows(spark):
    rows = [(0, [1.0, 1.0]), (0, [1.0, 1.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (2, [0.5, 0.5])]
    assert run(spark, rows) == [(0, 1, 1, 65536), (0, 2, 2, 65536), (0, 3, 2, 65536)]
    assert run(spark, [(0, [1.0])]) == [] and run(spark, []) == []


def test_scores_beyond_doubles_are_exact():
    x = np.array([[2.0 ** 40, 1.0], [2.0 ** 40, 3.0], [1.0, 1.0]])
    ids, scores = topk.best(np.array([2.0 ** 20, 1.0]), x, np.array([1, 2, 3]), -1, 2)
    assert ids == [2, 1] and scores == [2 ** 60 + 3, 2 ** 60 + 1]


def test_max_score_keeps_all_rows_at_the_threshold():
    rng = np.random.default_rng(3)
    for _ in range(30):
        x = np.floor(rng.normal(0, 3, (300, 24)))
        q = np.floor(rng.normal(0, 3, 24))
        at, score = topk.max_score(q, x, np.ones(300, bool), 5)
        full = x @ q
        assert set(np.flatnonzero(full >= np.sort(full)[-5])) <= set(at.tolist())
        assert np.array_equal(score, full[at])
