"""Exact top-k search by inner product with MaxScore over shards.

Components are whole numbers.  A query's terms are its dimensions.  Within a
shard every dimension is shifted so that what a vector adds to a query is
never negative (for a positive query component from the shard's least
component, for a negative one from its largest): a term's postings hold that
impact for each vector, its score bound is its largest impact, and a score is
the shift's constant plus the sum of impacts.

Terms are ranked by bound.  A first threshold is the k-th best full score of
``FIRST`` vectors of the shard.  The essential terms are those without which no
vector could reach it: the bounds of all others together stay below it.  They
are traversed for all postings; then the threshold rises to the k-th best full
score of the vectors that lead, and the others are probed in falling order of
bound, only for vectors whose score so far plus the bounds still open reaches
the threshold.  Ties are kept, so the result is exact.

Rows are dealt to shards of at most about ``SHARD`` vectors by their place in
the input, queries to blocks of about ``BLOCK``; every (shard, block) is one
group, and the shards' lists of at most k rows a query are merged by a window.
A group's size does not depend on the ids or the vectors, so equal vectors or
repeated ids make no group larger.

Defined results: rows with a null id, a null vector, or a null or non-finite
component take no part; a shorter vector counts as padded with zeros, an empty
one scores 0 with all; equal scores are ranked by id; a row never meets rows of
its own id; rows that repeat as candidates are each listed, equal query rows
count once; scores beyond the long range are cut to its ends; vectors of any
length are read whole; an empty table gives an empty table.  Extra columns are
not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tributary.llm.common import quoted

SHARD = 2_048
BLOCK = 2_048
STEP = 8             # terms probed between two prunings
FIRST = 64           # vectors that give a shard's first threshold
_LONG = np.iinfo(np.int64)


def whole_components(vectors: list, scale: float) -> np.ndarray:
    """floor(scale * x) of every component, as doubles, shorter rows padded with zeros."""
    size = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), size))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = np.floor(np.asarray(v, dtype=np.float64) * scale)
    return out


def _exact(q: np.ndarray, x: np.ndarray) -> bool:
    """Whether all sums of products stay whole in a double."""
    top = (np.abs(q).max(initial=0) + 1) * (np.abs(x).max(initial=0) + 1) * max(1, x.shape[1])
    return bool(top < 2.0 ** 52)


def max_score(q: np.ndarray, x: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, scores) of all vectors of ``x`` that reach the k-th best score of the ``allowed`` rows."""
    at = np.flatnonzero(allowed)
    low, high = x.min(axis=0), x.max(axis=0)
    bound = np.abs(q) * (high - low)
    order = np.argsort(-bound, kind="stable")
    q, shift = q[order], np.where(q > 0, low, high)[order]
    rest = np.concatenate((np.cumsum(bound[order][::-1])[::-1], [0.0]))   # bounds still open before each term
    score = np.full(len(at), float(q @ shift))                            # the shift's constant
    if len(at) <= k:
        return at, score + (x[np.ix_(at, order)] - shift) @ q
    some = at[:: max(1, len(at) // max(FIRST, k))]
    sample = score[0] + (x[np.ix_(some, order)] - shift) @ q
    first = np.partition(sample, len(sample) - k)[len(sample) - k]
    # essential: until the bounds still open cannot make up for what the constant lacks to the threshold
    head = int(np.flatnonzero(score[0] + rest < first)[0]) if score[0] + rest[-1] < first else len(q)
    score += (x[np.ix_(at, order[:head])] - shift[:head]) @ q[:head]
    lead = np.argpartition(-score, 4 * k)[:4 * k] if len(at) > 4 * k else np.arange(len(at))
    full = score[lead] + (x[np.ix_(at[lead], order[head:])] - shift[head:]) @ q[head:]
    threshold = max(first, np.partition(full, len(full) - k)[len(full) - k])
    for j in range(head, len(q), STEP):
        alive = score + rest[j] >= threshold
        at, score = at[alive], score[alive]
        span = order[j:j + STEP]
        score = score + (x[np.ix_(at, span)] - shift[j:j + STEP]) @ q[j:j + STEP]
    alive = score >= threshold
    return at[alive], score[alive]


def best(q: np.ndarray, x: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[list[int], list[int]]:
    """Ids and scores of the k best rows of ``x`` whose id is not ``own``, by score, then id."""
    allowed = ids != own
    if not allowed.any():
        return [], []
    if _exact(q, x):
        at, score = max_score(q, x, allowed, k)
        first = np.lexsort((ids[at], -score))[:k]
        return ids[at][first].tolist(), score[first].astype(np.int64).tolist()
    whole = [int(v) for v in q]   # beyond doubles: Python's whole numbers
    sums = [(-sum(a * int(b) for a, b in zip(whole, row, strict=True)), i)
            for row, i, ok in zip(x, ids.tolist(), allowed, strict=True) if ok]
    first = sorted(sums)[:k]
    return [i for _, i in first], [max(_LONG.min, min(_LONG.max, -s)) for s, _ in first]


def _search(k: int, scale: float):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"quid": [], "query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            both = whole_components(left.column("v").to_pylist() + right.column("v").to_pylist(), scale)
            qs, x = both[:left.num_rows], both[left.num_rows:]
            ids = right.column("id").to_numpy()
            for q, qid, quid in zip(qs, left.column("id").to_pylist(), left.column("quid").to_pylist(), strict=True):
                found, scores = best(q, x, ids, qid, k)
                out["quid"] += [quid] * len(found)
                out["query_id"] += [qid] * len(found)
                out["vec_id"] += found
                out["score"] += scores
        return pa.table({c: pa.array(v, type=pa.int64()) for c, v in out.items()})
    return run


def search(df: DataFrame, id_col: str, vector_col: str, is_query: Column, k: int = 5,
           scale: float = 256.0, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of ``df`` for each row that ``is_query`` admits."""
    bad = F.exists(quoted(vector_col), lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    usable = df.where(quoted(id_col).isNotNull() & quoted(vector_col).isNotNull() & ~bad)
    rows = usable.select(quoted(id_col).cast("long").alias("id"), quoted(vector_col).alias("v"))
    queries = (usable.where(is_query).select(quoted(id_col).cast("long").alias("id"), quoted(vector_col).alias("v"))
               .dropDuplicates(["id", "v"]))
    shards = max(1, -(-rows.count() // shard))
    blocks = max(1, -(-queries.count() // block))
    number = F.monotonically_increasing_id()
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = (queries.withColumn("quid", F.xxhash64("id", "v"))
            .withColumn("block", F.pmod("quid", F.lit(blocks)).cast("int")).withColumn("shard", each(shards)))
    # the partition number is part of the row number: mix it, so that small partitions spread too
    right = (rows.withColumn("shard", F.pmod(F.xxhash64(number), F.lit(shards)).cast("int"))
             .withColumn("block", each(blocks)))
    found = (left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block"))
             .applyInArrow(_search(k, scale), "quid long, query_id long, vec_id long, score long"))
    best_first = W.partitionBy("query_id", "quid").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
