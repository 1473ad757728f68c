import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tributary.llm import neardup, ngramjoin, pairs, queries
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string"


def plain_set(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(w[i:i + 3]) for i in range(max(len(w) - 2, 1))} if w else set()


def brute(rows, percent=90):
    sets = [plain_set(t) for _, t in rows]
    by = {}
    for k, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(k)
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        for j in {j for x in s for j in by[x] if j < i}:
            if 100 * len(s & sets[j]) >= percent * len(s | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(sets[k]), least.get(find(k))) for k, (i, _) in enumerate(rows)), key=str)


def run(spark, rows, percent=90, extra=()):
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(1).alias(c) for c in extra])
    out = ngramjoin.assign(df, percent=percent)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted(map(tuple, out.collect()), key=str)


def words(rng, n, of=2000):
    return [f"w{rng.randrange(of)}" for _ in range(n)]


def corpus(seed):
    rng = random.Random(seed)
    texts = []
    for n in (5, 12, 30, 80, 200, 500):                     # families whose similarity lies around the threshold
        base = words(rng, n)
        for k in range(14):
            w = list(base)
            for _ in range(rng.randrange(1 + n // 40 + k % 3)):
                w[rng.randrange(n)] = f"new{rng.randrange(10 ** 6)}"
            texts.append(" ".join(w + words(rng, rng.randrange(1 + n // 20))))
    passage = words(rng, 60)
    texts += [" ".join(passage + words(rng, 5 + k)) for k in range(40)]
    chain = words(rng, 150)
    for k in range(20):                                     # each like the one before, the first unlike the last
        chain[k * 7] = f"step{k}"
        texts.append(" ".join(chain))
    texts += ["same words here", "Same  WORDS\there", "same words", "words", "Ä ä É", "ä ä é", "x " * 50, "x " * 3]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("percent", [90, 70])
def test_equals_all_pairs(spark, percent):
    rows = corpus(5)
    assert run(spark, rows, percent) == brute(rows, percent)


def test_small_blocks_and_groups_lose_nothing(spark, monkeypatch):
    """Every long list goes through blocks; stars are kept from linking first."""
    monkeypatch.setattr(ngramjoin, "BLOCK", 3)
    monkeypatch.setattr(ngramjoin, "GROUP_ROWS", 10)
    monkeypatch.setattr(ngramjoin, "matching", lambda *a: pairs.matching(*a, cell=200))
    rows = corpus(6)
    assert run(spark, rows, 80) == brute(rows, 80)


@pytest.mark.parametrize("high", [0, 1])
def test_a_dense_group_gives_out_fewer_pairs_than_components(high):
    n = 60
    rng = np.random.default_rng(1)
    counts = rng.integers(3, 5, (n, ngramjoin.RANGES)).astype(np.uint8)
    size = int(counts.sum(axis=1).max())
    rows = pa.table({"part": [7] * n, "low": [0] * n, "high": [high] * n, "block": [k % (high + 1) for k in range(n)],
                     "token": [k // 30 for k in range(n)], "node": list(range(n)), "root": list(range(n)),
                     "size": pa.array([4 * size] * n, type=pa.int32()), "pos": pa.array([0] * n, type=pa.int32()),
                     "counts": [c.tobytes() for c in counts]})
    every, some = (ngramjoin._open_pairs(90, forest)(rows).to_pylist() for forest in (False, True))
    assert len(every) == (450 if high else 870)
    assert len(some) == 58                       # two lists of 30 texts: a tree of each
    left = {frozenset((p["a"], p["b"])): p["apart"] for p in every}
    tree = list(range(n))
    for pair, _ in sorted(left.items(), key=lambda x: x[1]):
        a, b = (tree[k] for k in pair)
        tree = [a if t == b else t for t in tree]
    assert {frozenset((p["a"], p["b"])) for p in some} <= set(left) and len(set(tree)) == 2
    least = lambda pairs, k: min(p["apart"] for p in pairs if k in (p["a"], p["b"]))
    assert all(least(some, k) == least(every, k) for k in range(n))


def test_texts_with_few_shared_shingles_are_out_before_any_join(spark):
    rng = random.Random(7)
    passage = " ".join(words(rng, 30))
    docs = spark.createDataFrame([(i, passage + " " + " ".join(words(rng, 300, 10 ** 6))) for i in range(60)], SCHEMA)
    keyed = docs.select(ngramjoin.node_key(F.col("text")).alias("key"), "text")
    made = keyed.mapInArrow(ngramjoin._sketched(90), "key binary, size int, ranked array<long>, more array<long>, counts binary")
    assert ngramjoin.prefixes(made.withColumn("node", F.xxhash64("key")), 90).count() == 0


def test_odd_rows(spark):
    long = " ".join(words(random.Random(8), 400_000, 10 ** 6))
    rows = [(None, "alpha beta gamma delta"), (None, "alpha beta gamma delta"), (9, "Alpha beta gamma delta"),
            (1, None), (2, ""), (3, " \n\t\x0b\x0c\r"), (4, "one two"), (5, "ONE two"), (5, "other text of words"),
            (6, "one"), (None, "alone without an id here"), (7, long), (8, long + " tail"), (8, long)]
    assert run(spark, rows, extra=["node", "key", "size", "token", "root", "__k", "__n", "__r", "n", "a.b"]) == brute(rows)
    assert run(spark, []) == [] and run(spark, [(1, None)]) == [(1, 0, 1)]


def test_sets_of_long_texts_do_not_depend_on_pieces(monkeypatch):
    text = " ".join(words(random.Random(9), 3000)) + " " + "y" * 5000 + " end"
    whole = ngramjoin.shingle_set(text)
    monkeypatch.setattr(ngramjoin, "PIECE", 100)
    assert np.array_equal(ngramjoin.shingle_set(text), whole) and len(whole) == len(plain_set(text))


def test_bounds_of_the_filters():
    for percent in (50, 70, 90, 100):
        for a in range(1, 60):
            for b in range(a, 80):
                least = ngramjoin.needed(a, b, percent)
                assert 100 * least >= percent * (a + b - least) and 100 * (least - 1) < percent * (a + b - least + 1)
            assert ngramjoin.prefix_length(a, percent) == a - -(-percent * a // 100) + 1
    assert neardup.THRESHOLD == 0.8


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    want = con.sql(queries.ORACLE_SQL["op13_ngramjoin"])
    got = queries.QUERIES["op13_ngramjoin"](spark, SF_SMALL)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
