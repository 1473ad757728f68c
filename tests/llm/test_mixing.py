from collections import Counter, defaultdict

import pytest

from tributary.llm import mixing

SCHEMA = "doc_id long, text string, source string, size int"


def water_fill(sizes):
    """Targets by sharing again and again."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    budget, capped = 1.5 * sum(sizes.values()), set()
    while True:
        open_ = [s for s in order if s not in capped]
        rest = budget - sum(2 * sizes[s] for s in capped)
        total = sum(weight[s] for s in open_)
        share = {s: rest * weight[s] / total for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            return {s: 2 * sizes[s] if s in capped else share[s] for s in order}
        capped |= over


def corpus(n=900):
    rows = [(i, "w " * (i * 7 % 23 + 1) + f"t{i}", f"s{min(i % 7, 4)}", 0) for i in range(n)]
    return rows + [(None, "n u l l", None, 1), (None, None, None, 1), (5000, "", "s1", 2)] + [(6000, "r r r", "s2", 3)] * 5


def test_targets_sums_and_limits(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    rows = mixing.taken(docs).collect()
    assert Counter((r.doc_id, r.size) for r in rows) == Counter(
        (i, len((t or "").split())) for i, t, _, _ in corpus())
    sizes, taken, source = defaultdict(int), defaultdict(int), {}
    for i, t, s, _ in corpus():
        sizes[s] += len((t or "").split())
        source[i] = s
    want = water_fill(sizes)
    for r in rows:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.copies <= 2
        taken[s] += r.copies * r.size
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 25        # less than one document


def test_reruns_and_other_partitions_agree(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    key = lambda df: sorted((str(r.doc_id), r.size, r.copies) for r in mixing.taken(df).collect())
    assert key(docs) == key(docs.repartition(13)) == key(docs.coalesce(1))


def test_mix_repeats_rows_as_counted(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA).withColumnRenamed("size", "n_rows")
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    counted = Counter()
    for r in mixing.taken(docs).collect():
        counted[(r.doc_id, r.size)] += r.copies
    got = Counter((r.doc_id, len((r.text or "").split())) for r in mixed.collect())
    assert got == +counted


def test_empty_tables_and_no_words(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mixing.taken(docs).count() == 0 and mixing.mix(docs).count() == 0
    blank = spark.createDataFrame([(1, None, "a", 0), (2, " ", None, 0)], SCHEMA)
    assert [(r.size, r.target, r.copies) for r in mixing.taken(blank).collect()] == [(0, 0.0, 0)] * 2


def test_expectation_is_fair(spark):
    """Over many documents of equal size the share taken is the target's share."""
    docs = spark.createDataFrame([(i, f"a b c d{i}", "x" if i % 3 else "y", 0) for i in range(3000)], SCHEMA)
    by = defaultdict(list)
    for r in mixing.taken(docs).collect():
        by[r.source_size].append((r.copies, r.target / r.source_size))
    for found in by.values():
        assert sum(c for c, _ in found) == pytest.approx(found[0][1] * len(found), abs=1.01)


def test_helper_names_may_be_columns_and_long_texts(spark):
    from pyspark.sql import functions as F
    names = ["n_rows__r", "copies__r", "copy__r", "n_rows", "copies", "times", "in0", "fp", "size", "a.b", "__doc_id"]
    rows = [(1, "w " * 200_000, "a"), (2, "x y", "a"), (2, "x y", "a"), (3, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").select(
        "*", *[F.lit(i).alias(c) for i, c in enumerate(names)])
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    got = Counter(r.doc_id for r in mixed.collect())
    want = Counter()
    for r in mixing.taken(docs).collect():
        want[r.doc_id] += r.copies
    assert got == +want and all(r[c] == i for r in mixed.collect() for i, c in enumerate(names))


def test_rounding_equals_a_plain_reduction(spark):
    """Whatever the order of meetings: words are neither made nor lost, every document gets the whole part or one more, and
    a document's copies are fair over many sources of the same make-up."""
    sizes = [5, 3, 8, 1, 7, 2]
    rows = [(s * 10 + i, "w " * n + f"t{s}", f"s{s:04d}") for s in range(300) for i, n in enumerate(sizes)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.taken(docs).collect()
    by_place = defaultdict(list)
    for r in out:
        want = r.target / r.source_size
        assert int(want) <= r.copies <= int(want) + 1
        by_place[r.doc_id % 10].append(r.copies - want)
    assert all(abs(sum(v) / len(v)) < 0.12 for v in by_place.values())
    taken, target = defaultdict(int), {}
    for r in out:
        taken[r.doc_id // 10] += r.copies * r.size
        target[r.doc_id // 10] = r.target
    assert all(abs(taken[s] - target[s]) <= max(sizes) + 1 for s in taken)
