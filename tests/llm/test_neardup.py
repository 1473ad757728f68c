import random

import numpy as np

from tributary.llm import dart, neardup

SCHEMA = "doc_id long, text string, class_id int"


def brute(rows):
    """Least id of each row's class, by comparing all pairs of different texts."""
    texts = {t for _, t in rows if (t or "").split()}
    units = {t: dart.units(t) for t in texts}
    parent = {t: t for t in texts}

    def find(t):
        while parent[t] != t:
            t = parent[t]
        return t

    ordered = sorted(texts)
    for i, a in enumerate(ordered):
        for b in ordered[:i]:
            if dart.similarity(units[a], units[b]) >= 0.8:
                parent[find(a)] = find(b)
    least = {}
    for i, t in rows:
        if t in parent and i is not None:
            least[find(t)] = min(i, least.get(find(t), i))
    return [(i, least.get(find(t)) if t in parent else i) for i, t in rows]


def words(rng, n):
    return ["".join(rng.choices("abcdefgh", k=4)) for _ in range(n)]


def corpus():
    rng = random.Random(4)
    rows, n = [], 0
    passage = words(rng, 60)
    base = words(rng, 200)
    for k in range(40):                       # near copies of one text, each with its own change
        w = list(base)
        for _ in range(k % 4 + 1):
            w[rng.randrange(200)] = f"new{rng.random()}"
        rows.append((n := n + 1, " ".join(w)))
    for k in range(30):                       # texts that share a passage only
        rows.append((n := n + 1, " ".join(passage + words(rng, 30 + k))))
    chain = words(rng, 120)
    for k in range(12):                       # each like the one before, the first unlike the last
        chain[k * 8] = f"step{k}"
        rows.append((n := n + 1, " ".join(chain)))
    rows += [(n + 1 + i, "short one") for i in range(5)] + [(n + 20, "short two"), (n + 21, "x " * 300),
                                                          (n + 22, "x " * 290), (n + 23, "x " * 30)]
    return rows + [(n + 30, None), (n + 31, ""), (n + 32, " \n"), (None, "only null id"), (n + 40, " ".join(base))] * 2


def test_classes_equal_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 7) for i, t in rows], SCHEMA)
    got = neardup.assign(docs).collect()
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(((r.doc_id, r.class_id) for r in got), key=key) == sorted(brute(rows), key=key)


def test_open_buckets_are_settled_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 3)
    rows = corpus()
    got = neardup.assign(spark.createDataFrame([(i, t, 7) for i, t in rows], SCHEMA)).collect()
    assert {(r.doc_id, r.class_id) for r in got} == set(brute(rows))


def test_keep_one_row_of_each_class(spark):
    rows = corpus()
    kept = neardup.keep_one(spark.createDataFrame([(i, t, 7) for i, t in rows], SCHEMA))
    assert kept.columns == ["doc_id", "text", "class_id"]
    ids = [r.doc_id for r in kept.collect()]
    classes = dict(brute(rows))
    blank = [i for i, t in rows if not (t or "").split()]
    assert sorted(str(i) for i in ids) == sorted(
        [str(i) for i in {classes[i] for i in classes if i not in blank}] + [str(i) for i in blank])


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert neardup.assign(docs).count() == 0 and neardup.keep_one(docs).count() == 0


def test_signatures_agree_as_often_as_texts_are_alike():
    rng, gaps = random.Random(8), []
    for n in (8, 60, 400, 3000):
        for _ in range(15):
            a = words(rng, n)
            b = [w if rng.random() > 0.03 else "z" for w in a]
            a, b = " ".join(a + a[: n // 2]), " ".join(b)
            gaps.append((dart.signature(dart.shingles(a)) == dart.signature(dart.shingles(b))).mean()
                        - dart.similarity(dart.units(a), dart.units(b)))
    assert abs(np.mean(gaps)) < 0.01 and np.abs(gaps).max() < 0.13


def test_weights_count():
    a, b = dart.units("x y " * 200), dart.units("x y " * 230)
    assert dart.similarity(a, b) == 396 / 456 and dart.similarity(a, a) == 1
    assert dart.similarity(dart.units(""), a) == 0 and len(dart.shingles("one two")) == 1


def test_helper_names_may_be_columns(spark):
    from pyspark.sql import functions as F
    names = ["node__r", "least__r", "is_first__r", "copies__r", "__node", "__key", "__first", "__least", "__copies", "a.b"]
    rows = [(1, "one two three four five six"), (2, "one two three four five six"), (3, None), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(4).alias(c) for c in names])
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 3]
    assert sorted(map(tuple, neardup.assign(docs).collect())) == [(1, 1, 2), (2, 1, 2), (3, 3, 1), (3, 3, 1)]


def test_very_long_texts(spark):
    rng = random.Random(9)
    long = " ".join(words(rng, 300_000))
    docs = spark.createDataFrame([(1, long), (2, long + " end"), (3, " ".join(words(rng, 300_000)))], "doc_id long, text string")
    assert sorted((r.doc_id, r.class_id) for r in neardup.assign(docs).collect()) == [(1, 1), (2, 1), (3, 3)]


def test_recall_on_the_given_documents(spark):
    """Classes of all documents against all links of 0.8, found by comparing every two texts that share a shingle."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    units = {t: dart.units(t) for _, t in rows if (t or "").split()}
    by = {}
    for t, u in units.items():
        for x in u.tolist():
            by.setdefault(x, []).append(t)
    pairs = {(a, b) for ts in by.values() if len(ts) < 200 for i, a in enumerate(ts) for b in ts[:i]}
    links = [(a, b) for a, b in pairs if dart.similarity(units[a], units[b]) >= 0.8]
    got = neardup.assign(spark.createDataFrame(rows, "doc_id long, text string"))
    of_text = {t: c for (_, t), c in zip(sorted(rows), [r.class_id for r in got.orderBy("doc_id").collect()])}
    assert links and all(of_text[a] == of_text[b] for a, b in links)


def test_rows_that_keep_all_are_not_shuffled(spark, capsys):
    docs = spark.createDataFrame([(i, t, 7) for i, t in corpus()], SCHEMA)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        neardup.keep_one(docs).explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    branches = capsys.readouterr().out.split("\n   :- ")      # of the union of the kept rows
    assert "Scan" in branches[1] and "Exchange hashpartitioning" not in branches[1]
    assert "BroadcastHashJoin" in branches[1]


def test_nodes_that_share_a_bit_by_chance(spark, monkeypatch):
    """So few bits that most rows are marked: what is kept is the same, with repeated rows and null ids."""
    rows = corpus() + [(i, f"text number {i} stands alone here") for i in range(1000, 1040)] * 2
    docs = spark.createDataFrame([(i, t, 7) for i, t in rows], SCHEMA)
    want = sorted(map(str, neardup.keep_one(docs).collect()))
    monkeypatch.setattr(neardup, "MARKS", 8)
    assert sorted(map(str, neardup.keep_one(docs).collect())) == want
    alone = [r for r in want if "stands alone" in r]
    assert len(alone) == 40
    monkeypatch.setattr(neardup, "MARKS", 1)
    assert sorted(map(str, neardup.keep_one(docs).collect())) == want


def test_arrow_batches_of_long_texts_are_bounded(spark):
    def sizes(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    texts = spark.range(0, 4000, 1, 1).selectExpr("repeat('eight by', 400) AS t")
    assert max(r.n for r in texts.mapInArrow(sizes, "n long").collect()) <= 5 << 20


def test_buckets_are_dealt_out_once(spark, monkeypatch):
    """The members of all buckets pass one exchange, by short numbers; signatures of nodes in no open bucket none."""
    plans = {}

    def write_out(session, df, purpose, write=neardup.write_out):
        plans.setdefault(purpose, df._jdf.queryExecution().executedPlan().toString())
        return write(session, df, purpose)

    monkeypatch.setattr(neardup, "write_out", write_out)
    confs = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        rows = [(i, f"one two three four five six {'same ' * 40} {i % 3}", 7) for i in range(9)]
        neardup.assign(spark.createDataFrame(rows, SCHEMA)).count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    dealt = [x for x in plans["near-members"].splitlines() if "Exchange hashpartitioning(bucket" in x]
    assert sum("ReusedExchange" not in x for x in dealt) == 1
    assert "BroadcastHashJoin" in plans["near-pairs"]      # the bitmap: joins of tables are not broadcast here
