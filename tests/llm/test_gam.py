import numpy as np
import zlib
from pyspark.sql import functions as F

from tributary.llm import gam, queries
from tributary.llm.common import crc_mod
from tests.conftest import SF_MID


def test_additive_and_pair_effects_are_learned():
    rng = np.random.default_rng(0)
    x = rng.random((4000, len(gam.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)      # only a pair can tell
    model = gam.fit(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95


def test_no_rows_or_one_class_give_the_prior():
    assert set(gam.fit(np.zeros((0, 11)), np.zeros(0)).score(np.zeros((3, 11)))) == {0.5}
    assert len(set(gam.fit(np.ones((5, 11)), np.ones(5)).score(np.random.rand(4, 11)))) == 1


def test_features_of_odd_texts():
    assert gam.features(None) == gam.features("") == gam.features(" \n\t") == [0.0] * len(gam.FEATURES)
    assert all(np.isfinite(gam.features("\ud800 x".encode("utf-8", "replace").decode()))) and \
        all(np.isfinite(gam.features("word " * 200_000)))


def test_training_with_nulls_repeats_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d", 0), (1, "a b c d", 0), (2, None, 1), (None, "x", 2), (3, "# # #", 3)],
                                 "doc_id long, text string, label int")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1), (3, None), (3, 0)], "doc_id long, quality int")
    model = gam.train(docs, labels, "quality", F.lit(True))
    scored = docs.select("doc_id", gam.score_column(model, F.col("text")).alias("s")).collect()
    assert len(scored) == 5 and all(0 <= r.s <= 1 for r in scored)
    assert gam.train(docs, labels.limit(0), "quality", F.lit(True)).score(np.zeros((1, 11)))[0] == 0.5
    assert docs.limit(0).select(gam.score_column(model, F.col("text"))).count() == 0


def test_query_holds_out_every_fifth_and_is_accurate(spark):
    rows = queries.QUERIES["op8_quality"](spark, SF_MID).collect()
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95


def test_held_out_labels_do_not_change_scores(spark, tmp_path):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    other = labels.withColumn("quality", F.when(crc_mod(F.col("doc_id"), 5) == 0, 1 - F.col("quality"))
                              .otherwise(F.col("quality")))
    a, b = (gam.train(docs, x, "quality", crc_mod(F.col("doc_id"), 5) != 0) for x in (labels, other))
    x = np.random.default_rng(1).random((50, 11))
    assert np.array_equal(a.score(x), b.score(x))


def test_scores_equal_a_plain_sum_of_looked_up_numbers(spark):
    rng = np.random.default_rng(3)
    model = gam.fit(rng.random((300, len(gam.FEATURES))) * 5, rng.integers(0, 2, 300).astype(float))
    texts = [None, "", "A b!", "# # # 12", "word " * 900, "One line.\nOne line.\n"] + [f"text {i} of many" for i in range(700)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(1)

    def plain(text):
        x = gam.features(text)
        at = [sum(v >= e for e in edges) for v, edges in zip(x, model.edges)]
        z = model.base + sum(t[b] for t, b in zip(model.tables, at)) + sum(t[at[i], at[j]] for i, j, t in model.pairs)
        return 1 / (1 + np.exp(-z))

    got = {r.doc_id: r.s for r in docs.select("doc_id", gam.score_column(model, F.col("text")).alias("s")).collect()}
    assert np.allclose([got[i] for i in range(len(texts))], [plain(t) for t in texts], atol=1e-12)
