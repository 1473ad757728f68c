import base64
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tributary.llm import dart, gam, mixing, neardup, rules
from tributary.llm.common import crc_mod, write_out
from tests.conftest import SF_MID


@pytest.fixture(scope="module")
def steps(spark):
    """Rows before and after each stage."""
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = write_out(spark, stage(spark, docs, SF_MID), f"test-{name}")
        out.append(docs)
    return out


def ids(df):
    return [r.doc_id for r in df.select("doc_id").collect()]


def test_stages_in_order(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "near_dedup", "mixing", "bpe"]
    for df in steps[:-1]:
        assert df.columns == steps[0].columns


def test_classifier_keeps_what_its_model_accepts(spark, steps):
    docs = steps[0]
    model = gam.train(docs, spark.read.parquet(f"{SF_MID}/labels.parquet"), "quality", crc_mod(F.col("doc_id"), 5) != 0)
    want = [r.doc_id for r in docs.collect() if model.score(gam._rows([r.text]))[0] >= 0.3]
    assert sorted(want) == sorted(ids(steps[1]))


def test_rules_keep_what_they_judge_good(steps):
    assert sorted(ids(rules.judge(steps[1]).where("kept"))) == sorted(ids(steps[2]))


def test_one_document_of_each_class_stays(steps):
    before = {r.doc_id: dart.units(r.text) for r in steps[2].collect()}
    kept = set(ids(steps[3]))
    units = list(before.items())
    parent = {i: i for i in before}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (i, a) in enumerate(units):
        for j, b in units[:k]:
            if min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and dart.similarity(a, b) >= 0.8:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    assert kept == {find(i) for i in before}


def test_mix_takes_what_is_counted(steps):
    want = Counter()
    for r in mixing.taken(steps[3]).collect():
        want[r.doc_id] += r.copies
    assert Counter(ids(steps[4])) == +want


def test_ids_are_the_library_s(steps):
    path = public_tokenizers.path(corpus_pipeline.VOCAB)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in steps[4].collect()}
    rows = steps[5].collect()
    assert len(rows) == steps[4].count()
    for r in rows:
        assert r.round_trip and list(r.ids) == library.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids)


def test_empty_and_odd_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, extra int"
    good = " ".join(f"word{i} other{i * i}" for i in range(60)) + "."
    rows = [(None, None, None, None, None, 1), (1, good, "en", None, 1, 2), (1, good, "en", None, 1, 2), (2, "", "en", "s", 0, 3)]
    for data, least in ((rows, 1), ([], 0)):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES[1:]:
            docs = write_out(spark, stage(spark, docs, SF_MID), f"odd-{name}")
        assert docs.count() >= least and set(ids(docs)) <= {1}


def test_run_is_the_stages_in_turn(spark, steps):
    out = corpus_pipeline.run(spark, SF_MID)
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "round_trip"]
    assert sorted(ids(out)) == sorted(ids(steps[5]))
    assert neardup.THRESHOLD == 0.8
