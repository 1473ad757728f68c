import base64

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tributary.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = ["hello wor  ld  \n\n x'll don't " * 40, None, "", " ", "a" * 3000 + " b", "é😀 " * 700, "é😀 " * 700,
         " " * 2000 + "x", "12345 678\t\t\n", "<|endoftext|>"]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("chunk, overlap", [(50, 10), (37, 5), (64, 3), (16_384, 1_024)])
def test_ids_equal_the_library_and_decode_to_the_text(spark, library, chunk, overlap):
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(TEXTS)], "doc_id long, text string, ids int")
    rows = bpe.decode(bpe.encode(docs, "text", PATH, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap),
                      "ids", PATH).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(TEXTS)))
    for r in rows:
        assert list(r.ids) == library.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()


def test_very_long_text_in_many_chunks(spark, library):
    text = "".join(f"word{i} été {'x' * (i % 90)}\n" for i in range(30_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = bpe.encode(docs, "text", PATH, public_tokenizers.PATTERN).first()
    assert list(row.ids) == library.encode_ordinary(text)


def test_empty_table_and_other_column_names(spark):
    docs = spark.createDataFrame([], "`a.b` string, uid long, text string")
    out = bpe.encode(docs, "text", PATH, public_tokenizers.PATTERN)
    assert out.columns == ["a.b", "uid", "text", "ids"] and out.count() == 0


def test_unknown_id_raises(spark):
    bad = spark.createDataFrame([([10 ** 6],)], "ids array<int>")
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(bad, "ids", PATH).select(F.length("decoded")).collect()


def test_helper_names_may_be_columns(spark, library):
    names = ["__ids", "__raw", "__uid", "__key", "uid", "a.b"]
    texts = ["short one", "long " * 60]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").select(
        "*", *[F.lit(i).alias(c) for i, c in enumerate(names)])
    out = bpe.decode(bpe.encode(docs, "text", PATH, public_tokenizers.PATTERN, chunk=50, overlap=10), "ids", PATH)
    assert out.columns == [*docs.columns, "ids", "decoded"]
    for r in out.collect():
        assert bytes(r.decoded).decode() == r.text and all(r[c] == i for i, c in enumerate(names))


@pytest.mark.parametrize("chunk, overlap", [(50, 10), (16_384, 1_024)])
def test_both_in_one_worker_equal_both_in_turn(spark, chunk, overlap):
    names = ["__raw", "decoded", "a.b"]
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").select(
        "*", *[F.lit(i).alias(c) for i, c in enumerate(names)])
    args = docs, "text", PATH, public_tokenizers.PATTERN, "ids", chunk, overlap
    one, two = bpe.encode(*args, decoded_col="decoded"), bpe.decode(bpe.encode(*args), "ids", PATH)
    assert one.columns == ["doc_id", "text", "__raw", "a.b", "ids", "decoded"] and set(one.columns) == set(two.columns)
    assert sorted(map(str, one.collect())) == sorted(map(str, two.select(*[f"`{c}`" for c in one.columns]).collect()))


def test_a_pipeline_task_needs_one_worker(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(1, "a text", "en", "s")], "doc_id long, text string, lang string, source string")
    plan = corpus_pipeline.bpe_encode(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    above, _, branches = plan.partition("Union")
    assert "InArrow" not in above and branches.count("MapInArrow") == 3
