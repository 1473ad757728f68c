import re
from collections import Counter

from pyspark.sql import functions as F

from tributary.llm import rules


def brute(text):
    """The base counts by plain loops."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    count = Counter(windows)
    covered = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))


TEXTS = [None, "", " \n\t\x0b ", "one", "a b\n\na b\n a b", "é ß 😀 # * $%&|<>", "x " * 7, "x " * 8, "x " * 9, "x " * 50,
         " ".join(map(str, range(40))) + " " + " ".join(map(str, range(10))) + " end " + " ".join(map(str, range(30, 40))),
         "a\u00a0b c\u2003d", "l\r\nl\r\n", "w" * 5000, " ".join(str(i % 701) for i in range(30_000))]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept int, `x.y` int")


def test_counts_equal_brute_force(spark):
    docs = frame(spark, [(i, t, "en", "s", 1, 2) for i, t in enumerate(TEXTS)])
    for r in rules.judge(docs).collect():
        assert tuple(r[c] for c in rules.COUNTS) == brute(r.text), repr(r.text)[:80]
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)


def test_extra_and_clashing_columns_nulls_and_repeated_rows(spark):
    row = (None, "some words here " * 10, None, None, 5, 7)
    out = rules.judge(frame(spark, [row, row, (1, None, None, "s", 0, 0)]))
    assert out.columns == ["doc_id", "text", "lang", "source", "x.y", *rules.COUNTS, "base_failed", "kept"]
    assert out.count() == 3 and out.where("kept").count() == 0        # all repeat or are empty
    assert rules.judge(frame(spark, [])).count() == 0
    assert rules.judge(frame(spark, [row])).where("n_repeat_words > 3").count() == 1     # a filter from outside


def test_thresholds_follow_their_group(spark):
    word = lambda i: f"w{i}x{i * 7 % 101}"
    plain = [(i, " ".join(word(i * 50 + j) for j in range(40)), "en", "a", 0, 0) for i in range(60)]
    marked = [(100 + i, " ".join(word(i * 50 + j) + "#" * (j % 2) for j in range(40)), "en", "b", 0, 0) for i in range(60)]
    odd = [(200, " ".join(word(j) + "#" * (j % 2) for j in range(9000, 9040)), "en", "a", 0, 0)]
    kept = {r.doc_id for r in rules.judge(frame(spark, plain + marked + odd)).where("kept").collect()}
    assert kept == {r[0] for r in plain + marked}       # marks are usual in b, not in a


def test_sketches_merge(spark):
    docs = rules.counted_rows(frame(spark, [(i, f"w{i} " * (i % 30 + 1), "en", f"s{i % 3}", 0, 0) for i in range(300)]))
    whole = rules.sketches(docs, "lang", "source")
    halves = rules.sketches(docs.where("doc_id % 2 = 0"), "lang", "source").unionAll(
        rules.sketches(docs.where("doc_id % 2 = 1"), "lang", "source"))
    merged = halves.groupBy("lang", "source", "signal", "bucket").agg(F.sum("n").alias("n"))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, merged.collect()))


def test_bucket_error_bound(spark):
    values = spark.range(0, 100_000, 37).select("id", rules.bucket(F.col("id")).alias("b"))
    assert values.where("b > id OR id - b > id / 64").count() == 0


def test_helper_names_may_be_columns(spark):
    names = ["symbols_high", "chars_low", "__lang", "__source", "__symbols_high", "__words", "signal", "n", "s"]
    docs = frame(spark, [(1, "some plain words " * 3, "en", "a", 0, 0)]).select(
        "doc_id", "text", "lang", "source", *[F.lit(7).alias(c) for c in names])
    out = rules.judge(docs)
    assert out.columns == [*docs.columns, *rules.COUNTS, "base_failed", "kept"]
    assert [out.collect()[0][c] for c in names] == [7] * len(names)


def test_no_text_is_shuffled(spark):
    """Thresholds are known to be small when they join, whatever the size of the input."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "200k")
    try:
        docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
        plan = rules.judge(docs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
