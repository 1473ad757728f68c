"""Registered text queries: word counting, tokenizing, case mapping, lookup."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import functions as F

from tributary.functions.text import upper
from tributary.functions.user import flat_map
from tributary.operators import wordcount as wc
from tributary.plans.registry import REGISTRY, register
from tributary.sources.tables import read_table

# Words asked for by the lookup queries (two frequent words and one that never
# occurs, which must come back with a null count).
LOOKUP_WORDS = ("the", "and", "zzqxj")


def _text_of(spark, sf_dir, table="documents", cols=("doc_id", "text")):
    return read_table(spark, sf_dir, table).select(*cols)


@register("word_count", """
SELECT word, count(*) AS cnt
FROM (SELECT unnest(regexp_split_to_array(lower(text), '\\W+')) AS word FROM documents)
WHERE length(word) > 0
GROUP BY word
""", ("documents",))
def q_word_count(spark, sf_dir):
    """Bounded word count over every document (P2+F4+A1)."""
    return wc.word_count(_text_of(spark, sf_dir).select("text"))


@register("tokenize", """
WITH a AS (SELECT doc_id, regexp_split_to_array(lower(text), '\\W+') AS arr FROM documents),
t AS (SELECT doc_id, arr, unnest(range(len(arr))) AS pos FROM a)
SELECT doc_id, pos, arr[pos + 1] AS word, 1 AS one FROM t WHERE length(arr[pos + 1]) > 0
""", ("documents",))
def q_tokenize(spark, sf_dir):
    """(doc_id, pos, word, 1) for every word of every document (P2+F4)."""
    docs = _text_of(spark, sf_dir).select("doc_id", "text")
    return wc.tokenize(docs, keep=("doc_id",))


@register("word_uppercase", """
SELECT doc_id, upper(replace(text, 'ß', 'SS')) AS text_upper FROM documents
""", ("documents",))
def q_word_uppercase(spark, sf_dir):
    """Upper-case every record (P1).  Java/Spark map 'ß' to 'SS'."""
    docs = _text_of(spark, sf_dir)
    return docs.select("doc_id", upper(F.col("text")).alias("text_upper"))


@register("word_lookup", f"""
WITH counts AS (
  SELECT word, count(*) AS cnt
  FROM (SELECT unnest(regexp_split_to_array(lower(text), '\\W+')) AS word FROM documents)
  WHERE length(word) > 0 GROUP BY word),
keys AS (SELECT unnest([{", ".join(repr(w) for w in LOOKUP_WORDS)}]) AS word)
SELECT keys.word, counts.cnt FROM keys LEFT JOIN counts ON keys.word = counts.word
""", ("documents",))
def q_word_lookup(spark, sf_dir):
    """Point lookups of word counts (Q1); unknown words give null."""
    counts = wc.word_count(_text_of(spark, sf_dir).select("text"))
    keys = spark.createDataFrame([(w,) for w in LOOKUP_WORDS], "word string")
    return wc.lookup_words(counts, keys)


@register("word_count_running", f"""
WITH a AS (SELECT conv_id, turn, regexp_split_to_array(lower(text), '\\W+') AS arr FROM conversations),
t AS (SELECT conv_id, turn, unnest(range(len(arr))) AS pos, arr FROM a),
w AS (SELECT conv_id, turn, pos, arr[pos + 1] AS word FROM t WHERE length(arr[pos + 1]) > 0)
SELECT conv_id, turn, pos, word,
       count(*) OVER (PARTITION BY word ORDER BY conv_id, turn, pos
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_count
FROM w
""", ("conversations",))
def q_word_count_running(spark, sf_dir):
    """Running word count, one updated row per word occurrence (A2),
    ordered by (conv_id, turn, pos)."""
    conv = _text_of(spark, sf_dir, "conversations", ("conv_id", "turn", "text"))
    return wc.word_count_running(conv, ["conv_id", "turn"])


def _words(batch: pa.RecordBatch):
    """A user's flat map: the words of a batch of texts, each with a one."""
    words = [w for text in batch.column(0).to_pylist() for w in re.split(r"\W+", (text or "").lower(), flags=re.ASCII) if w]
    yield pa.table({"word": pa.array(words, pa.string()), "one": pa.array([1] * len(words), pa.int32())})


@register("word_count_user", REGISTRY["word_count"].sql, ("documents",))
def q_word_count_user(spark, sf_dir):
    """A1 with the tokenizer as a user's table function over Arrow batches."""
    words = flat_map(_text_of(spark, sf_dir).select("text"), _words, "word string, one int")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
