"""The corpus pipeline: documents in, a cleaned, mixed and tokenised corpus out.

``STAGES`` are (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's docs.  A stage works on all rows that its predecessor kept.  All but the
last return the columns of documents.

1. quality_classifier: documents scored below the classifier's threshold go.
   The model learns from ``labels`` of the ids whose crc32 modulo 5 is not 0,
   with the texts of ``docs``.
2. quality_rules: documents that the base rules or the adaptive thresholds
   reject go.
3. near_dedup: one document of each class of near duplicates stays.
4. mixing: documents are repeated or left out so that sources come to their
   target weights (on the sizes that the stages before have left).
5. bpe: documents with their token ids, and a check that these decode to the
   text: doc_id, lang, source, n_tokens, ids, round_trip.

Null texts count as empty, so the rules drop them; empty tables pass through
all stages as empty tables; extra columns of documents pass through to the
fourth stage; repeated rows are duplicates of each other.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import bpe, gam, mixing, neardup, rules
from tributary.llm.common import crc_mod, quoted, write_out
from tributary.session import prepare
from tributary.sources.tables import read_table

QUALITY = 0.3
VOCAB = "byte_bpe_multi_50k.tiktoken"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    labels = read_table(spark, sf_dir, "labels")
    model = gam.train(docs, labels, "quality", crc_mod(F.col("doc_id"), 5) != 0)
    return docs.where(gam.score_column(model, F.col("text")) >= QUALITY)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return rules.judge(docs).where("kept").select(*[quoted(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return neardup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mix(docs)


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    path = public_tokenizers.path(VOCAB)
    back = bpe.encode(docs.select("doc_id", "lang", "source", "text"), "text", path, public_tokenizers.PATTERN,
                      decoded_col="decoded")
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return back.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                       same.alias("round_trip"))


STAGES = [("quality_classifier", quality_classifier), ("quality_rules", quality_rules), ("near_dedup", near_dedup),
          ("mixing", mix_sources), ("bpe", bpe_encode)]

# Trained models, signatures and hash-driven rounding are not SQL: tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written below spark.checkpoint.dir and read again."""
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_out(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
