"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.session import scratch_path

# Fixed values of the contracts: the six ASCII white space characters that
# separate words, as they stand in a pattern and as plain characters.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"


def fresh(taken: Iterable[str], base: str) -> str:
    """A column name that none of ``taken`` has (names compare without case)."""
    used = {c.lower() for c in taken}
    name, n = base, 0
    while name.lower() in used:
        n += 1
        name = f"{base}_{n}"
    return name


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and back quotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def crc_mod(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    text = F.coalesce(id_col.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % n


def map_arrow(df: DataFrame, batches, added: str) -> DataFrame:
    """``df`` with the columns that ``batches`` (a mapInArrow function) adds after the others; ``added``: their DDL.

    Input columns may have any names, dots and repeats included: the function sees them by place only.
    """
    more = T.StructType.fromDDL(added)
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    out = plain.mapInArrow(batches, T.StructType([*plain.schema.fields, *more.fields]))
    return out.toDF(*df.columns, *more.names)


def write_out(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below spark.checkpoint.dir and read it back: the lineage is
    cut, and a lost executor costs only the tasks that it was running."""
    path = scratch_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def labelled_ids(labels: DataFrame, column: str, keep: Column, max_rows: int) -> DataFrame:
    """(doc_id, label): at most ``max_rows`` labelled ids that ``keep`` admits.

    Ids are chosen by the smallest hash, so the choice is the same on every
    run.  Repeated labels of one id count once, as their largest value; null
    ids and null labels are not used.
    """
    one = (labels.where(quoted("doc_id").isNotNull() & quoted(column).isNotNull() & keep)
           .groupBy(quoted("doc_id").alias("doc_id"))
           .agg(F.max(quoted(column)).cast("int").alias("label")))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
