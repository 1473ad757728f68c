"""Query registry: name -> (builder(spark, sf_dir) -> DataFrame, oracle SQL or None).

Oracle SQL runs in DuckDB over the same parquet tables (views named after
the tables).  Queries without SQL are checked by row count plus their own
tests (models and invariants).

Every registered query reads the driver tables (or data Spark derives from
them) in full; none runs on a fixed literal input.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.session import prepare

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    tables: tuple[str, ...]
    note: str = ""


REGISTRY: dict[str, Query] = {}


def normalize(df: DataFrame) -> DataFrame:
    """Output convention: session-zone timestamps leave as wall-clock
    TIMESTAMP_NTZ (the files' own type), so results compare across engines."""
    cols = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.TimestampType):
            cols.append(F.col(field.name).cast("timestamp_ntz").alias(field.name))
        else:
            cols.append(F.col(field.name))
    return df.select(*cols)


def register(name: str, sql: str | None, tables: tuple[str, ...], note: str = ""):
    def wrap(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")

        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Time buckets and NTZ<->TIMESTAMP casts are defined in UTC.
            if spark.conf.get("spark.sql.session.timeZone") != "UTC":
                spark.conf.set("spark.sql.session.timeZone", "UTC")
            prepare(spark)
            return normalize(fn(spark, sf_dir))

        build.__name__ = fn.__name__
        build.__doc__ = fn.__doc__
        REGISTRY[name] = Query(name, build, sql, tables, note)
        return fn
    return wrap


def load_all() -> dict[str, Query]:
    # Importing the modules fills REGISTRY.
    from tributary.plans import q_text, q_ledger, q_state, q_windows, q_stream  # noqa: F401
    return REGISTRY
