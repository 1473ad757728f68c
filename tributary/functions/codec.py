"""JSON codec of transfers and other records on topics.

Wire form: one JSON object per message with the BANK_TX field names.
``instant`` is written as decimal epoch seconds (nanosecond scale), and read
back from either that form or an ISO-8601 string.  Decoding uses a fixed
schema, never inference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary import schemas as S


def instant_from_wire(text: Column) -> Column:
    """Decimal epoch seconds ("1622505600.123456789") or ISO text -> TIMESTAMP (µs)."""
    numeric = text.rlike(r"^-?[0-9]+(\.[0-9]+)?([eE][-+]?[0-9]+)?$")
    as_seconds = F.timestamp_micros((text.cast("decimal(30,9)") * 1_000_000).cast("long"))
    return F.when(numeric, as_seconds).otherwise(text.cast("timestamp"))


def instant_to_wire(ts: Column) -> Column:
    return (F.unix_micros(ts).cast("decimal(30,9)") / 1_000_000).cast("decimal(20,9)")


def decode(value: Column, schema: T.StructType = S.BANK_TX, mode: str = "FAILFAST") -> Column:
    """JSON text -> struct.  ``mode`` FAILFAST fails the job on a bad record
    (the modelled behaviour); PERMISSIVE yields nulls for routing to a dead letter.
    A timestamp field named ``instant`` is read in its wire form (decimal
    epoch seconds or ISO text)."""
    if isinstance(schema, str):
        return F.from_json(value, schema, {"mode": mode})
    names = schema.fieldNames()
    has_instant = "instant" in names and isinstance(schema["instant"].dataType, T.TimestampType)
    if not has_instant:
        return F.from_json(value, schema, {"mode": mode})
    wire = T.StructType([T.StructField(f.name, T.StringType()) if f.name == "instant" else f
                         for f in schema.fields])
    parsed = F.from_json(value, wire, {"mode": mode})
    return F.struct(*[
        (instant_from_wire(parsed["instant"]) if f.name == "instant" else parsed[f.name]).alias(f.name)
        for f in schema.fields])


def decode_frame(df: DataFrame, value_col: str = "value", schema: T.StructType = S.BANK_TX,
                 keep: tuple = (), mode: str = "FAILFAST") -> DataFrame:
    return df.select(*keep, decode(F.col(value_col).cast("string"), schema, mode).alias("_r")).select(*keep, "_r.*")


def encode(df: DataFrame, fields: list[str] | None = None) -> Column:
    """Record -> JSON text; every field is written, nulls included."""
    fields = fields or [f for f in S.BANK_TX.fieldNames() if f in df.columns]
    cols = [(instant_to_wire(F.col(f)) if f == "instant" else F.col(f)).alias(f) for f in fields]
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def to_messages(df: DataFrame, key: Column | None = None, fields: list[str] | None = None,
                keep: tuple = ()) -> DataFrame:
    """``(key, value)`` message frame; ``key`` null unless given (e.g. fromAccount)."""
    key = key if key is not None else F.lit(None).cast("string")
    return df.select(*keep, key.cast("string").alias("key"), encode(df, fields).alias("value"))
