"""Transfers (BANK_TX rows) derived from the ``events`` table, and the chain generator.

Mapping from an event row (a pure row expression, so SQL can state it too):

* ``txId`` = event_id as text, ``instant`` = ts, ``amount`` = value;
* account names are ``100000 + n`` as text;
* a ``signup`` is a deposit from ``external`` to the user;
* any other event is a transfer from the user to account
  ``user_id + 1 + event_id % 7`` (a neighbour of the user).

Every transfer starts as CREATED with 0 retries.  Two ordering columns are
carried next to the BANK_TX fields: ``seq`` (the event_id) and ``phase`` (0
for a new transfer, higher for later hops of the same transfer).  The
processing order of one account is ``(instant, seq, phase)`` everywhere in
this library (``schemas.ORDER``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary import schemas as S
from tributary.sources.tables import read_events

ACCOUNT_BASE = 100000
NEIGHBOUR_SPAN = 7


def account_name(n: Column) -> Column:
    return (F.lit(ACCOUNT_BASE) + n).cast("string")


def ledger_from_events(events: DataFrame) -> DataFrame:
    user = account_name(F.col("user_id"))
    is_deposit = F.col("event_type") == "signup"
    neighbour = account_name(F.col("user_id") + 1 + F.col("event_id") % NEIGHBOUR_SPAN)
    return events.select(
        F.col("event_id").cast("string").alias("txId"),
        F.when(is_deposit, F.lit(S.EXTERNAL_ACCOUNT)).otherwise(user).alias("fromAccount"),
        F.when(is_deposit, user).otherwise(neighbour).alias("toAccount"),
        F.col("value").alias("amount"),
        F.col("ts").cast("timestamp").alias("instant"),
        F.lit(S.CREATED).alias("status"),
        F.lit(0).cast("int").alias("retriedTimes"),
        F.lit(0).cast("long").alias("maxWaitTime"),
        F.col("event_id").alias("seq"),
        F.lit(0).alias("phase"),
    )


def read_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger_from_events(read_events(spark, sf_dir))


def chain_transfers(ids: DataFrame, id_col: str = "id", amount: float = 1.0) -> DataFrame:
    """A chain of transfers ``100000+i -> 100001+i`` of a fixed amount, one per id.

    ``ids`` is any DataFrame with a long id column (``spark.range(1, 11)``
    gives the classic ten-link chain).  Instant is the epoch, so the order of
    the chain is its id order.
    """
    i = F.col(id_col)
    return ids.select(
        i.cast("string").alias("txId"),
        account_name(i).alias("fromAccount"),
        account_name(i + 1).alias("toAccount"),
        F.lit(float(amount)).alias("amount"),
        F.timestamp_seconds(F.lit(0)).alias("instant"),
        F.lit(S.CREATED).alias("status"),
        F.lit(0).cast("int").alias("retriedTimes"),
        F.lit(0).cast("long").alias("maxWaitTime"),
        i.cast("long").alias("seq"),
        F.lit(0).alias("phase"),
    )


def transfers_from_rows(spark: SparkSession, rows) -> DataFrame:
    """Bounded literal transfers: ``rows`` of (txId, from, to, amount[, status]).

    Missing fields take the BANK_TX defaults (CREATED, 0 retries, epoch instant
    plus the row position in seconds, so literal order is processing order).
    """
    out = []
    for pos, row in enumerate(rows):
        tx_id, src, dst, amount, *rest = row
        status = rest[0] if rest else S.CREATED
        out.append((tx_id, src, dst, float(amount), pos, status))
    df = spark.createDataFrame(out, "txId string, fromAccount string, toAccount string, "
                                    "amount double, pos long, status string")
    return df.select(
        "txId", "fromAccount", "toAccount", "amount",
        F.timestamp_seconds(F.col("pos")).alias("instant"),
        "status",
        F.lit(0).cast("int").alias("retriedTimes"),
        F.lit(0).cast("long").alias("maxWaitTime"),
        F.col("pos").alias("seq"),
        F.lit(0).alias("phase"),
    )
