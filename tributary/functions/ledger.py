"""Column rules of the transfer model: keys, phases, backoff, routes, defaults, rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary import schemas as S

# Text form of a transfer, field order and separators.
RENDER_PREFIX = "BankTransaction{"
RENDER_SUFFIX = "}"
# Route names of the after-debit split.
ROUTE_RAW = "raw"            # DEBIT_SUCCESS goes back to the raw topic for its credit
ROUTE_COMPLETED = "completed"
ROUTE_WAIT = "wait"          # RETRY goes to the wait-and-retry stage
ROUTE_RETRY = "retry"
ROUTE_CANCEL = "cancel"


def is_external(from_account: Column) -> Column:
    """The payer is the outside world: never checked for funds."""
    return F.lower(from_account) == F.lit(S.EXTERNAL_ACCOUNT)


def acting_account(status: Column, from_account: Column, to_account: Column) -> Column:
    """Account whose balance a transfer touches next: the payee once debited,
    the payer otherwise."""
    return F.when(status == S.DEBIT_SUCCESS, to_account).otherwise(from_account)


def cents(amount: Column) -> Column:
    """Money inside folds and sums is exact integer cents; half a cent rounds
    away from zero, in batches as in streams (``processors.whole_cents``)."""
    return F.round(amount * 100).cast("long")


def from_cents(c: Column) -> Column:
    return (c.cast("double") / 100.0)


def retry_delay_ms(retried_times: Column, max_wait_ms: int = S.RETRY_MAX_WAIT_MS) -> Column:
    """``min(500 * 10^retried, max_wait)`` in milliseconds."""
    raw = (F.lit(S.RETRY_BASE_MS) * F.pow(F.lit(S.RETRY_FACTOR), retried_times)).cast("long")
    return F.least(raw, F.lit(max_wait_ms).cast("long"))


def retry_decision(retried_times: Column) -> Column:
    return F.when(retried_times < S.MAX_RETRIES, F.lit(ROUTE_RETRY)).otherwise(F.lit(ROUTE_CANCEL))


def route_after_debit(status: Column) -> Column:
    """v1 split: DEBIT_SUCCESS -> raw, FULFILLED -> completed, RETRY -> wait;
    any other status -> null (dropped)."""
    return (F.when(status == S.DEBIT_SUCCESS, F.lit(ROUTE_RAW))
            .when(status == S.FULFILLED, F.lit(ROUTE_COMPLETED))
            .when(status == S.RETRY_BALANCE_NOT_ENOUGH, F.lit(ROUTE_WAIT)))


def route_after_debit2(status: Column) -> Column:
    """v2 split: DEBIT_SUCCESS -> raw, everything else -> completed."""
    return F.when(status == S.DEBIT_SUCCESS, F.lit(ROUTE_RAW)).otherwise(F.lit(ROUTE_COMPLETED))


def instant_text(ts: Column) -> Column:
    """ISO-8601 UTC text of an instant: fraction only when non-zero, in 3 or 6 digits."""
    micros = F.unix_micros(ts) % 1_000_000
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    frac = (F.when(micros == 0, F.lit(""))
            .when(micros % 1000 == 0, F.concat(F.lit("."), F.lpad((micros / 1000).cast("long").cast("string"), 3, "0")))
            .otherwise(F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))))
    return F.concat(base, frac, F.lit("Z"))


def render(tx) -> Column:
    """Text form ``BankTransaction{from:to:amount:status, retriedTimes=.., txId=.., instant=.., maxWaitTime=..}``."""
    return F.concat(
        F.lit(RENDER_PREFIX),
        tx["fromAccount"], F.lit(":"), tx["toAccount"], F.lit(":"),
        tx["amount"].cast("string"), F.lit(":"), tx["status"],
        F.lit(", retriedTimes="), tx["retriedTimes"].cast("string"),
        F.lit(", txId="), tx["txId"],
        F.lit(", instant="), instant_text(tx["instant"]),
        F.lit(", maxWaitTime="), tx["maxWaitTime"].cast("string"),
        F.lit(RENDER_SUFFIX),
    )


def with_defaults(df, id_default: Column | None = None, instant_default: Column | None = None):
    """Fill BANK_TX defaults: CREATED, 0 retries, 0 max-wait; id and instant
    from the given columns (``uuid()`` / ``current_timestamp()`` at ingest)."""
    id_default = id_default if id_default is not None else F.expr("uuid()")
    instant_default = instant_default if instant_default is not None else F.current_timestamp()
    return df.select(
        F.coalesce(F.col("txId"), id_default).alias("txId"),
        "fromAccount", "toAccount", "amount",
        F.coalesce(F.col("instant"), instant_default).alias("instant"),
        F.coalesce(F.col("status"), F.lit(S.CREATED)).alias("status"),
        F.coalesce(F.col("retriedTimes"), F.lit(0)).cast("int").alias("retriedTimes"),
        F.coalesce(F.col("maxWaitTime"), F.lit(0)).cast("long").alias("maxWaitTime"),
        *[c for c in df.columns if c not in S.BANK_TX.fieldNames()],
    )


def expand_range(range_text: Column) -> Column:
    """``"100001-100010"`` -> array of account names 100001 .. 100010 (inclusive);
    a descending range gives no accounts."""
    parts = F.split(range_text, "-")
    first, last = parts[0].cast("int"), parts[1].cast("int")
    ascending = F.sequence(F.least(first, last), last)
    return F.when(first <= last, F.transform(ascending, lambda n: n.cast("string"))).otherwise(
        F.array().cast("array<string>"))
