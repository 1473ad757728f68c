"""Record schemas and fixed values of the transfer model.

Every record has an explicit StructType; nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the modelled system for results to match)
# ---------------------------------------------------------------------------
# Transfer statuses, in their declared order.
CREATED = "CREATED"
RETRY_BALANCE_NOT_ENOUGH = "RETRY_BALANCE_NOT_ENOUGH"
DEBIT_SUCCESS = "DEBIT_SUCCESS"
CANCELLED_BALANCE_NOT_ENOUGH = "CANCELLED_BALANCE_NOT_ENOUGH"
FULFILLED = "FULFILLED"
STATUSES = (CREATED, RETRY_BALANCE_NOT_ENOUGH, DEBIT_SUCCESS,
            CANCELLED_BALANCE_NOT_ENOUGH, FULFILLED)

# The payer name that is never checked for funds (compared case-insensitively).
EXTERNAL_ACCOUNT = "external"
# Retry policy: first delay 500 ms, times 10 per retry, capped at 10 s;
# a transfer retried 5 times is cancelled.
RETRY_BASE_MS = 500
RETRY_FACTOR = 10
RETRY_MAX_WAIT_MS = 10_000
MAX_RETRIES = 5
# Pending-list design: a pending debit waits at most 10 s; a timer that fires
# up to 1 s early still cancels it.
PENDING_MAX_WAIT_MS = 10_000
PENDING_TIMER_SLACK_MS = 1_000
# Delayed echo waits 2 s.
ECHO_DELAY_MS = 2_000
# Topic names of the transfer workflow.
TOPIC_RAW = "alpha-bank-transactions-raw"
TOPIC_RETRY = "alpha-bank-transactions-raw-retry"
TOPIC_COMPLETED = "alpha-bank-transactions-raw-completed"
# ---------------------------------------------------------------------------

# Processing order of the rows of one account.
ORDER = ("instant", "seq", "phase")

BANK_TX = T.StructType([
    T.StructField("txId", T.StringType()),
    T.StructField("fromAccount", T.StringType()),
    T.StructField("toAccount", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("instant", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("retriedTimes", T.IntegerType()),
    T.StructField("maxWaitTime", T.LongType()),
])

LEG = T.StructType([
    T.StructField("txId", T.StringType()),
    T.StructField("account", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("instant", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("retriedTimes", T.IntegerType()),
])

TX_STATE = T.StructType([
    T.StructField("txId", T.StringType()),
    T.StructField("status", T.StringType()),
])

WORD = T.StructType([
    T.StructField("word", T.StringType()),
    T.StructField("one", T.IntegerType()),
])

LINE = T.StructType([T.StructField("value", T.StringType())])

BALANCE = T.StructType([
    T.StructField("account", T.StringType()),
    T.StructField("balance", T.DoubleType()),
])
