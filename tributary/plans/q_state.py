"""Registered state, lookup and multi-stream queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.operators import debit, joins, legs
from tributary.plans import sql as Q
from tributary.plans.registry import register
from tributary.sources.ledger import read_ledger
from tributary.sources.tables import read_events

# Accounts asked for by the point lookups: two that exist at every scale and
# one that never does (must come back with a null balance).
LOOKUP_ACCOUNTS = ("100001", "100002", "999999")
# The inclusive range of the range lookup.
LOOKUP_RANGE = "100001-100010"

_CHECKED = "WITH RECURSIVE " + Q.checked_debit_sql(Q.FIRST_ROUND)
_LATEST_SQL = """latest AS (
  SELECT txId, status FROM (
    SELECT txId, status, row_number() OVER (PARTITION BY txId ORDER BY instant DESC, seq DESC, phase DESC) AS rn
    FROM checked) WHERE rn = 1)"""


def _checked(spark, sf_dir):
    # the state is the status: the external account's balance is not needed
    return debit.checked_debit(debit.first_round_feed(read_ledger(spark, sf_dir)), external_running=False)


def _latest(spark, sf_dir):
    return joins.latest_per_key(_checked(spark, sf_dir), "txId", ["status"], ["instant", "seq", "phase"])


@register("latest_tx_state", _CHECKED + ", " + _LATEST_SQL + " SELECT txId, status FROM latest",
          ("events",))
def q_latest_tx_state(spark, sf_dir):
    """Last status per txId of the state feed (the checked-debit output)."""
    return _latest(spark, sf_dir)


@register("broadcast_enrich", _CHECKED + ", " + _LATEST_SQL + """,
legs AS (
  SELECT txId, fromAccount AS account, -amount AS amount, CAST(0 AS INTEGER) AS phase FROM ledger
  UNION ALL
  SELECT txId, toAccount, amount, CAST(1 AS INTEGER) FROM ledger)
SELECT legs.txId, legs.account, legs.amount, legs.phase, latest.status AS tx_status
FROM legs LEFT JOIN latest ON legs.txId = latest.txId
""", ("events",))
def q_broadcast_enrich(spark, sf_dir):
    """J3 (re-aimed): every account leg with the latest state of its transfer.
    The state map has one row per txId and so grows with the data: it is
    joined by shuffle unless AQE finds it small at run time."""
    lg = legs.split_legs(read_ledger(spark, sf_dir), fields=("txId", "account", "amount", "phase"))
    state = _latest(spark, sf_dir).withColumnRenamed("status", "tx_status")
    return joins.enrich(lg, state, "txId").select("txId", "account", "amount", "phase", "tx_status")


@register("control_block", """
SELECT event_id, user_id, value FROM events d
WHERE d.event_type = 'purchase'
  AND NOT EXISTS (SELECT 1 FROM events c WHERE c.event_type = 'error' AND c.user_id = d.user_id
                  AND CAST(c.ts AS DATE) = CAST(d.ts AS DATE))
""", ("events",))
def q_control_block(spark, sf_dir):
    """A control stream (error events) blocks every data row (purchases)
    with the same key, here (user, day)."""
    ev = read_events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    data = ev.where(F.col("event_type") == "purchase").select("event_id", "user_id", "day", "value")
    control = ev.where(F.col("event_type") == "error").select("user_id", "day")
    return joins.block_by_control(data, control, ["user_id", "day"]).select("event_id", "user_id", "value")


_BAL_SQL = Q.LEDGER + f""",
legs AS (
  SELECT fromAccount AS account, -amount AS amount FROM ledger
  UNION ALL SELECT toAccount, amount FROM ledger),
bal AS (SELECT account, {Q.from_cents('sum(' + Q.cents('amount') + ')')} AS balance FROM legs GROUP BY account)"""


def _balances(spark, sf_dir):
    return legs.account_balance_of(read_ledger(spark, sf_dir))


@register("balance_lookup", "WITH " + _BAL_SQL + f""",
keys AS (SELECT unnest([{", ".join(repr(a) for a in LOOKUP_ACCOUNTS)}]) AS account)
SELECT keys.account, bal.balance FROM keys LEFT JOIN bal ON keys.account = bal.account
""", ("events",))
def q_balance_lookup(spark, sf_dir):
    """Q2 + J4: balance of requested accounts; unknown account -> null."""
    keys = spark.createDataFrame([(a,) for a in LOOKUP_ACCOUNTS], "account string")
    return joins.lookup(keys, _balances(spark, sf_dir), "account").select("account", "balance")


_lo, _hi = (int(x) for x in LOOKUP_RANGE.split("-"))


@register("balance_range", "WITH " + _BAL_SQL + f""",
keys AS (SELECT CAST(n - {_lo} AS INTEGER) AS pos, CAST(n AS VARCHAR) AS account FROM range({_lo}, {_hi + 1}) t(n))
SELECT keys.pos, keys.account, bal.balance FROM keys LEFT JOIN bal ON keys.account = bal.account
""", ("events",))
def q_balance_range(spark, sf_dir):
    """Q4 + P10: balances of an inclusive account range, range order kept in
    ``pos``; one join instead of one lookup per key."""
    keys = joins.range_keys(spark, LOOKUP_RANGE)
    return joins.lookup(keys, _balances(spark, sf_dir), "account").select("pos", "account", "balance")
