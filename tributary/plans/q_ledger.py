"""Registered transfer-ledger queries over the events-derived ledger."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary import schemas as S
from tributary.functions import ledger as L
from tributary.functions.codec import decode_frame, to_messages
from tributary.functions.user import keyed_process
from tributary.operators import debit, legs
from tributary.plans import sql as Q
from tributary.plans.registry import REGISTRY, register
from tributary.sinks.topics import routed_messages
from tributary.sources.ledger import chain_transfers, read_ledger
from tributary.sources.tables import read_events

LEG_COLS = ["txId", "account", "amount", "instant", "status", "retriedTimes", "seq", "phase"]
BANK_COLS = S.BANK_TX.fieldNames()
# Max wait of a pending debit in the bounded (event-time) runs: the events are
# far sparser than the 10 s of the live design, so a day is used.
BOUNDED_MAX_WAIT_MS = 86_400_000

_LEGS_SQL = Q.LEDGER + """,
legs AS (
  SELECT txId, fromAccount AS account, -amount AS amount, instant, status, retriedTimes, seq, CAST(0 AS INTEGER) AS phase FROM ledger
  UNION ALL
  SELECT txId, toAccount, amount, instant, status, retriedTimes, seq, CAST(1 AS INTEGER) FROM ledger)"""


@register("split_legs", "WITH " + _LEGS_SQL + " SELECT * FROM legs", ("events",))
def q_split_legs(spark, sf_dir):
    """Every transfer as a payer leg (-amount) and a payee leg (+amount)."""
    return legs.split_legs(read_ledger(spark, sf_dir)).select(*LEG_COLS)


@register("account_balance", "WITH " + _LEGS_SQL + f"""
SELECT account, {Q.from_cents('sum(' + Q.cents('amount') + ')')} AS balance FROM legs GROUP BY account
""", ("events",))
def q_account_balance(spark, sf_dir):
    """A3: balance per account = sum of its signed legs."""
    return legs.account_balance_of(read_ledger(spark, sf_dir))


@register("gen_chain_legs", """
WITH chain AS (SELECT event_id + 1 AS i FROM events)
SELECT CAST(i AS VARCHAR) AS txId, CAST(100000 + i AS VARCHAR) AS account, CAST(-1.0 AS DOUBLE) AS amount,
       CAST(i AS BIGINT) AS seq, CAST(0 AS INTEGER) AS phase FROM chain
UNION ALL
SELECT CAST(i AS VARCHAR), CAST(100001 + i AS VARCHAR), CAST(1.0 AS DOUBLE), CAST(i AS BIGINT), CAST(1 AS INTEGER) FROM chain
""", ("events",))
def q_gen_chain_legs(spark, sf_dir):
    """Chain of unit transfers 100000+i -> 100001+i, one link per event (i = event_id + 1), as legs."""
    ids = read_events(spark, sf_dir).select((F.col("event_id") + 1).alias("id"))
    return legs.split_legs(chain_transfers(ids)).select("txId", "account", "amount", "seq", "phase")


@register("self_connect_balance", "WITH " + Q.LEDGER + f""",
legs AS (
  SELECT txId, fromAccount AS account, -amount AS amount, instant, seq, 0 AS phase, 'DEBIT_SUCCESS' AS status FROM ledger
  UNION ALL
  SELECT txId, toAccount, amount, instant, seq, 1, 'FULFILLED' FROM ledger)
SELECT txId, account, status, amount, {Q.from_cents(Q.running(Q.cents('amount'), 'account'))} AS balance_after
FROM legs
""", ("events",))
def q_self_connect_balance(spark, sf_dir):
    """One stream keyed by payer and by payee sharing the balance: each
    transfer is emitted as DEBIT_SUCCESS (payer) and FULFILLED (payee)."""
    return legs.self_connect_balance(read_ledger(spark, sf_dir))


_ROUND_TRIP_SQL = Q.LEDGER + """,
feed AS (
  SELECT txId, fromAccount, toAccount, amount, instant, status, seq, 0 AS phase FROM ledger
  UNION ALL
  SELECT txId, fromAccount, toAccount, amount, instant, 'DEBIT_SUCCESS', seq, 1 FROM ledger)"""


@register("unchecked_transition", "WITH " + _ROUND_TRIP_SQL + f""",
keyed AS (
  SELECT txId, phase, amount, instant, seq,
         CASE WHEN status = 'DEBIT_SUCCESS' THEN toAccount ELSE fromAccount END AS account,
         CASE WHEN status = 'CREATED' THEN -{Q.cents('amount')}
              WHEN status = 'DEBIT_SUCCESS' THEN {Q.cents('amount')} ELSE 0 END AS d,
         CASE WHEN status = 'CREATED' THEN 'DEBIT_SUCCESS'
              WHEN status = 'DEBIT_SUCCESS' THEN 'FULFILLED' ELSE status END AS status
  FROM feed)
SELECT txId, phase, account, status, amount, {Q.from_cents(Q.running('d', 'account'))} AS balance_after
FROM keyed
""", ("events",))
def q_unchecked_transition(spark, sf_dir):
    """A4: the transfer machine without funds check over the raw topic after one
    round trip (new transfers and their DEBIT_SUCCESS echoes)."""
    return legs.unchecked_transition(legs.round_trip_feed(read_ledger(spark, sf_dir)))


@register("two_stage_transfer", "WITH " + Q.LEDGER + f"""
SELECT txId, fromAccount, toAccount, amount, 'FULFILLED' AS status,
       {Q.from_cents(Q.running('-' + Q.cents('amount'), 'fromAccount'))} AS debit_balance_after,
       {Q.from_cents(Q.running(Q.cents('amount'), 'toAccount'))} AS credit_balance_after
FROM ledger WHERE status = 'CREATED'
""", ("events",))
def q_two_stage_transfer(spark, sf_dir):
    """A5: debit stage then credit stage in one job, each with its own balances."""
    return legs.two_stage_transfer(read_ledger(spark, sf_dir))


DEBIT_OUT = ["txId", "phase", "account", "status", "amount", "balance_after"]


@register("debit_check", "WITH RECURSIVE " + Q.checked_debit_sql(Q.FIRST_ROUND)
          + " SELECT " + ", ".join(DEBIT_OUT) + " FROM checked", ("events",))
def q_debit_check(spark, sf_dir):
    """Checked debit / credit per account over the first-round raw topic."""
    feed = debit.first_round_feed(read_ledger(spark, sf_dir))
    return debit.checked_debit(feed).select(*DEBIT_OUT)


@register("debit_pending", "WITH RECURSIVE " + Q.pending_debit_sql(Q.FIRST_ROUND, BOUNDED_MAX_WAIT_MS)
          + " SELECT " + ", ".join(DEBIT_OUT) + ", maxWaitTime FROM settled", ("events",))
def q_debit_pending(spark, sf_dir):
    """Checked debit with a pending list (event time, max wait one day)."""
    feed = debit.first_round_feed(read_ledger(spark, sf_dir))
    return (debit.pending_debit(feed, max_wait_ms=BOUNDED_MAX_WAIT_MS)
            .select(*DEBIT_OUT, "maxWaitTime"))


@register("double_odds", """
WITH v AS (SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
SELECT event_id, k * 2 AS doubled FROM v WHERE k % 2 = 1
""", ("events",))
def q_double_odds(spark, sf_dir):
    """P5: keep odd values (the integer ``k`` of each event's payload) and double
    them; like Java, Spark's remainder keeps the sign, so negative odds drop out."""
    ev = read_events(spark, sf_dir).select("event_id", "props")
    vals = decode_frame(ev, "props", schema="k long", keep=("event_id",))
    return vals.where(F.col("k") % 2 == 1).select("event_id", (F.col("k") * 2).alias("doubled"))


_INSTANT_TEXT_SQL = """strftime(instant, '%Y-%m-%dT%H:%M:%S') ||
  CASE WHEN microsecond(instant) % 1000000 = 0 THEN ''
       WHEN microsecond(instant) % 1000 = 0 THEN '.' || lpad(CAST((microsecond(instant) % 1000000) // 1000 AS VARCHAR), 3, '0')
       ELSE '.' || lpad(CAST(microsecond(instant) % 1000000 AS VARCHAR), 6, '0') END || 'Z'"""


@register("tx_render", "WITH " + Q.LEDGER + f"""
SELECT txId, 'BankTransaction{{' || fromAccount || ':' || toAccount || ':' || CAST(amount AS VARCHAR) || ':' || status
       || ', retriedTimes=' || CAST(retriedTimes AS VARCHAR) || ', txId=' || txId
       || ', instant=' || {_INSTANT_TEXT_SQL}
       || ', maxWaitTime=' || CAST(maxWaitTime AS VARCHAR) || '}}' AS text
FROM ledger
""", ("events",))
def q_tx_render(spark, sf_dir):
    """Text form of every transfer."""
    led = read_ledger(spark, sf_dir)
    return led.select("txId", L.render(led).alias("text"))


@register("tx_defaults", "WITH " + Q.LEDGER + """
SELECT txId, fromAccount, toAccount, amount, instant, 'CREATED' AS status,
       CAST(0 AS INTEGER) AS retriedTimes, CAST(0 AS BIGINT) AS maxWaitTime FROM ledger
""", ("events",))
def q_tx_defaults(spark, sf_dir):
    """Transfers that arrive with only id, parties, amount and time get the
    defaults (CREATED, 0 retries, 0 max wait)."""
    led = read_ledger(spark, sf_dir)
    partial = led.select("txId", "fromAccount", "toAccount", "amount", "instant",
                         F.lit(None).cast("string").alias("status"),
                         F.lit(None).cast("int").alias("retriedTimes"),
                         F.lit(None).cast("long").alias("maxWaitTime"))
    return L.with_defaults(partial)


@register("tx_state_events", "WITH " + Q.FIRST_ROUND + """
SELECT txId, status FROM feed
""", ("events",))
def q_tx_state_events(spark, sf_dir):
    """(txId, status) projection of the raw topic."""
    feed = debit.first_round_feed(read_ledger(spark, sf_dir))
    return feed.select("txId", "status")


@register("acting_account", "WITH " + _ROUND_TRIP_SQL + """
SELECT txId, phase, status, CASE WHEN status = 'DEBIT_SUCCESS' THEN toAccount ELSE fromAccount END AS account
FROM feed
""", ("events",))
def q_acting_account(spark, sf_dir):
    """Status-dependent key (payee once debited, payer otherwise)."""
    feed = legs.round_trip_feed(read_ledger(spark, sf_dir))
    return feed.select("txId", "phase", "status",
                       L.acting_account(F.col("status"), F.col("fromAccount"), F.col("toAccount")).alias("account"))


def _retry_feed(spark, sf_dir):
    """Retry-topic rows: the ledger with its retry counters spread over 0..6 by
    ``seq % 7`` so every backoff step and the cancel branch occur."""
    led = read_ledger(spark, sf_dir)
    return led.withColumn("retriedTimes", (F.col("seq") % 7).cast("int")) \
              .withColumn("status", F.lit(S.RETRY_BALANCE_NOT_ENOUGH))


_RETRY_SQL = Q.LEDGER + """,
retry AS (SELECT txId, instant, CAST(seq % 7 AS INTEGER) AS retriedTimes FROM ledger)"""


@register("retry_backoff", "WITH " + _RETRY_SQL + """
SELECT txId, retriedTimes, CAST(least(500 * power(10, retriedTimes), 10000) AS BIGINT) AS delay_ms,
       retriedTimes + 1 AS next_retried_times
FROM retry
""", ("events",))
def q_retry_backoff(spark, sf_dir):
    """P11+P12: backoff delay min(500*10^n, 10000) ms and the incremented counter."""
    feed = _retry_feed(spark, sf_dir)
    return feed.select("txId", "retriedTimes",
                       L.retry_delay_ms(F.col("retriedTimes")).alias("delay_ms"),
                       (F.col("retriedTimes") + 1).alias("next_retried_times"))


@register("retry_or_cancel", "WITH " + _RETRY_SQL + """
SELECT txId,
       CASE WHEN retriedTimes < 5 THEN 'retry' ELSE 'cancel' END AS route,
       CASE WHEN retriedTimes < 5 THEN 'RETRY_BALANCE_NOT_ENOUGH' ELSE 'CANCELLED_BALANCE_NOT_ENOUGH' END AS status,
       CASE WHEN retriedTimes < 5 THEN retriedTimes + 1 ELSE retriedTimes END AS retriedTimes,
       CASE WHEN retriedTimes < 5
            THEN instant + to_milliseconds(CAST(least(500 * power(10, retriedTimes), 10000) AS BIGINT))
            ELSE instant END AS due
FROM retry
""", ("events",))
def q_retry_or_cancel(spark, sf_dir):
    """F8 + T4 (stateless half, event time): under 5 retries wait the backoff and
    re-emit with counter+1, still RETRY; otherwise cancel at once."""
    feed = _retry_feed(spark, sf_dir)
    n = F.col("retriedTimes")
    retry = n < S.MAX_RETRIES
    return feed.select(
        "txId",
        L.retry_decision(n).alias("route"),
        F.when(retry, F.lit(S.RETRY_BALANCE_NOT_ENOUGH)).otherwise(F.lit(S.CANCELLED_BALANCE_NOT_ENOUGH)).alias("status"),
        F.when(retry, n + 1).otherwise(n).alias("retriedTimes"),
        F.when(retry, F.timestamp_micros(F.unix_micros("instant") + L.retry_delay_ms(n) * 1000))
         .otherwise(F.col("instant")).alias("due"))


@register("json_decode", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
""", ("events",))
def q_json_decode(spark, sf_dir):
    """Decode the JSON payload of every event with a fixed schema."""
    ev = read_events(spark, sf_dir).select("event_id", "props")
    return decode_frame(ev, "props", schema="k long", keep=("event_id",))


@register("json_encode", "WITH " + Q.LEDGER + " SELECT " + ", ".join(BANK_COLS) + " FROM ledger",
          ("events",))
def q_json_encode(spark, sf_dir):
    """Encode every transfer to JSON (null key) and decode it back; the
    round trip must give the transfer unchanged (JSON text is never compared)."""
    msgs = to_messages(read_ledger(spark, sf_dir))
    return decode_frame(msgs, "value").select(*BANK_COLS)


@register("json_encode_keyed", "WITH " + Q.LEDGER + " SELECT fromAccount AS key, "
          + ", ".join(BANK_COLS) + " FROM ledger", ("events",))
def q_json_encode_keyed(spark, sf_dir):
    """K3: JSON messages keyed by the payer account (topic backup)."""
    msgs = to_messages(read_ledger(spark, sf_dir), key=F.col("fromAccount"))
    return decode_frame(msgs, "value", keep=("key",)).select("key", *BANK_COLS)


_CHECKED = "WITH RECURSIVE " + Q.checked_debit_sql(Q.FIRST_ROUND)


def _checked(spark, sf_dir):
    # these queries use the statuses, not the external balance
    return debit.checked_debit(debit.first_round_feed(read_ledger(spark, sf_dir)), external_running=False)


@register("filter_status", "WITH " + _ROUND_TRIP_SQL + """
SELECT txId, phase, fromAccount, toAccount, amount FROM feed WHERE status = 'DEBIT_SUCCESS'
""", ("events",))
def q_filter_status(spark, sf_dir):
    """keep one status (DEBIT_SUCCESS) of the raw topic after a round trip."""
    feed = legs.round_trip_feed(read_ledger(spark, sf_dir))
    return (feed.where(F.col("status") == S.DEBIT_SUCCESS)
            .select("txId", "phase", "fromAccount", "toAccount", "amount"))


@register("route_after_debit", _CHECKED + """
SELECT txId, phase, status,
       CASE WHEN status = 'DEBIT_SUCCESS' THEN 'raw' WHEN status = 'FULFILLED' THEN 'completed'
            WHEN status = 'RETRY_BALANCE_NOT_ENOUGH' THEN 'wait' END AS route
FROM checked WHERE status IN ('DEBIT_SUCCESS', 'FULFILLED', 'RETRY_BALANCE_NOT_ENOUGH')
""", ("events",))
def q_route_after_debit(spark, sf_dir):
    """three-way split of the checked-debit output; other statuses dropped."""
    out = _checked(spark, sf_dir).withColumn("route", L.route_after_debit(F.col("status")))
    return out.where(F.col("route").isNotNull()).select("txId", "phase", "status", "route")


def _split(key, rows, state):
    """A user's process function: a named output for each status that goes on, none for the others."""
    for status, name in ((S.DEBIT_SUCCESS, "raw"), (S.FULFILLED, "completed"), (S.RETRY_BALANCE_NOT_ENOUGH, "wait")):
        yield name, rows[rows["status"] == status]


@register("route_after_debit_user", REGISTRY["route_after_debit"].sql, ("events",))
def q_route_after_debit_user(spark, sf_dir):
    """F2 as a user's keyed process function with side outputs."""
    schema = T.StructType([T.StructField("txId", T.StringType()), T.StructField("phase", T.IntegerType()),
                           T.StructField("status", T.StringType())])
    out = keyed_process(_checked(spark, sf_dir).select("account", "txId", "phase", "status"), ["account"], _split, schema)
    return out.withColumnRenamed("output", "route")


@register("route_after_debit2", _CHECKED + """
SELECT txId, phase, status, CASE WHEN status = 'DEBIT_SUCCESS' THEN 'raw' ELSE 'completed' END AS route
FROM checked
""", ("events",))
def q_route_after_debit2(spark, sf_dir):
    """two-way split (DEBIT_SUCCESS back to raw, all else completed)."""
    out = _checked(spark, sf_dir)
    return out.select("txId", "phase", "status", L.route_after_debit2(F.col("status")).alias("route"))


@register("route_topics", _CHECKED + f"""
SELECT CASE WHEN status = 'DEBIT_SUCCESS' THEN '{S.TOPIC_RAW}' ELSE '{S.TOPIC_COMPLETED}' END AS topic,
       txId, status
FROM checked
""", ("events",))
def q_route_topics(spark, sf_dir):
    """K6: one message frame with a computed topic per row (what a single Kafka
    write with a ``topic`` column sends); values decoded back for comparison."""
    msgs = routed_messages(_checked(spark, sf_dir))
    return decode_frame(msgs, "value", keep=("topic",)).select("topic", "txId", "status")


_WORKFLOW_OUT = ["txId", "phase", "status", "retriedTimes", "round"]


@register("workflow_retry", "WITH RECURSIVE " + Q.workflow_retry_sql(S.MAX_RETRIES)
          + " SELECT " + ", ".join(_WORKFLOW_OUT) + " FROM completed", ("events",))
def q_workflow_retry(spark, sf_dir):
    """The v1 feedback workflow over the whole ledger, run in rounds; the
    completed topic (one final row per transfer)."""
    from tributary.operators.workflow import workflow_retry
    completed, _, _ = workflow_retry(read_ledger(spark, sf_dir))
    return completed.select(*_WORKFLOW_OUT)


@register("workflow_pending", None, ("events",),
          note="rounds to a fixpoint; checked by invariants and a Python model in tests")
def q_workflow_pending(spark, sf_dir):
    """The v2 (pending list) feedback workflow over the whole ledger."""
    from tributary.operators.workflow import workflow_pending
    completed, _, _ = workflow_pending(read_ledger(spark, sf_dir))
    return completed.select(*_WORKFLOW_OUT)
