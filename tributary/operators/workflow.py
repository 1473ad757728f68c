"""Bounded runs of the two feedback workflows (T7, T8) as rounds.

The live workflows loop transfers through topics: the balance stage emits
DEBIT_SUCCESS back to the raw topic (to be credited on the payee), and
failed debits either come back after a wait (v1, retry topic) or wait in the
account's pending list (v2).  On a bounded input the loop becomes rounds:

    round r input = raw rows of round r
                  + carried balance of each account the round touches   (_kind 'balance')
                  + v2: that account's carried pending debits           (_kind 'pending')
    -> one fold per account (``operators.debit``), credits before debits
    -> DEBIT_SUCCESS: next round as credits;  FULFILLED / CANCELLED: completed
       v1 RETRY: next round with counter+1, or cancelled after 5 retries.

Each round is written as a parquet table under the shared
``spark.checkpoint.dir`` and read back (computed once, unlike an eager
``checkpoint()`` of an uncached plan), so lineage stays one round long and a
lost executor recomputes at most one round.  The driver loop only counts rows of
the next round; no data passes through it.  v1 ends after at most seven
rounds; v2 ends with the first round that credits nobody, and whatever is
still pending is then cancelled.
"""

from __future__ import annotations

import logging
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary import schemas as S
from tributary.functions.ledger import acting_account
from tributary.operators.debit import run_fold
from tributary.session import ensure_checkpoint_dir, scratch_path

_log = logging.getLogger(__name__)

_TX_COLS = ["txId", "fromAccount", "toAccount", "amount", "instant", "status",
            "retriedTimes", "maxWaitTime", "seq", "phase"]
# Inside a round an account applies credits before debits.
def _prio():
    return F.when(F.col("status") == S.DEBIT_SUCCESS, F.lit(0)).otherwise(F.lit(1))


def _balance_rows(balances: DataFrame) -> DataFrame:
    """Closing balances of a round as the next round's input rows (sorted first
    in their account)."""
    return balances.select(
        F.lit(None).cast("string").alias("txId"),
        F.col("account").alias("fromAccount"), F.col("account").alias("toAccount"),
        (F.col("_bal").cast("double") / 100.0).alias("amount"),
        F.lit(None).cast("timestamp").alias("instant"),
        F.lit(None).cast("string").alias("status"),
        F.lit(None).cast("int").alias("retriedTimes"), F.lit(None).cast("long").alias("maxWaitTime"),
        F.lit(None).cast("long").alias("seq"), F.lit(None).cast("int").alias("phase"),
        F.lit("balance").alias("_kind"), F.lit(-2).alias("_prio"))


# rounds after which their tables are replaced by one of current state
COMPACT_ROUNDS = 8


def _latest_state(history: DataFrame, accounts: DataFrame | None, pending_design: bool):
    """Latest closing balance (and, v2, latest pending rows) of the given
    accounts (all accounts when None), read from the per-round tables.

    Every account a round touches leaves one closing-balance row in that
    round's table, so an account's state is the balance row of the last round
    that touched it and the pending rows written in that same round."""
    state = history.where(F.col("_kind").isin("balance", "pending"))
    if accounts is not None:
        state = state.join(accounts, "account", "left_semi")
    last = (state.where(F.col("_kind") == "balance").groupBy("account")
            .agg(F.max_by("_bal", "_round").alias("_bal"), F.max("_round").alias("_last")))
    pending = None
    if pending_design:
        pending = (state.where(F.col("_kind") == "pending")
                   .join(last.select("account", "_last"), "account")
                   .where(F.col("_round") == F.col("_last")))
    return last, pending


def _compact(spark, paths: list[str], schema, pending_design: bool) -> str:
    """One table with the current state of all accounts, in place of the rounds' tables."""
    history = spark.read.schema(schema).parquet(*paths)
    last, _ = _latest_state(history, None, pending_design)
    state = (history.where(F.col("_kind").isin("balance", "pending"))
             .join(last.select("account", "_last"), "account").where(F.col("_round") == F.col("_last")))
    path = scratch_path(spark, "state")
    state.select(*schema.fieldNames()).write.parquet(path)
    return path


def run_workflow(tx: DataFrame, pending_design: bool, max_rounds: int | None = None):
    """Run the rounds until no transfer is in flight.  Returns ``(completed, balances, rounds)``.

    ``max_rounds`` is a limit of the caller's own: reaching it with transfers
    still in flight raises, nothing is cut off silently.

    ``completed``: every transfer once, final status FULFILLED or
    CANCELLED_BALANCE_NOT_ENOUGH, with ``retriedTimes`` and the ``round`` it
    completed in.  ``balances``: ``(account, balance)`` at the end.

    State lives in the append-only round tables: a round reads the balances
    (and pending lists) of only the accounts it touches (a semi join), so late
    rounds with few transfers do not move every account's state again.  Every
    ``COMPACT_ROUNDS`` rounds one table of current state replaces the others.
    """
    spark = tx.sparkSession
    ensure_checkpoint_dir(spark)
    raw = tx.select(*_TX_COLS, F.lit("row").alias("_kind"), _prio().alias("_prio"))
    paths: list[str] = []
    completed = []
    rounds = 0
    schema = None  # round-table schema, known after the first write (no inference jobs)
    while True:
        feed = raw
        if paths:
            # a semi join needs no distinct on its right side
            touched = raw.select(acting_account(F.col("status"), F.col("fromAccount"),
                                                F.col("toAccount")).alias("account"))
            last, pending = _latest_state(spark.read.schema(schema).parquet(*paths), touched, pending_design)
            feed = feed.unionByName(_balance_rows(last))
            if pending is not None:
                feed = feed.unionByName(
                    pending.select(*_TX_COLS, F.lit("pending").alias("_kind"), F.lit(-1).alias("_prio")))
        _t0 = time.perf_counter()
        path = scratch_path(spark, "round")
        result = (run_fold(feed, pending_design=pending_design, max_wait_ms=None,
                           keep_pending=pending_design, emit_balance=True, external_running=False)
                  .withColumn("_round", F.lit(rounds)))
        schema = schema or result.schema
        result.write.parquet(path)
        paths.append(path)
        out = spark.read.schema(schema).parquet(path)
        rounds += 1
        _log.debug("round %d materialised in %.2fs", rounds, time.perf_counter() - _t0)
        emitted = out.where(F.col("_kind") == "out")
        credits = (emitted.where(F.col("status") == S.DEBIT_SUCCESS)
                   .withColumn("phase", F.col("phase") + 1))
        done = emitted.where(F.col("status").isin(S.FULFILLED, S.CANCELLED_BALANCE_NOT_ENOUGH))
        if pending_design:
            nxt = credits
        else:
            retry = emitted.where(F.col("status") == S.RETRY_BALANCE_NOT_ENOUGH)
            again = (retry.where(F.col("retriedTimes") < S.MAX_RETRIES)
                     .withColumn("retriedTimes", F.col("retriedTimes") + 1))
            cancelled = (retry.where(F.col("retriedTimes") >= S.MAX_RETRIES)
                         .withColumn("status", F.lit(S.CANCELLED_BALANCE_NOT_ENOUGH)))
            done = done.unionByName(cancelled)
            nxt = credits.unionByName(again)
        completed.append(done.select(*_TX_COLS, F.lit(rounds - 1).alias("round")))
        raw = nxt.select(*_TX_COLS, F.lit("row").alias("_kind"), _prio().alias("_prio"))
        if raw.isEmpty():
            break
        if max_rounds is not None and rounds >= max_rounds:
            raise RuntimeError(f"transfers still in flight after {max_rounds} rounds")
        if len(paths) >= COMPACT_ROUNDS:
            paths = [_compact(spark, paths, schema, pending_design)]
    last, pending = _latest_state(spark.read.schema(schema).parquet(*paths), None, pending_design)
    if pending is not None:
        # Nothing will credit these any more: cancel what is still waiting.
        completed.append(pending.select(
            *[F.lit(S.CANCELLED_BALANCE_NOT_ENOUGH).alias("status") if c == "status" else F.col(c)
              for c in _TX_COLS], F.lit(rounds).alias("round")))
    result = completed[0]
    for part in completed[1:]:
        result = result.unionByName(part)
    final_balances = last.select("account", (F.col("_bal").cast("double") / 100.0).alias("balance"))
    return result, final_balances, rounds


def workflow_retry(tx: DataFrame, max_rounds: int | None = None):
    """Retry through a topic (v1 rules, 5 retries, then cancel)."""
    return run_workflow(tx, pending_design=False, max_rounds=max_rounds)


def workflow_pending(tx: DataFrame, max_rounds: int | None = None):
    """Pending list in keyed state (v2 rules)."""
    return run_workflow(tx, pending_design=True, max_rounds=max_rounds)
