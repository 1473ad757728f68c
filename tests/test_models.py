"""The Spark folds and workflows against plain-Python models, plus invariants."""

import random

import pytest
from pyspark.sql import functions as F

from tests import models as M
from tests.conftest import SF_SMALL
from tributary import schemas as S
from tributary.operators import debit
from tributary.operators.workflow import workflow_pending, workflow_retry
from tributary.sources.ledger import read_ledger, transfers_from_rows


def _rows(df):
    out = []
    for r in df.select("txId", "fromAccount", "toAccount", "amount", F.unix_micros("instant").alias("us"),
                       "seq", "phase", "status", "retriedTimes").collect():
        out.append({"txId": r.txId, "fromAccount": r.fromAccount, "toAccount": r.toAccount,
                    "cents": int(round(r.amount * 100)), "instant": r.us, "seq": r.seq,
                    "phase": r.phase, "status": r.status, "retriedTimes": r.retriedTimes})
    return out


def _random_ledger(spark, seed, n=300, accounts=6):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        if rnd.random() < 0.3:
            src = rnd.choice(["external", "External"])
            dst = f"{100000 + rnd.randrange(accounts)}"
        else:
            a = rnd.randrange(accounts)
            src = f"{100000 + a}"
            dst = f"{100000 + (a + 1 + rnd.randrange(accounts - 1)) % accounts}"
        rows.append((f"t{i}", src, dst, rnd.choice([1, 2, 3, 5, 5, 8]), S.CREATED))
    return transfers_from_rows(spark, rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_checked_debit_matches_model(spark, seed):
    feed = debit.first_round_feed(_random_ledger(spark, seed))
    expected = M.checked_debit(_rows(feed))
    got = {(r.txId, r.phase): (r.status, int(round(r.balance_after * 100)))
           for r in debit.checked_debit(feed).collect()}
    assert got == expected


def test_checked_debit_matches_model_on_events(spark):
    feed = debit.first_round_feed(read_ledger(spark, SF_SMALL))
    expected = M.checked_debit(_rows(feed))
    got = {(r.txId, r.phase): (r.status, int(round(r.balance_after * 100)))
           for r in debit.checked_debit(feed).collect()}
    assert got == expected


@pytest.mark.parametrize("seed,wait_ms", [(4, None), (5, 60_000), (6, 3_000)])
def test_pending_debit_matches_model(spark, seed, wait_ms):
    feed = debit.first_round_feed(_random_ledger(spark, seed))
    expected = M.pending_debit(_rows(feed), None if wait_ms is None else wait_ms * 1000)
    got = {(r.txId, r.phase): r.status for r in debit.pending_debit(feed, max_wait_ms=wait_ms).collect()}
    assert got == expected


def test_pending_debit_matches_model_on_events(spark):
    feed = debit.first_round_feed(read_ledger(spark, SF_SMALL))
    day_us = 86_400_000_000
    expected = M.pending_debit(_rows(feed), day_us)
    got = {(r.txId, r.phase): r.status
           for r in debit.pending_debit(feed, max_wait_ms=86_400_000).collect()}
    assert got == expected


def _check_workflow(spark, tx, runner, pending_design):
    completed, balances, rounds = runner(tx)
    txs = [dict(r, status=S.CREATED) for r in _rows(tx)]
    exp_done, exp_bal, exp_rounds = M.workflow(txs, pending_design)
    got = {r.txId: (r.status, r.retriedTimes, r.round) for r in completed.collect()}
    assert rounds == exp_rounds
    assert got == exp_done
    bal = {r.account: int(round(r.balance * 100)) for r in balances.collect()}
    assert {k: v for k, v in bal.items() if v} == {k: v for k, v in exp_bal.items() if v}
    # invariants: each transfer completes once, money is conserved, only the
    # outside world may go negative
    assert completed.count() == tx.count()
    assert sum(bal.values()) == 0
    assert all(v >= 0 for k, v in bal.items() if k.lower() != "external")
    return rounds


@pytest.mark.parametrize("seed", [7, 8])
def test_workflow_retry_matches_model(spark, seed):
    rounds = _check_workflow(spark, _random_ledger(spark, seed, n=120), workflow_retry, False)
    assert rounds <= 7


@pytest.mark.parametrize("seed", [9])
def test_workflow_pending_matches_model(spark, seed):
    _check_workflow(spark, _random_ledger(spark, seed, n=120), workflow_pending, True)


def test_workflows_on_events(spark):
    tx = read_ledger(spark, SF_SMALL)
    assert _check_workflow(spark, tx, workflow_retry, False) <= 7
    _check_workflow(spark, tx, workflow_pending, True)
