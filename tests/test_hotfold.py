"""Busy accounts folded in blocks, and the pending list's tree, against sequential models."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests import models as M
from tests.test_models import _rows
from tributary import schemas as S
from tributary.operators import debit, hotfold
from tributary.operators.pending import PendingList
from tributary.operators.workflow import workflow_retry
from tributary.sources.ledger import transfers_from_rows

HOT = "100007"


def _ledger(spark, seed, n=900, deposit=9, one_instant=False):
    """One account pays or gets nine rows of ten; ``deposit``: the largest amount it gets at once."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        if rnd.random() < 0.1:
            a, b = rnd.sample(["external", "1", "2", "3"], 2)
            rows.append((f"t{i}", a, b, rnd.randrange(1, 9), S.CREATED))
        elif rnd.random() < 0.45:
            rows.append((f"t{i}", rnd.choice(["external", "1"]), HOT, rnd.randrange(1, deposit),
                         rnd.choice([S.DEBIT_SUCCESS, S.DEBIT_SUCCESS, S.FULFILLED])))
        else:
            rows.append((f"t{i}", HOT, rnd.choice(["1", "2"]), rnd.randrange(1, 60),
                         rnd.choice([S.CREATED, S.CREATED, S.RETRY_BALANCE_NOT_ENOUGH])))
    tx = transfers_from_rows(spark, rows)
    if one_instant:
        tx = tx.withColumn("instant", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return tx.withColumn("phase", F.lit(0))


def _folded(df):
    return {(r.txId, r.phase): (r.status, int(round(r.balance_after * 100))) for r in df.collect()}


@pytest.mark.parametrize("seed,deposit,one_instant", [(1, 9, False), (2, 40, False), (3, 400, False), (4, 40, True)])
def test_busy_account_in_blocks_equals_the_sequential_model(spark, seed, deposit, one_instant):
    feed = _ledger(spark, seed, deposit=deposit, one_instant=one_instant)
    out = debit.checked_debit(feed, busy_rows=50)
    assert _folded(out) == M.checked_debit(_rows(feed)) == _folded(debit.checked_debit(feed))
    hot = out.where((F.col("account") == HOT)).groupBy(F.spark_partition_id().alias("p")).count().collect()
    sizes = [r["count"] for r in hot]
    assert len(sizes) >= 5 and max(sizes) < 0.5 * sum(sizes)      # all tasks share the account


def test_carried_and_closing_balances(spark):
    feed = _ledger(spark, 5, deposit=40)
    kinds = {"_kind": "string", "_prio": "int", "_init": "long"}
    rows = feed.withColumns({c: F.lit(None).cast(t) for c, t in kinds.items()}).withColumns(
        {"_kind": F.lit("row"), "_prio": F.lit(1)})
    carried = rows.limit(1).withColumns({"fromAccount": F.lit(HOT), "status": F.lit(S.CREATED), "_kind": F.lit("balance"),
                                         "_prio": F.lit(0), "amount": F.lit(12.34)})
    both = rows.unionByName(carried)
    cols = ["account", "txId", "phase", "status", "_kind", "_bal"]
    got, want = (sorted(map(tuple, debit.run_fold(both, False, emit_balance=True, external_running=False, busy_rows=n)
                            .select(*cols).collect()), key=str) for n in (50, 10 ** 9))
    assert got == want and any(r[4] == "balance" and r[0] == HOT for r in got)


def test_rich_account_needs_no_walk(spark, monkeypatch):
    monkeypatch.setattr(hotfold, "_walked", None)                 # would fail if a block were uncertain
    rows = [("d", "external", HOT, 10_000, S.DEBIT_SUCCESS)] + [(f"t{i}", HOT, "1", 1, S.CREATED) for i in range(300)]
    feed = transfers_from_rows(spark, rows).withColumn("phase", F.lit(0))
    assert _folded(debit.checked_debit(feed, busy_rows=50)) == M.checked_debit(_rows(feed))


def test_certain_blocks_follow_from_bounds(spark):
    """Some blocks of an account that is poor at times are certain, and all that are accept all."""
    feed = _ledger(spark, 6, n=3000, deposit=70)
    keyed = debit.keyed_feed(feed).where(F.col("account") == HOT)
    blocked = hotfold.with_block(keyed, hotfold.cut_places(keyed, 2700, 60), [HOT])
    rows = (blocked.repartition(1).sortWithinPartitions("_block", *hotfold.ORDER)
            .select("account", "status", "_c", "_init", "_block").mapInArrow(hotfold._summarised, hotfold.SUMMARY))
    certain = {b["_block"] for b in hotfold.certain_blocks(rows, {}) if b["certain"]}
    model = M.checked_debit(_rows(feed))
    place = {(r.txId, r.phase): r["_block"] for r in blocked.collect()}
    refused = {place[k] for k, (st, _) in model.items() if k in place and st == S.RETRY_BALANCE_NOT_ENOUGH}
    assert certain and refused and not certain & refused


def test_walk_equals_a_plain_loop(monkeypatch):
    rng = np.random.default_rng(1)
    for run in (1, 3, 256):
        monkeypatch.setattr(hotfold, "RUN", run)
        for top in (5, 50, 500):
            kinds = rng.integers(0, 3, 2000).astype(np.int8)
            cents = np.where(kinds == 1, rng.integers(0, 300, 2000), rng.integers(0, top, 2000))
            for start in (-20, 0, 1000):
                balance = start
                for k, c in zip(kinds.tolist(), cents.tolist()):
                    balance += c if k == 2 else -c if k == 1 and balance >= c else 0
                assert hotfold.walk(start, kinds, cents) == balance


def test_pending_list_equals_a_scan():
    rng = random.Random(1)
    for _ in range(150):
        tree, plain = PendingList(), []
        for step in range(rng.randrange(1, 200)):
            r = rng.random()
            if r < 0.6:
                amount = rng.randrange(50)
                tree.append((step, amount), amount)
                plain.append((step, amount))
            elif r < 0.7 and plain:
                assert tree.front() == plain[0] and tree.pop_front() == plain.pop(0)
            else:
                balance, want, kept = rng.randrange(120), [], []
                got = list(tree.release(balance))
                for x in plain:
                    if x[1] <= balance:
                        balance -= x[1]
                        want.append((x, balance))
                    else:
                        kept.append(x)
                plain = kept
                assert got == want
            assert len(tree) == len(plain) and tree.entries() == plain
        assert list(tree.drain()) == plain


def _pending_batch(n, seed):
    """n debits that must wait, then n small credits of one account."""
    rnd = random.Random(seed)
    amounts = [rnd.randrange(500, 100_000) for _ in range(n)] + [rnd.randrange(1, 600) for _ in range(n)]
    status = [S.CREATED] * n + [S.DEBIT_SUCCESS] * n
    names = debit._IN_SCHEMA.fieldNames()
    values = {"account": ["a"] * 2 * n, "txId": [f"t{i}" for i in range(2 * n)], "fromAccount": ["a"] * n + ["b"] * n,
              "toAccount": ["b"] * n + ["a"] * n, "amount": [x / 100 for x in amounts], "status": status,
              "instant": pa.array([i * 1000 for i in range(2 * n)], pa.timestamp("us", tz="UTC")),
              "retriedTimes": pa.array([0] * 2 * n, pa.int32()), "maxWaitTime": pa.array([0] * 2 * n, pa.int64()),
              "seq": list(range(2 * n)), "phase": pa.array([0] * 2 * n, pa.int32()), "_c": amounts,
              "_init": pa.nulls(2 * n, pa.int64()), "_kind": ["row"] * 2 * n, "_prio": pa.array([0] * 2 * n, pa.int32())}
    return pa.RecordBatch.from_pydict({c: values[c] for c in names})


def test_many_pending_debits_of_one_account_take_near_linear_time():
    def seconds(n):
        batch, fold = _pending_batch(n, 1), debit.make_fold(True, None)
        began = time.process_time()
        rows = sum(b.num_rows for b in fold(iter([batch])))
        assert rows == 2 * n
        return time.process_time() - began

    seconds(1_000)
    small, large = seconds(12_500), seconds(100_000)
    assert large < 8 * 3 * small                                  # a scan per credit would take 64 times as long


def test_many_pending_debits_equal_the_model():
    batch = _pending_batch(400, 2)
    rows = [{"txId": r["txId"], "fromAccount": r["fromAccount"], "toAccount": r["toAccount"], "cents": r["_c"],
             "instant": r["seq"], "seq": r["seq"], "phase": 0, "status": r["status"]} for r in batch.to_pylist()]
    got = {(r["txId"], r["phase"]): r["status"] for b in debit.make_fold(True, None)(iter([batch])) for r in b.to_pylist()}
    assert got == M.pending_debit(rows)


def test_rounds_count_busy_accounts_without_carried_balances(spark, monkeypatch):
    counted = []
    count = hotfold.busy_accounts

    def seen(keyed, *args):
        counted.append(keyed.where("_kind = 'balance'").count())
        return count(keyed, *args)

    monkeypatch.setattr(hotfold, "busy_accounts", seen)
    tx = transfers_from_rows(spark, [("t1", "external", "a", 5.0), ("t2", "a", "b", 3.0), ("t3", "b", "c", 9.0)])
    completed, _, rounds = workflow_retry(tx)
    assert rounds > 1 and counted == [0] * rounds
    assert sorted((r.txId, r.status) for r in completed.select("txId", "status").collect()) == [
        ("t1", S.FULFILLED), ("t2", S.FULFILLED), ("t3", S.CANCELLED_BALANCE_NOT_ENOUGH)]
