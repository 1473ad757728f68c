"""Plain-Python models of the transfer rules, used only to check the Spark
operators.  Rows are dicts with txId, fromAccount, toAccount, cents, instant
(sortable), seq, phase, status, retriedTimes."""

from __future__ import annotations

from collections import defaultdict

CREATED = "CREATED"
RETRY = "RETRY_BALANCE_NOT_ENOUGH"
DEBIT = "DEBIT_SUCCESS"
CANCEL = "CANCELLED_BALANCE_NOT_ENOUGH"
DONE = "FULFILLED"


def acting(r):
    return r["toAccount"] if r["status"] == DEBIT else r["fromAccount"]


def ext(r):
    return r["fromAccount"].lower() == "external"


def order_key(r):
    return (r["instant"], r["seq"], r["phase"])


def checked_debit(rows):
    """T2 per acting account; returns {(txId, phase): (status, balance_after)}."""
    by = defaultdict(list)
    for r in rows:
        by[acting(r)].append(r)
    out = {}
    for acct, rs in by.items():
        bal = 0
        for r in sorted(rs, key=order_key):
            st = r["status"]
            if st in (CREATED, RETRY):
                if ext(r) or bal - r["cents"] >= 0:
                    bal -= r["cents"]
                    st = DEBIT
                else:
                    st = RETRY
            elif st == DEBIT:
                bal += r["cents"]
                st = DONE
            out[(r["txId"], r["phase"])] = (st, bal)
    return out


def pending_debit(rows, max_wait_us=None):
    """T3 per acting account in event time; returns {(txId, phase): status}
    of every emitted row (failed debits appear once, when finally decided)."""
    by = defaultdict(list)
    for r in rows:
        by[acting(r)].append(r)
    out = {}
    for acct, rs in by.items():
        bal, pending = 0, []
        for r in sorted(rs, key=order_key):
            if max_wait_us is not None:
                while pending and pending[0][1] <= r["instant"]:
                    out[(pending[0][0]["txId"], pending[0][0]["phase"])] = CANCEL
                    pending.pop(0)
            if r["status"] == CREATED:
                if ext(r) or bal - r["cents"] >= 0:
                    bal -= r["cents"]
                    out[(r["txId"], r["phase"])] = DEBIT
                else:
                    pending.append((r, r["instant"] + (max_wait_us or 0)))
            elif r["status"] == DEBIT:
                bal += r["cents"]
                out[(r["txId"], r["phase"])] = DONE
                kept = []
                for p, due in pending:
                    if p["cents"] <= bal:
                        bal -= p["cents"]
                        out[(p["txId"], p["phase"])] = DEBIT
                    else:
                        kept.append((p, due))
                pending = kept
        for p, _ in pending:
            out[(p["txId"], p["phase"])] = CANCEL
    return out


def workflow(txs, pending_design: bool, max_retries: int = 5):
    """T7 / T8 in rounds; returns ({txId: (status, retriedTimes, round)}, balances, rounds)."""
    balances = defaultdict(int)
    pending = defaultdict(list)
    raw = [dict(t, status=CREATED, retriedTimes=0, phase=0) for t in txs]
    completed = {}
    rounds = 0
    while True:
        rounds += 1
        by = defaultdict(list)
        for r in raw:
            by[acting(r)].append(r)
        emitted = []
        for acct, rs in by.items():
            bal = balances[acct]
            rs.sort(key=lambda r: (0 if r["status"] == DEBIT else 1,) + order_key(r))
            for r in rs:
                st = r["status"]
                if pending_design:
                    if st == CREATED:
                        if ext(r) or bal - r["cents"] >= 0:
                            bal -= r["cents"]
                            emitted.append(dict(r, status=DEBIT))
                        else:
                            pending[acct].append(dict(r, status=RETRY))
                    elif st == DEBIT:
                        bal += r["cents"]
                        emitted.append(dict(r, status=DONE))
                        kept = []
                        for p in pending[acct]:
                            if p["cents"] <= bal:
                                bal -= p["cents"]
                                emitted.append(dict(p, status=DEBIT))
                            else:
                                kept.append(p)
                        pending[acct] = kept
                else:
                    if st in (CREATED, RETRY):
                        if ext(r) or bal - r["cents"] >= 0:
                            bal -= r["cents"]
                            emitted.append(dict(r, status=DEBIT))
                        else:
                            emitted.append(dict(r, status=RETRY))
                    elif st == DEBIT:
                        bal += r["cents"]
                        emitted.append(dict(r, status=DONE))
            balances[acct] = bal
        nxt = []
        for e in emitted:
            if e["status"] == DEBIT:
                nxt.append(dict(e, phase=e["phase"] + 1))
            elif e["status"] == DONE:
                completed[e["txId"]] = (DONE, e["retriedTimes"], rounds - 1)
            elif e["status"] == RETRY:
                if e["retriedTimes"] < max_retries:
                    nxt.append(dict(e, retriedTimes=e["retriedTimes"] + 1))
                else:
                    completed[e["txId"]] = (CANCEL, e["retriedTimes"], rounds - 1)
        raw = nxt
        if not raw:
            break
    for acct, ps in pending.items():
        for p in ps:
            completed[p["txId"]] = (CANCEL, p["retriedTimes"], rounds)
    return completed, dict(balances), rounds
