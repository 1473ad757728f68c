"""Stateful stream operators as ``transformWithStateInPandas`` processors.

Each processor keeps per-key state in the RocksDB state store (checkpointed
with the query), handles the rows of one key per micro-batch as pandas
frames, and uses timers where the rule waits.  Inside a micro-batch, rows of
a key are applied in ``(instant, seq, phase)`` order, the same order the
bounded operators use, so a stream and a batch over the same input agree.

Money in state is integer cents.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tributary import schemas as S

# The transformWithState driver-side worker does not see files added with
# addPyFile, so processors (and the constants they use) travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(S)

# Output of the transfer processors: the transfer with its new status and the
# acting account's balance after it.
TX_OUT = T.StructType([
    T.StructField("account", T.StringType()),
    T.StructField("txId", T.StringType()),
    T.StructField("fromAccount", T.StringType()),
    T.StructField("toAccount", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("instant", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("retriedTimes", T.IntegerType()),
    T.StructField("maxWaitTime", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("phase", T.IntegerType()),
    T.StructField("balance_after", T.DoubleType()),
])
_TX_FIELDS = TX_OUT.fieldNames()
_PENDING_SCHEMA = ("txId string, fromAccount string, toAccount string, amount double, "
                   "instant_us long, retriedTimes int, seq long, phase int, cents long, deadline_ms long")


def whole_cents(amount):
    """Integer cents of amounts; half a cent rounds away from zero, as Spark's ``round`` does."""
    hundredfold = np.asarray(amount, dtype=np.float64) * 100
    return (np.sign(hundredfold) * np.floor(np.abs(hundredfold) + 0.5)).astype(np.int64)


def _ordered(rows, credits_first: bool = False) -> pd.DataFrame:
    frames = [f for f in rows if len(f)]
    if not frames:
        return pd.DataFrame()
    pdf = pd.concat(frames, ignore_index=True)
    if credits_first:
        # workflow mode: inside one micro-batch (one round) credits go first
        pdf["_prio"] = (pdf["status"] != S.DEBIT_SUCCESS).astype(int)
        return pdf.sort_values(["_prio", *S.ORDER], kind="stable").drop(columns="_prio")
    return pdf.sort_values(list(S.ORDER), kind="stable")


def _frame(records: list[dict]) -> pd.DataFrame:
    pdf = pd.DataFrame.from_records(records, columns=_TX_FIELDS)
    # Session zone is UTC: naive input instants are UTC wall clock.
    pdf["instant"] = pd.to_datetime(pdf["instant"], utc=True)
    return pdf


def _is_external(name) -> bool:
    return isinstance(name, str) and name.lower() == S.EXTERNAL_ACCOUNT


class CheckedDebitProcessor(StatefulProcessor):
    """T2 keyed by acting account: value state ``balance`` (cents), no timers.

    The key's rows are sorted with numpy and the input frame is passed through
    with ``status`` and ``balance_after`` replaced (no per-row frame building).
    """

    def __init__(self, credits_first: bool = False):
        self.credits_first = credits_first

    def init(self, handle) -> None:
        self.balance = handle.getValueState("balance", "cents long")

    def handleInputRows(self, key, rows, timerValues):
        frames = [f for f in rows if len(f)]
        if not frames:
            return
        pdf = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
        sort_keys = [pdf["phase"].to_numpy(), pdf["seq"].to_numpy(), pdf["instant"].to_numpy()]
        if self.credits_first:
            sort_keys.append((pdf["status"].to_numpy() != S.DEBIT_SUCCESS).astype(np.int8))
        pdf = pdf.iloc[np.lexsort(sort_keys)]
        state = self.balance.get()
        bal = state[0] if state else 0
        statuses = pdf["status"].tolist()
        cents = whole_cents(pdf["amount"].to_numpy()).tolist()
        payers = pdf["fromAccount"].tolist()
        new_status, balances = [], []
        for st, c, frm in zip(statuses, cents, payers):
            if st == S.CREATED or st == S.RETRY_BALANCE_NOT_ENOUGH:
                if _is_external(frm) or bal - c >= 0:
                    bal -= c
                    st = S.DEBIT_SUCCESS
                else:
                    st = S.RETRY_BALANCE_NOT_ENOUGH
            elif st == S.DEBIT_SUCCESS:
                bal += c
                st = S.FULFILLED
            new_status.append(st)
            balances.append(bal)
        self.balance.update((bal,))
        yield pdf.assign(status=new_status,
                         balance_after=np.asarray(balances, dtype=np.float64) / 100.0)[_TX_FIELDS]

    def close(self) -> None:
        pass


class PendingDebitProcessor(StatefulProcessor):
    """T3 keyed by acting account: ``balance`` plus list state ``pending``, and
    one timer per pending debit at its deadline (event or processing time).
    A timer that fires up to ``slack_ms`` early still cancels."""

    def __init__(self, max_wait_ms: int | None = S.PENDING_MAX_WAIT_MS,
                 slack_ms: int = S.PENDING_TIMER_SLACK_MS, event_time: bool = True,
                 credits_first: bool = False):
        self.max_wait_ms = max_wait_ms   # None: wait without a deadline (no timers)
        self.slack_ms = slack_ms
        self.event_time = event_time
        self.credits_first = credits_first

    def init(self, handle) -> None:
        self.handle = handle
        self.balance = handle.getValueState("balance", "cents long")
        self.pending = handle.getListState("pending", _PENDING_SCHEMA)

    def _emit(self, key, p, status, bal):
        return {"account": key, "txId": p[0], "fromAccount": p[1], "toAccount": p[2], "amount": p[3],
                "instant": pd.Timestamp(p[4], unit="us", tz="UTC"), "status": status,
                "retriedTimes": p[5], "maxWaitTime": p[9] if p[9] is not None else 0, "seq": p[6], "phase": p[7],
                "balance_after": bal / 100.0}

    def handleInputRows(self, key, rows, timerValues):
        pdf = _ordered(rows, self.credits_first)
        if pdf.empty:
            return
        account = key[0]
        bal = self.balance.get()[0] if self.balance.exists() else 0
        pending = list(self.pending.get()) if self.pending.exists() else []
        out = []
        for r in pdf.itertuples(index=False):
            st, c = r.status, int(whole_cents(r.amount))
            us = int(pd.Timestamp(r.instant).value // 1000)
            if st == S.CREATED:
                if _is_external(r.fromAccount) or bal - c >= 0:
                    bal -= c
                    rec = r._asdict()
                    rec.update(status=S.DEBIT_SUCCESS, balance_after=bal / 100.0)
                    out.append(rec)
                else:
                    base = us // 1000 if self.event_time else timerValues.getCurrentProcessingTimeInMs()
                    deadline = None if self.max_wait_ms is None else base + self.max_wait_ms
                    pending.append((r.txId, r.fromAccount, r.toAccount, float(r.amount), us,
                                    int(r.retriedTimes), int(r.seq), int(r.phase), c, deadline))
                    if deadline is not None:
                        self.handle.registerTimer(deadline)
            elif st == S.DEBIT_SUCCESS:
                bal += c
                rec = r._asdict()
                rec.update(status=S.FULFILLED, balance_after=bal / 100.0)
                out.append(rec)
                kept = []
                for p in pending:
                    if p[8] <= bal:
                        bal -= p[8]
                        out.append(self._emit(account, p, S.DEBIT_SUCCESS, bal))
                    else:
                        kept.append(p)
                pending = kept
            # other statuses, RETRY included, are dropped by this design
        self.balance.update((bal,))
        self.pending.clear()
        if pending:
            self.pending.put(pending)
        if out:
            yield _frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        fired = expiredTimerInfo.getExpiryTimeInMs()
        bal = self.balance.get()[0] if self.balance.exists() else 0
        pending = list(self.pending.get()) if self.pending.exists() else []
        out, kept = [], []
        for p in pending:
            if p[9] is not None and fired + self.slack_ms >= p[9]:
                out.append(self._emit(key[0], p, S.CANCELLED_BALANCE_NOT_ENOUGH, bal))
            else:
                kept.append(p)
        self.pending.clear()
        if kept:
            self.pending.put(kept)
        if out:
            yield _frame(out)

    def close(self) -> None:
        pass


RETRY_OUT = T.StructType([
    T.StructField("txId", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("retriedTimes", T.IntegerType()),
    T.StructField("route", T.StringType()),
    T.StructField("due_ms", T.LongType()),
])


class WaitRetryProcessor(StatefulProcessor):
    """T4 keyed by txId: under 5 retries, wait the backoff then emit to the retry
    route with counter+1 (status still RETRY); otherwise cancel at once.
    Waiting transfers are a list per txId (a second arrival does not overwrite
    the first)."""

    def __init__(self, event_time: bool = True):
        self.event_time = event_time

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "retriedTimes int, due_ms long")

    def handleInputRows(self, key, rows, timerValues):
        pdf = _ordered(rows)
        if pdf.empty:
            return
        out = []
        for r in pdf.itertuples(index=False):
            n = int(r.retriedTimes)
            if n < S.MAX_RETRIES:
                base = (int(pd.Timestamp(r.instant).value // 1_000_000) if self.event_time
                        else timerValues.getCurrentProcessingTimeInMs())
                delay = min(S.RETRY_BASE_MS * S.RETRY_FACTOR ** n, S.RETRY_MAX_WAIT_MS)
                self.waiting.appendValue((n, base + delay))
                self.handle.registerTimer(base + delay)
            else:
                out.append({"txId": key[0], "status": S.CANCELLED_BALANCE_NOT_ENOUGH,
                            "retriedTimes": n, "route": "cancel", "due_ms": None})
        if out:
            yield pd.DataFrame(out, columns=RETRY_OUT.fieldNames())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        fired = expiredTimerInfo.getExpiryTimeInMs()
        items = list(self.waiting.get()) if self.waiting.exists() else []
        out, kept = [], []
        for n, due in items:
            if due <= fired:
                out.append({"txId": key[0], "status": S.RETRY_BALANCE_NOT_ENOUGH,
                            "retriedTimes": n + 1, "route": "retry", "due_ms": due})
            else:
                kept.append((n, due))
        self.waiting.clear()
        if kept:
            self.waiting.put(kept)
        if out:
            yield pd.DataFrame(out, columns=RETRY_OUT.fieldNames())

    def close(self) -> None:
        pass


# A transfer with its ordering columns plus the topic it is routed to.
RECORD_OUT = T.StructType([
    T.StructField("txId", T.StringType()),
    T.StructField("fromAccount", T.StringType()),
    T.StructField("toAccount", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("instant", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("retriedTimes", T.IntegerType()),
    T.StructField("maxWaitTime", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("phase", T.IntegerType()),
    T.StructField("topic", T.StringType()),
])
_WAITING_SCHEMA = ("txId string, fromAccount string, toAccount string, amount double, instant_us long, "
                   "retriedTimes int, seq long, phase int, due_ms long")


class WaitRetryRecordProcessor(StatefulProcessor):
    """The wait stage of the topic workflow (T4 wired into T7), keyed by txId.

    Keeps each waiting transfer whole in list state; when its backoff timer
    fires, republishes it to the raw topic with counter+1 (status still
    RETRY, ``maxWaitTime`` = the due time).  A transfer already retried 5
    times goes to the completed topic as CANCELLED at once.  Processing time
    by default (the live design), event time optionally."""

    def __init__(self, event_time: bool = False, raw_topic: str = S.TOPIC_RAW,
                 completed_topic: str = S.TOPIC_COMPLETED):
        self.event_time = event_time
        self.raw_topic = raw_topic
        self.completed_topic = completed_topic

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _WAITING_SCHEMA)

    def _record(self, w, status, retried, due, topic):
        return {"txId": w[0], "fromAccount": w[1], "toAccount": w[2], "amount": w[3],
                "instant": pd.Timestamp(w[4], unit="us", tz="UTC"), "status": status,
                "retriedTimes": retried, "maxWaitTime": due, "seq": w[6], "phase": w[7], "topic": topic}

    def _frame(self, records):
        pdf = pd.DataFrame.from_records(records, columns=RECORD_OUT.fieldNames())
        pdf["instant"] = pd.to_datetime(pdf["instant"], utc=True)
        return pdf

    def handleInputRows(self, key, rows, timerValues):
        pdf = _ordered(rows)
        if pdf.empty:
            return
        out = []
        for r in pdf.itertuples(index=False):
            n = int(r.retriedTimes)
            us = int(pd.Timestamp(r.instant).value // 1000)
            w = (r.txId, r.fromAccount, r.toAccount, float(r.amount), us, n, int(r.seq), int(r.phase), 0)
            if n < S.MAX_RETRIES:
                base = us // 1000 if self.event_time else timerValues.getCurrentProcessingTimeInMs()
                due = base + min(S.RETRY_BASE_MS * S.RETRY_FACTOR ** n, S.RETRY_MAX_WAIT_MS)
                self.waiting.appendValue(w[:8] + (due,))
                self.handle.registerTimer(due)
            else:
                out.append(self._record(w, S.CANCELLED_BALANCE_NOT_ENOUGH, n, int(r.maxWaitTime or 0),
                                        self.completed_topic))
        if out:
            yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        fired = expiredTimerInfo.getExpiryTimeInMs()
        items = list(self.waiting.get()) if self.waiting.exists() else []
        out, kept = [], []
        for w in items:
            if w[8] <= fired:
                out.append(self._record(w, S.RETRY_BALANCE_NOT_ENOUGH, w[5] + 1, w[8], self.raw_topic))
            else:
                kept.append(w)
        self.waiting.clear()
        if kept:
            self.waiting.put(kept)
        if out:
            yield self._frame(out)

    def close(self) -> None:
        pass


ECHO_OUT = T.StructType([
    T.StructField("word", T.StringType()),
    T.StructField("echo_ms", T.LongType()),
])


class DelayedEchoProcessor(StatefulProcessor):
    """T5 keyed by word: each arrival is echoed ``delay_ms`` later by a timer.
    The remembered arrivals are keyed state (each key echoes its own word)."""

    def __init__(self, delay_ms: int = S.ECHO_DELAY_MS, event_time: bool = True, ts_col: str = "ts"):
        self.delay_ms = delay_ms
        self.event_time = event_time
        self.ts_col = ts_col

    def init(self, handle) -> None:
        self.handle = handle
        self.due = handle.getListState("due", "due_ms long")

    def handleInputRows(self, key, rows, timerValues):
        for pdf in rows:
            for ts in pdf[self.ts_col]:
                base = (int(pd.Timestamp(ts).value // 1_000_000) if self.event_time
                        else timerValues.getCurrentProcessingTimeInMs())
                self.due.appendValue((base + self.delay_ms,))
                self.handle.registerTimer(base + self.delay_ms)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        fired = expiredTimerInfo.getExpiryTimeInMs()
        items = [d[0] for d in self.due.get()] if self.due.exists() else []
        now = [d for d in items if d <= fired]
        later = [(d,) for d in items if d > fired]
        self.due.clear()
        if later:
            self.due.put(later)
        if now:
            yield pd.DataFrame({"word": [key[0]] * len(now), "echo_ms": now})

    def close(self) -> None:
        pass


BLOCK_OUT = T.StructType([T.StructField("key", T.StringType()),
                          T.StructField("value", T.StringType())])


class ControlBlockProcessor(StatefulProcessor):
    """A tagged union of control and data rows keyed by value; a control
    row sets ``blocked``; a data row passes only while its key is unblocked.
    Rows of one micro-batch are applied in their ``seq`` (arrival) order."""

    def init(self, handle) -> None:
        self.blocked = handle.getValueState("blocked", "b boolean")

    def handleInputRows(self, key, rows, timerValues):
        frames = [f for f in rows if len(f)]
        if not frames:
            return
        pdf = pd.concat(frames).sort_values("seq", kind="stable")
        blocked = self.blocked.exists()
        out = []
        for tag, value in zip(pdf["tag"], pdf["value"]):
            if tag == "control":
                blocked = True
            elif not blocked:
                out.append(value)
        if blocked:
            self.blocked.update((True,))
        if out:
            yield pd.DataFrame({"key": [key[0]] * len(out), "value": out})

    def close(self) -> None:
        pass


CONNECT_OUT = T.StructType([
    T.StructField("account", T.StringType()),
    T.StructField("txId", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("balance_after", T.DoubleType()),
])


def _in_order(rows) -> pd.DataFrame | None:
    """All rows of a key in this micro-batch, in (instant, seq, phase) order; None without rows."""
    frames = [f for f in rows if len(f)]
    if not frames:
        return None
    pdf = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
    return pdf.iloc[np.lexsort([pdf["phase"].to_numpy(), pdf["seq"].to_numpy(), pdf["instant"].to_numpy()])]


class SelfConnectProcessor(StatefulProcessor):
    """J2 keyed by account: two keyings of one stream of transfers, by payer and
    by payee, meet as tagged legs and share one value state ``balance``."""

    def init(self, handle) -> None:
        self.balance = handle.getValueState("balance", "cents long")

    def handleInputRows(self, key, rows, timerValues):
        pdf = _in_order(rows)
        if pdf is None:
            return
        state = self.balance.get()
        after = (state[0] if state else 0) + np.cumsum(whole_cents(pdf["amount"].to_numpy()))
        self.balance.update((int(after[-1]),))
        yield pdf.assign(balance_after=after / 100.0)[CONNECT_OUT.fieldNames()]

    def close(self) -> None:
        pass


STAGE_IN = ["txId", "fromAccount", "toAccount", "amount", "instant", "seq", "phase", "status"]


def stage_schema(*balances: str) -> T.StructType:
    """Transfers with the balances that the stages so far have added."""
    kinds = {f.name: f for f in TX_OUT.fields}
    return T.StructType([kinds[c] for c in STAGE_IN] + [T.StructField(b, T.DoubleType()) for b in balances])


# Slots of a bucket: one entry of the map state holds all accounts (or transfers) of a slot.
SLOTS = 64
_BALANCES = "account array<string>, cents array<long>"


class _Balances:
    """Balances of a bucket's accounts: an entry of the map state for each slot of accounts, read and written once
    in a micro-batch that touches it (every access is a call out of Python, and so is every key)."""

    def __init__(self, handle):
        self.state = handle.getMapState("balances", "slot int", _BALANCES)

    def read(self, accounts: list, slots: list) -> dict[int, dict]:
        self.slot_of = dict(zip(accounts, slots))
        found = {slot: self.state.getValue((slot,)) for slot in sorted(set(slots))}
        self.held = {slot: dict(zip(*row)) if row else {} for slot, row in found.items()}
        return {a: self.held[slot].get(a, 0) for a, slot in self.slot_of.items()}

    def write(self, balances: dict) -> None:
        for account, cents in balances.items():
            self.held[self.slot_of[account]][account] = cents
        for slot, held in self.held.items():
            self.state.updateValue((slot,), (list(held), list(held.values())))


def _names(column) -> list:
    return [None if pd.isna(v) else v for v in column]


class StageProcessor(StatefulProcessor):
    """One stage of A5, keyed by a bucket of the accounts it moves: adds ``sign``
    times the amount to the account's balance, sets the status, adds the balance column."""

    def __init__(self, sign: int, status: str, account: str, column: str, columns: list[str]):
        self.sign, self.status, self.account, self.column, self.columns = sign, status, account, column, columns

    def init(self, handle) -> None:
        self.balances = _Balances(handle)

    def handleInputRows(self, key, rows, timerValues):
        pdf = _in_order(rows)
        if pdf is None:
            return
        codes, names = pd.factorize(pdf[self.account], use_na_sentinel=False)
        names = _names(names)
        first = np.unique(codes, return_index=True)[1]
        before = self.balances.read(names, pdf["slot"].to_numpy()[first].tolist())
        order = np.argsort(codes, kind="stable")                # by account, in the order of its rows
        moves = (self.sign * whole_cents(pdf["amount"].to_numpy()))[order]
        counts = np.bincount(codes)
        total, ends = np.cumsum(moves), np.cumsum(counts)
        start = np.array([before[a] for a in names], dtype=np.int64) - np.concatenate(([0], total[ends[:-1] - 1]))
        after = np.empty(len(pdf), dtype=np.int64)
        after[order] = total + np.repeat(start, counts)
        self.balances.write(dict(zip(names, (total[ends - 1] + start).tolist())))
        yield pdf.assign(**{"status": self.status, self.column: after / 100.0})[self.columns]

    def close(self) -> None:
        pass


class BucketDebitProcessor(StatefulProcessor):
    """T2 keyed by a bucket of acting accounts: the rule of ``CheckedDebitProcessor``, the rows of many accounts at once."""

    def init(self, handle) -> None:
        self.balances = _Balances(handle)

    def handleInputRows(self, key, rows, timerValues):
        pdf = _in_order(rows)
        if pdf is None:
            return
        accounts = _names(pdf["account"])
        now = self.balances.read(accounts, pdf["slot"].tolist())
        new_status, balances = [], []
        for a, st, c, frm in zip(accounts, pdf["status"].tolist(), whole_cents(pdf["amount"].to_numpy()).tolist(),
                                 pdf["fromAccount"].tolist()):
            if st == S.CREATED or st == S.RETRY_BALANCE_NOT_ENOUGH:
                if _is_external(frm) or now[a] - c >= 0:
                    now[a] -= c
                    st = S.DEBIT_SUCCESS
                else:
                    st = S.RETRY_BALANCE_NOT_ENOUGH
            elif st == S.DEBIT_SUCCESS:
                now[a] += c
                st = S.FULFILLED
            new_status.append(st)
            balances.append(now[a])
        self.balances.write(now)
        yield pdf.assign(status=new_status,
                         balance_after=np.asarray(balances, dtype=np.float64) / 100.0)[_TX_FIELDS]

    def close(self) -> None:
        pass


ENRICHED_OUT = T.StructType([
    T.StructField("txId", T.StringType()),
    T.StructField("account", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("phase", T.IntegerType()),
    T.StructField("tx_status", T.StringType()),
])


_SLOT_SCHEMA = "txId array<string>, status array<string>, put_ms array<long>"


class MapEnrichProcessor(StatefulProcessor):
    """Legs meet the map txId -> status, kept as map state.

    The key is a bucket of transfers, so one call handles many of them, and an
    entry of the state is a slot of the bucket, since every access to the state
    is a call out of Python: a micro-batch reads and writes each slot once that
    its transfers lie in.  Inside a micro-batch the state events are put into the
    map first, the last one of a transfer by (instant, seq, phase).  A transfer
    that is not put again for ``ttl_ms`` leaves the map (None: never)."""

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle) -> None:
        more = {} if self.ttl_ms is None else {"ttlDurationMs": self.ttl_ms}
        self.states = handle.getMapState("states", "slot int", _SLOT_SCHEMA, **more)

    def handleInputRows(self, key, rows, timerValues):
        pdf = _in_order(rows)
        if pdf is None:
            return
        at = 0 if self.ttl_ms is None else int(timerValues.getCurrentProcessingTimeInMs())
        is_state = (pdf["tag"] == "state").to_numpy()
        now = dict(zip(pdf["txId"][is_state], pdf["status"][is_state]))
        legs = pdf[~is_state]
        slot_of = dict(zip(pdf["txId"], pdf["slot"].tolist()))
        put, asked = {}, {}
        for tx in now:
            put.setdefault(slot_of[tx], []).append(tx)
        for tx in set(legs["txId"]) - set(now):
            asked.setdefault(slot_of[tx], []).append(tx)
        for slot in sorted(set(put) | set(asked)):
            found = self.states.getValue((slot,))
            held = {tx: (status, ms) for tx, status, ms in zip(*found)
                    if self.ttl_ms is None or ms + self.ttl_ms > at} if found else {}
            for tx in asked.get(slot, ()):
                now[tx] = held[tx][0] if tx in held else None
            if slot in put:
                held.update((tx, (now[tx], at)) for tx in put[slot])
                self.states.updateValue((slot,), (list(held), [s for s, _ in held.values()], [ms for _, ms in held.values()]))
        if len(legs):
            yield legs.assign(tx_status=[now[tx] for tx in legs["txId"]])[ENRICHED_OUT.fieldNames()]

    def close(self) -> None:
        pass
