"""Checked debit / credit per account (T2) and the pending-list variant.

Whether a debit succeeds depends on every debit of the same account accepted
before it, so no window expression gives the answer: each account is folded
in order.  Plan:

    feed -> acting account -> split:
      * accounts named ``external`` (any case): every debit is approved by
        predicate, credits are plain adds, so their balance is a blocked
        running sum, computed in parallel (this is the hot key: it pays every
        deposit);
      * all other accounts: ``repartition(account)`` ->
        ``sortWithinPartitions(account, instant, seq, phase)`` -> ``mapInArrow``
        fold that streams Arrow batches and carries one balance (T2) or one
        balance plus the account's pending list (T3) across batches.

One shuffle for the fold; memory is O(1) per task for T2 and O(pending) for
T3 (pending entries expire after ``max_wait``).  Accounts too busy for one task
are folded in blocks (T2, ``operators.hotfold``); a credit finds the pending
debits it can pay in a logarithm of their number (T3, ``operators.pending``).
Money is integer cents.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary import schemas as S
from tributary.functions.ledger import acting_account, cents, from_cents, is_external
from tributary.operators import hotfold
from tributary.operators.legs import running_balance
from tributary.operators.pending import PendingList

# Columns the folds read, in this order (positions are used inside the fold).
_IN_SCHEMA = T.StructType([
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
    T.StructField("_c", T.LongType()),        # amount in cents
    T.StructField("_init", T.LongType()),     # balance of the account before this input (null = 0)
    T.StructField("_kind", T.StringType()),   # 'row'; 'pending' / 'balance' for carried state
    T.StructField("_prio", T.IntegerType()),  # sort rank inside the account before the ORDER columns
])
_PASS = 11  # the first 11 columns pass through to the output
OUT_SCHEMA = T.StructType(_IN_SCHEMA.fields[:_PASS] + [
    T.StructField("_kind", T.StringType()),   # 'out' (emitted) or 'pending' (still waiting at end)
    T.StructField("_bal", T.LongType()),      # acting account's balance after the row, cents
])
_ARROW_OUT = pa.schema([
    ("account", pa.string()), ("txId", pa.string()), ("fromAccount", pa.string()),
    ("toAccount", pa.string()), ("amount", pa.float64()), ("instant", pa.timestamp("us", tz="UTC")),
    ("status", pa.string()), ("retriedTimes", pa.int32()), ("maxWaitTime", pa.int64()),
    ("seq", pa.int64()), ("phase", pa.int32()), ("_kind", pa.string()), ("_bal", pa.int64()),
])


def first_round_feed(tx: DataFrame) -> DataFrame:
    """Raw topic of the first round: every transfer (phase 0) plus, for deposits
    from ``external`` (always approved), their DEBIT_SUCCESS echo (phase 1)."""
    phases = F.when(is_external(F.col("fromAccount")), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (tx.withColumn("phase", F.explode(phases))
            .withColumn("status", F.when(F.col("phase") == 1, F.lit(S.DEBIT_SUCCESS))
                        .otherwise(F.col("status"))))


def keyed_feed(tx: DataFrame) -> DataFrame:
    """Fold input: acting account, cents, and the optional carried columns."""
    cols = set(tx.columns)
    return tx.select(
        acting_account(F.col("status"), F.col("fromAccount"), F.col("toAccount")).alias("account"),
        "txId", "fromAccount", "toAccount", "amount", "instant", "status",
        F.col("retriedTimes").cast("int").alias("retriedTimes"),
        F.col("maxWaitTime").cast("long").alias("maxWaitTime"),
        F.col("seq").cast("long").alias("seq"), F.col("phase").cast("int").alias("phase"),
        cents(F.col("amount")).alias("_c"),
        (F.col("_init") if "_init" in cols else F.lit(None)).cast("long").alias("_init"),
        (F.col("_kind") if "_kind" in cols else F.lit("row")).cast("string").alias("_kind"),
        (F.col("_prio") if "_prio" in cols else F.lit(0)).cast("int").alias("_prio"))


def _unconditional(keyed: DataFrame, pending_design: bool, emit_balance: bool = False,
                   running: bool = True) -> DataFrame:
    """Rows of ``external`` accounts: debits always pass, credits add, so the
    balance is a running sum (blocked, parallel) plus the carried balance.
    ``running=False`` skips the per-row balance (``_bal`` null)."""
    st, kind, c = F.col("status"), F.col("_kind"), F.col("_c")
    debit = st == S.CREATED if pending_design else st.isin(S.CREATED, S.RETRY_BALANCE_NOT_ENOUGH)
    credit = st == S.DEBIT_SUCCESS
    delta = F.when(debit, -c).when(credit, c).otherwise(F.lit(0).cast("long"))
    new_status = (F.when(debit, F.lit(S.DEBIT_SUCCESS)).when(credit, F.lit(S.FULFILLED))
                  .otherwise(st).alias("status"))
    keep = (kind == "row") & (debit | credit) if pending_design else (kind == "row")  # v2 drops the rest
    passing = [new_status if f == "status" else F.col(f) for f in _IN_SCHEMA.fieldNames()[:_PASS]]
    if running:
        # Only accounts named external take this path: a few case variants at
        # most, so their carried balances are a provably tiny broadcast.
        init = (keyed.where(kind == "balance").groupBy("account")
                .agg(F.sum("_c").alias("_carried")))
        rows = (keyed.where(keep).join(F.broadcast(init), "account", "left")
                .select(*passing, delta.alias("_d"),
                        F.coalesce(F.col("_init"), F.col("_carried"), F.lit(0).cast("long")).alias("_i")))
        out = running_balance(rows, "account", "_d", "_run", as_cents=True)
        result = out.select(*_IN_SCHEMA.fieldNames()[:_PASS], F.lit("out").alias("_kind"),
                            (F.col("_run") + F.col("_i")).alias("_bal"))
    else:
        result = keyed.where(keep).select(*passing, F.lit("out").alias("_kind"),
                                          F.lit(None).cast("long").alias("_bal"))
    if emit_balance:
        closing = (keyed.groupBy("account")
                   .agg(F.sum(F.when(kind == "balance", c).when(keep, delta)
                              .otherwise(F.lit(0).cast("long"))).alias("_bal")))
        result = result.unionByName(closing.select(
            "account", *[F.lit(None).cast(f.dataType).alias(f.name) for f in _IN_SCHEMA.fields[1:_PASS]],
            F.lit("balance").alias("_kind"), "_bal"))
    return result


def make_fold(pending_design: bool, max_wait_ms: int | None = S.PENDING_MAX_WAIT_MS,
              keep_pending: bool = False, emit_balance: bool = False):
    """Build the per-partition fold.

    Rows arrive sorted by (account, _prio, instant, seq, phase).  v1 rules
    (``pending_design=False``, T2) or pending-list rules (T3).  For T3, a
    pending debit is cancelled once the account's next row is at or past its
    deadline (``max_wait_ms`` None = no deadline); at the end of an account's
    input the rest is cancelled, or, with ``keep_pending``, emitted as
    ``_kind='pending'`` rows so a later round can carry them on.  With
    ``emit_balance`` each account also ends with one ``_kind='balance'`` row
    holding its closing balance.
    """
    types = [f.type for f in _ARROW_OUT]
    instant_type = _ARROW_OUT.field("instant").type

    def fold_v1(batches):
        """T2 fast path: one output row per input row, so the input Arrow
        columns pass through and only status, kind and balance are rebuilt."""
        current, bal = None, 0
        closing = []                   # (account, balance) at each account end
        for batch in batches:
            acc = batch.column(0).to_pylist()
            frm = batch.column(2).to_pylist()
            sts = batch.column(6).to_pylist()
            cts = batch.column(11).to_pylist()
            init = batch.column(12).to_pylist()
            kinds = batch.column(13).to_pylist()
            keep, new_status, bals = [], [], []
            for i, (a, st, c) in enumerate(zip(acc, sts, cts)):
                if a != current:
                    if emit_balance and current is not None:
                        closing.append((current, bal))
                    current, bal = a, (init[i] or 0)
                if kinds[i] == "balance":
                    bal = c
                    continue
                if st == S.CREATED or st == S.RETRY_BALANCE_NOT_ENOUGH:
                    if (frm[i] or "").lower() == S.EXTERNAL_ACCOUNT or bal - c >= 0:
                        bal -= c
                        st = S.DEBIT_SUCCESS
                    else:
                        st = S.RETRY_BALANCE_NOT_ENOUGH
                elif st == S.DEBIT_SUCCESS:
                    bal += c
                    st = S.FULFILLED
                keep.append(i)
                new_status.append(st)
                bals.append(bal)
            if keep:
                taken = batch.take(pa.array(keep, pa.int64())) if len(keep) < batch.num_rows else batch
                arrays = [taken.column(j) for j in range(_PASS)]
                arrays[6] = pa.array(new_status, pa.string())
                arrays += [pa.array(["out"] * len(keep), pa.string()), pa.array(bals, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, schema=_ARROW_OUT)
        if emit_balance and current is not None:
            closing.append((current, bal))
        if closing:
            accounts, balances = zip(*closing)
            n = len(accounts)
            arrays = [pa.array(accounts, pa.string())]
            arrays += [pa.nulls(n, type=f.type) for f in list(_ARROW_OUT)[1:_PASS]]
            arrays += [pa.array(["balance"] * n, pa.string()), pa.array(balances, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, schema=_ARROW_OUT)

    def fold(batches):
        out = []                       # emitted rows: first 11 fields + kind + balance
        current, bal, pending = None, 0, PendingList()

        def close_account():
            nonlocal pending
            for p in pending.drain():
                if keep_pending:
                    out.append((*p[:_PASS], "pending", bal))
                else:
                    out.append((*p[:6], S.CANCELLED_BALANCE_NOT_ENOUGH, *p[7:_PASS], "out", bal))
            pending = PendingList()
            if emit_balance and current is not None:
                out.append((current,) + (None,) * (_PASS - 1) + ("balance", bal))

        def flush():
            cols = list(zip(*out))
            arrays = [pa.array(c, type=instant_type if j == 5 else types[j])
                      for j, c in enumerate(cols)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, schema=_ARROW_OUT)

        for batch in batches:
            cols = [batch.column(j).cast(pa.int64()).to_pylist() if j == 5 else batch.column(j).to_pylist()
                    for j in range(batch.num_columns)]  # instant as µs
            for row in zip(*cols):
                acc, st, c = row[0], row[6], row[11]
                if acc != current:
                    close_account()
                    current, bal = acc, (row[12] or 0)
                if row[13] == "balance":
                    # carried balance of the account (sorts first): seed and emit nothing
                    bal = c
                    continue
                now_ms = row[5] // 1000
                if max_wait_ms is not None:
                    while pending and pending.front()[8] <= now_ms:
                        p = pending.pop_front()
                        out.append((*p[:6], S.CANCELLED_BALANCE_NOT_ENOUGH, *p[7:_PASS], "out", bal))
                if row[13] == "pending":
                    pending.append(row, c)
                elif st == S.CREATED:
                    if (row[2] or "").lower() == S.EXTERNAL_ACCOUNT or bal - c >= 0:
                        bal -= c
                        out.append((*row[:6], S.DEBIT_SUCCESS, *row[7:_PASS], "out", bal))
                    else:
                        deadline = 0 if max_wait_ms is None else now_ms + max_wait_ms
                        pending.append((*row[:6], S.RETRY_BALANCE_NOT_ENOUGH, row[7], deadline, *row[9:]), c)
                elif st == S.DEBIT_SUCCESS:
                    bal += c
                    out.append((*row[:6], S.FULFILLED, *row[7:_PASS], "out", bal))
                    for p, bal in pending.release(bal):
                        out.append((*p[:6], S.DEBIT_SUCCESS, *p[7:_PASS], "out", bal))
                # any other status (an incoming RETRY too) is dropped by this design
            if out:
                yield flush()
        close_account()
        if out:
            yield flush()

    return fold if pending_design else fold_v1


def fold_accounts(keyed: DataFrame, fold_fn, num_partitions: int | None = None) -> DataFrame:
    """Hash-partition by account, sort inside partitions, run the fold."""
    # An explicit count on purpose: AQE would coalesce a small shuffle into a
    # few partitions and serialise the CPU-bound fold.
    parts = int(num_partitions or keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (keyed.repartition(parts, "account")
               .sortWithinPartitions("account", "_prio", *S.ORDER))
    return ordered.mapInArrow(fold_fn, OUT_SCHEMA)


def run_fold(tx: DataFrame, pending_design: bool, max_wait_ms: int | None = None,
             keep_pending: bool = False, emit_balance: bool = False,
             num_partitions: int | None = None, external_running: bool = True,
             busy_rows: int = hotfold.BUSY_ROWS) -> DataFrame:
    """All paths of the plan; output has ``_kind`` and ``_bal`` (cents).
    With ``external_running=False`` rows of external accounts get no per-row
    balance (``_bal`` null); their closing balance still comes out with
    ``emit_balance``.  T2 accounts of more than ``busy_rows`` rows are folded in
    blocks by many tasks."""
    keyed = keyed_feed(tx)
    hot = is_external(F.col("account"))
    fold_fn = make_fold(pending_design, max_wait_ms, keep_pending, emit_balance)
    ordinary = keyed.where(~hot)
    unconditional = _unconditional(keyed.where(hot), pending_design, emit_balance, running=external_running)
    if not pending_design:
        parts = int(num_partitions or tx.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # rows only: the carried balances, one an account, are not worked out for this count
        busy = hotfold.busy_accounts(ordinary.where(F.col("_kind") == "row"), parts, busy_rows)
        if busy:
            is_busy = F.col("account").isin(list(busy))
            unconditional = unconditional.unionByName(_in_blocks(ordinary.where(is_busy), busy, parts, emit_balance))
            ordinary = ordinary.where(~is_busy)
    return fold_accounts(ordinary, fold_fn, num_partitions).unionByName(unconditional)


def _in_blocks(rows: DataFrame, busy: dict[str, int], parts: int, emit_balance: bool) -> DataFrame:
    """T2 over the busy accounts; ``busy``: their rows (at most as many accounts as ``parts``)."""
    carried = {r.account: r["_c"] for r in rows.where(F.col("_kind") == "balance").select("account", "_c").collect()}
    rows = rows.where(F.col("_kind") == "row")
    cuts = hotfold.cut_places(rows, sum(busy.values()), hotfold.BLOCKS * parts)
    blocked = hotfold.with_block(rows, cuts, sorted(busy))
    starts, last = hotfold.block_starts(blocked, parts, carried)
    fold = hotfold.block_fold(starts, last if emit_balance else {}, _PASS, _ARROW_OUT)
    return (blocked.repartition(parts, "_block").sortWithinPartitions("_block", *hotfold.ORDER)
            .mapInArrow(fold, OUT_SCHEMA))


def _public(folded: DataFrame) -> DataFrame:
    return (folded.withColumn("balance_after", from_cents(F.col("_bal")))
            .drop("_bal", "_kind"))


def checked_debit(tx: DataFrame, num_partitions: int | None = None, external_running: bool = True,
                  busy_rows: int = hotfold.BUSY_ROWS) -> DataFrame:
    """T2 over a feed of transfers; every input row is emitted once with its new
    status and the acting account's balance after it (``balance_after``).

    Rules per acting account, in ``(instant, seq, phase)`` order, balance from 0:
    CREATED or RETRY -> DEBIT_SUCCESS and subtract if the payer is external or
    the balance covers the amount (equality is enough), else
    RETRY_BALANCE_NOT_ENOUGH; DEBIT_SUCCESS -> FULFILLED and add; any other
    status passes unchanged.  ``external_running=False`` leaves ``balance_after``
    of external accounts null and spares their running sum.
    """
    return _public(run_fold(tx, pending_design=False, num_partitions=num_partitions,
                            external_running=external_running, busy_rows=busy_rows))


def pending_debit(tx: DataFrame, max_wait_ms: int | None = S.PENDING_MAX_WAIT_MS,
                  num_partitions: int | None = None) -> DataFrame:
    """T3 in event time.  CREATED with funds -> DEBIT_SUCCESS; without -> pending
    (no output, deadline ``instant + max_wait``).  DEBIT_SUCCESS -> FULFILLED,
    then pending debits are retried in insertion order, greedily.  A pending
    debit whose deadline is reached before the account's next row, or that is
    still pending at the end of input, is emitted CANCELLED_BALANCE_NOT_ENOUGH.
    Other statuses (incoming RETRY included) are dropped."""
    return _public(run_fold(tx, pending_design=True, max_wait_ms=max_wait_ms,
                            num_partitions=num_partitions))
