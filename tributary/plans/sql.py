"""SQL building blocks of the oracles (DuckDB dialect, tables as views).

They restate the row expressions of ``sources.ledger`` and the operators in
plain SQL so DuckDB computes the same answers independently.
"""

from __future__ import annotations

LEDGER = """ledger AS (
  SELECT CAST(event_id AS VARCHAR) AS txId,
         CASE WHEN event_type = 'signup' THEN 'external'
              ELSE CAST(100000 + user_id AS VARCHAR) END AS fromAccount,
         CASE WHEN event_type = 'signup' THEN CAST(100000 + user_id AS VARCHAR)
              ELSE CAST(100000 + user_id + 1 + event_id % 7 AS VARCHAR) END AS toAccount,
         value AS amount, ts AS instant, 'CREATED' AS status,
         CAST(0 AS INTEGER) AS retriedTimes, CAST(0 AS BIGINT) AS maxWaitTime,
         event_id AS seq, CAST(0 AS INTEGER) AS phase
  FROM events)"""

# First-round raw topic: transfers plus the DEBIT_SUCCESS echo of deposits.
FIRST_ROUND = LEDGER + """,
feed AS (
  SELECT txId, fromAccount, toAccount, amount, instant, status, retriedTimes, maxWaitTime, seq, phase FROM ledger
  UNION ALL
  SELECT txId, fromAccount, toAccount, amount, instant, 'DEBIT_SUCCESS', retriedTimes, maxWaitTime, seq, 1
  FROM ledger WHERE lower(fromAccount) = 'external')"""


def cents(expr: str) -> str:
    return f"CAST(round({expr} * 100) AS BIGINT)"


def from_cents(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE) / 100"


def running(delta: str, key: str, order: str = "instant, seq, phase") -> str:
    return (f"sum({delta}) OVER (PARTITION BY {key} ORDER BY {order} "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")


def checked_debit_sql(feed_cte: str) -> str:
    """T2 as a recursive CTE: per account, row n+1 folds on the balance of row n.

    ``feed_cte`` must define ``feed`` with the BANK_TX columns plus seq, phase.
    Accounts named external skip the recursion (always approved): window sum.
    Result CTE: ``checked`` (BANK_TX columns, account, status, balance_after).
    """
    def step(prev: str, o: str = "") -> tuple[str, str]:
        st, frm, c = f"{o}status", f"{o}fromAccount", f"{o}c"
        debit = f"{st} IN ('CREATED', 'RETRY_BALANCE_NOT_ENOUGH')"
        ok = f"(lower({frm}) = 'external' OR {prev} - {c} >= 0)"
        new_status = (f"CASE WHEN {debit} THEN CASE WHEN {ok} THEN 'DEBIT_SUCCESS' "
                      f"ELSE 'RETRY_BALANCE_NOT_ENOUGH' END "
                      f"WHEN {st} = 'DEBIT_SUCCESS' THEN 'FULFILLED' ELSE {st} END")
        new_bal = (f"CASE WHEN {debit} THEN CASE WHEN {ok} THEN {prev} - {c} ELSE {prev} END "
                   f"WHEN {st} = 'DEBIT_SUCCESS' THEN {prev} + {c} ELSE {prev} END")
        return new_status, new_bal

    s0, b0 = step("CAST(0 AS BIGINT)")
    s1, b1 = step("f.bal", "o.")
    cols = "txId, fromAccount, toAccount, amount, instant, retriedTimes, maxWaitTime, seq, phase"
    ocols = ", ".join(f"o.{c}" for c in cols.split(", "))
    return feed_cte + f""",
keyed AS (
  SELECT *, CASE WHEN status = 'DEBIT_SUCCESS' THEN toAccount ELSE fromAccount END AS account,
         {cents('amount')} AS c
  FROM feed),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY account ORDER BY instant, seq, phase) AS rn
  FROM keyed WHERE lower(account) <> 'external'),
fold AS (
  SELECT account, rn, {cols}, {s0} AS new_status, {b0} AS bal FROM ordered WHERE rn = 1
  UNION ALL
  SELECT o.account, o.rn, {ocols},
         {s1} AS new_status, {b1} AS bal
  FROM fold f JOIN ordered o ON o.account = f.account AND o.rn = f.rn + 1),
hot AS (
  SELECT *, CASE WHEN status IN ('CREATED', 'RETRY_BALANCE_NOT_ENOUGH') THEN -c
                 WHEN status = 'DEBIT_SUCCESS' THEN c ELSE CAST(0 AS BIGINT) END AS d
  FROM keyed WHERE lower(account) = 'external'),
checked AS (
  SELECT account, {cols}, new_status AS status, {from_cents('bal')} AS balance_after FROM fold
  UNION ALL
  SELECT account, {cols},
         CASE WHEN status IN ('CREATED', 'RETRY_BALANCE_NOT_ENOUGH') THEN 'DEBIT_SUCCESS'
              WHEN status = 'DEBIT_SUCCESS' THEN 'FULFILLED' ELSE status END,
         {from_cents(running('d', 'account'))}
  FROM hot)"""


def pending_debit_sql(feed_cte: str, max_wait_ms: int) -> str:
    """T3 as a recursive CTE with the pending debits of an account as a list.

    A step either takes the account's next row (first dropping, as cancelled,
    the pending debits whose deadline has come) or, after a credit, looks at
    one pending debit (``i``) and releases it if the balance covers it.
    Result CTE: ``settled`` (account, txId, phase, amount, status, balance, maxWaitTime).
    """
    def struct(src: str, status: str, bal: str, wait: str) -> str:
        return (f"{{'txId': {src}.txId, 'phase': {src}.phase, 'amount': {src}.amount, 'status': {status}, "
                f"'bal': {bal}, 'w': {wait}}}")

    def cancelled(items: str) -> str:
        return f"list_transform({items}, lambda x: {struct('x', repr('CANCELLED_BALANCE_NOT_ENOUGH'), 'b', 'x.due')})"

    expired = cancelled("list_filter(pend, lambda y: y.due <= now)")
    live = "list_filter(pend, lambda y: y.due > now)"
    ok = "(lower(fromAccount) = 'external' OR b - c >= 0)"
    taken = "(pend[i].c <= b)"
    return feed_cte + f""",
keyed AS (
  SELECT txId, phase, CAST(amount AS DOUBLE) AS amount, status, fromAccount, seq, instant,
         CASE WHEN status = 'DEBIT_SUCCESS' THEN toAccount ELSE fromAccount END AS account,
         {cents('amount')} AS c, epoch_us(instant) // 1000 AS now, CAST(maxWaitTime AS BIGINT) AS w
  FROM feed),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY account ORDER BY instant, seq, phase) AS rn
  FROM keyed WHERE lower(account) <> 'external'),
fold AS (
  SELECT DISTINCT account, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS rn, CAST(0 AS BIGINT) AS i,
         CAST(0 AS BIGINT) AS b,
         CAST([] AS STRUCT(txId VARCHAR, phase INTEGER, amount DOUBLE, c BIGINT, due BIGINT)[]) AS pend,
         CAST([] AS STRUCT(txId VARCHAR, phase INTEGER, amount DOUBLE, status VARCHAR, bal BIGINT, w BIGINT)[]) AS outs
  FROM ordered
  UNION ALL
  SELECT account, n + 1, CASE WHEN i > 0 THEN rn ELSE rn + 1 END,
         CASE WHEN i > 0 THEN CASE WHEN {taken} THEN CASE WHEN i < len(pend) THEN i ELSE 0 END
                                   WHEN i < len(pend) THEN i + 1 ELSE 0 END
              WHEN status = 'DEBIT_SUCCESS' AND len({live}) > 0 THEN 1 ELSE 0 END,
         CASE WHEN i > 0 THEN CASE WHEN {taken} THEN b - pend[i].c ELSE b END
              WHEN status = 'CREATED' AND {ok} THEN b - c WHEN status = 'DEBIT_SUCCESS' THEN b + c ELSE b END,
         CASE WHEN i > 0 THEN CASE WHEN {taken} THEN list_concat(pend[1:i - 1], pend[i + 1:]) ELSE pend END
              WHEN status = 'CREATED' AND NOT {ok}
                THEN list_append({live}, {{'txId': txId, 'phase': phase, 'amount': amount, 'c': c,
                                           'due': now + {max_wait_ms}}})
              ELSE {live} END,
         CASE WHEN i > 0 THEN CASE WHEN {taken} THEN [{struct('pend[i]', "'DEBIT_SUCCESS'", 'b - pend[i].c', 'pend[i].due')}]
                                   ELSE [] END
              WHEN status = 'CREATED' AND {ok}
                THEN list_append({expired}, {struct('s', "'DEBIT_SUCCESS'", 'b - c', 'w')})
              WHEN status = 'DEBIT_SUCCESS' THEN list_append({expired}, {struct('s', "'FULFILLED'", 'b + c', 'w')})
              ELSE {expired} END
  FROM (SELECT f.account, f.n, f.rn, f.i, f.b, f.pend, o.txId, o.phase, o.amount, o.status, o.fromAccount, o.c, o.now,
               o.w, o.rn AS orn
        FROM fold f LEFT JOIN ordered o ON f.i = 0 AND o.account = f.account AND o.rn = f.rn + 1) s
  WHERE i > 0 OR orn IS NOT NULL),
ended AS (
  SELECT account, arg_max(b, n) AS b, arg_max(pend, n) AS pend FROM fold GROUP BY account),
emitted AS (
  SELECT account, unnest(outs) AS x FROM fold
  UNION ALL
  SELECT account, unnest({cancelled('pend')}) FROM ended),
hot AS (
  SELECT *, CASE WHEN status = 'CREATED' THEN -c ELSE c END AS d
  FROM keyed WHERE lower(account) = 'external' AND status IN ('CREATED', 'DEBIT_SUCCESS')),
settled AS (
  SELECT account, x.txId AS txId, x.phase AS phase, x.amount AS amount, x.status AS status,
         {from_cents('x.bal')} AS balance_after, x.w AS maxWaitTime FROM emitted
  UNION ALL
  SELECT account, txId, phase, amount, CASE WHEN status = 'CREATED' THEN 'DEBIT_SUCCESS' ELSE 'FULFILLED' END,
         {from_cents(running('d', 'account'))}, w FROM hot)"""


def workflow_retry_sql(max_retries: int) -> str:
    """T7 written out round by round: a transfer is decided in round ``max_retries``
    at the latest and credited in the next.  Result CTE: ``completed`` (txId, phase,
    status, retriedTimes, round)."""
    cols = "txId, fromAccount, toAccount, c, instant, seq"
    out = LEDGER + f""",
r0 AS MATERIALIZED (
  SELECT txId, fromAccount, toAccount, {cents('amount')} AS c, instant, seq, status, retriedTimes AS k, phase
  FROM ledger),
b0 AS MATERIALIZED (SELECT CAST(NULL AS VARCHAR) AS account, CAST(0 AS BIGINT) AS b WHERE false)"""
    debit = "status IN ('CREATED', 'RETRY_BALANCE_NOT_ENOUGH')"
    ocols = ", ".join(f"o.{x}" for x in cols.split(", "))
    any_cols = ", ".join(f"any_value({x}) AS {x}" for x in cols.split(", "))
    last = max_retries + 1
    for r in range(last + 1):
        out += f""",
a{r} AS MATERIALIZED (
  SELECT *, CASE WHEN status = 'DEBIT_SUCCESS' THEN toAccount ELSE fromAccount END AS account FROM r{r}),
o{r} AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY account ORDER BY status <> 'DEBIT_SUCCESS', instant, seq, phase) AS rn
  FROM a{r} WHERE lower(account) <> 'external'),
f{r} AS (
  SELECT account, CAST(0 AS BIGINT) AS rn, coalesce(any_value(b{r}.b), 0) AS bal, {any_cols},
         CAST(NULL AS VARCHAR) AS status, any_value(k) AS k, any_value(phase) AS phase
  FROM o{r} LEFT JOIN b{r} USING (account) GROUP BY account
  UNION ALL
  SELECT o.account, o.rn,
         CASE WHEN o.status = 'DEBIT_SUCCESS' THEN f.bal + o.c
              WHEN lower(o.fromAccount) = 'external' OR f.bal - o.c >= 0 THEN f.bal - o.c ELSE f.bal END,
         {ocols},
         CASE WHEN o.status = 'DEBIT_SUCCESS' THEN 'FULFILLED'
              WHEN lower(o.fromAccount) = 'external' OR f.bal - o.c >= 0 THEN 'DEBIT_SUCCESS'
              ELSE 'RETRY_BALANCE_NOT_ENOUGH' END, o.k, o.phase
  FROM f{r} f JOIN o{r} o ON o.account = f.account AND o.rn = f.rn + 1),
e{r} AS MATERIALIZED (
  SELECT {cols}, status, k, phase FROM f{r} WHERE rn > 0
  UNION ALL
  SELECT {cols}, CASE WHEN {debit} THEN 'DEBIT_SUCCESS' ELSE 'FULFILLED' END, k, phase
  FROM a{r} WHERE lower(account) = 'external'),
b{r + 1} AS MATERIALIZED (
  SELECT account, arg_max(bal, rn) AS b FROM f{r} GROUP BY account
  UNION ALL
  SELECT account, b FROM b{r} WHERE account NOT IN (SELECT account FROM f{r})),
r{r + 1} AS MATERIALIZED (
  SELECT {cols}, status, CASE WHEN status = 'DEBIT_SUCCESS' THEN k ELSE k + 1 END AS k,
         CASE WHEN status = 'DEBIT_SUCCESS' THEN phase + 1 ELSE phase END AS phase
  FROM e{r} WHERE status = 'DEBIT_SUCCESS' OR (status = 'RETRY_BALANCE_NOT_ENOUGH' AND k < {max_retries}))"""
    done = "\n  UNION ALL\n  ".join(
        f"SELECT txId, phase, CASE WHEN status = 'FULFILLED' THEN status "
        f"ELSE 'CANCELLED_BALANCE_NOT_ENOUGH' END AS status, k AS retriedTimes, {r} AS round FROM e{r} "
        f"WHERE status = 'FULFILLED' OR (status = 'RETRY_BALANCE_NOT_ENOUGH' AND k >= {max_retries})"
        for r in range(last + 1))
    return out + f""",
completed AS (
  {done})"""
