"""Transfers as signed account legs, balances, and the unchecked transfer machines.

A transfer touches two accounts; each is one *leg* with a signed amount.
Legs are produced in one scan with ``inline`` (no self-union, no second read).
Balances are integer-cent sums: exact, so equal inputs give equal balances in
any order.  Running balances go through ``blocked_running_sum`` so a hot
account (``external`` receives every deposit) is not ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary import schemas as S
from tributary.functions.ledger import acting_account, cents, from_cents
from tributary.operators.running import ordered_running_sum



LEG_FIELDS = ("txId", "account", "amount", "instant", "status", "retriedTimes", "seq", "phase")


def split_legs(tx: DataFrame, debit_status: str | None = None,
               credit_status: str | None = None, fields: tuple = LEG_FIELDS) -> DataFrame:
    """Two legs per transfer: payer ``-amount`` (phase 0), payee ``+amount`` (phase 1).

    Leg statuses default to the transfer's status; J2 passes DEBIT_SUCCESS /
    FULFILLED to mark what each side did.  ``fields`` limits the leg columns
    (the scan then reads only what they need; pruning does not see through
    the generated array).
    """
    d_status = F.lit(debit_status) if debit_status else F.col("status")
    c_status = F.lit(credit_status) if credit_status else F.col("status")
    sides = (
        {"txId": F.col("txId"), "account": F.col("fromAccount"), "amount": -F.col("amount"),
         "instant": F.col("instant"), "status": d_status, "retriedTimes": F.col("retriedTimes"),
         "seq": F.col("seq"), "phase": F.lit(0)},
        {"txId": F.col("txId"), "account": F.col("toAccount"), "amount": F.col("amount"),
         "instant": F.col("instant"), "status": c_status, "retriedTimes": F.col("retriedTimes"),
         "seq": F.col("seq"), "phase": F.lit(1)},
    )
    legs = F.array(*[F.struct(*[side[f].alias(f) for f in fields]) for side in sides])
    return tx.select(F.inline(legs))


def account_balance_of(tx: DataFrame) -> DataFrame:
    """Balance per account of a transfer frame, reading only parties and amount."""
    return account_balance(split_legs(tx, fields=("account", "amount")))


def account_balance(legs: DataFrame) -> DataFrame:
    """``(account, balance)``: sum of signed legs (partial aggregation before the shuffle)."""
    return (legs.groupBy("account").agg(F.sum(cents(F.col("amount"))).alias("_c"))
            .select("account", from_cents(F.col("_c")).alias("balance")))


def running_balance(rows: DataFrame, key: str, delta_cents_col: str, out_col: str,
                    as_cents: bool = False) -> DataFrame:
    """Add ``out_col``: balance of ``key`` after each row, in ``schemas.ORDER``
    (a double, or integer cents with ``as_cents``).

    Blocks are quantile slices of the instant (skew-proof: a block holds about
    1/P of all rows)."""
    order = list(S.ORDER)
    out = ordered_running_sum(rows, [key], order, delta_cents_col, "_rs",
                              order_value=F.unix_micros(F.col("instant")))
    value = F.col("_rs").cast("long") if as_cents else from_cents(F.col("_rs"))
    return out.withColumn(out_col, value).drop("_rs")


def self_connect_balance(tx: DataFrame) -> DataFrame:
    """Each transfer debited on the payer (DEBIT_SUCCESS) and credited on the
    payee (FULFILLED), unchecked, with the account's running balance after it."""
    legs = split_legs(tx, S.DEBIT_SUCCESS, S.FULFILLED).withColumn("_d", cents(F.col("amount")))
    out = running_balance(legs, "account", "_d", "balance_after")
    return out.select("txId", "account", "status", "amount", "balance_after")


def round_trip_feed(tx: DataFrame) -> DataFrame:
    """The raw topic after one trip through the debit stage: every new transfer
    (phase 0) plus its DEBIT_SUCCESS echo (phase 1), from one scan."""
    return (tx.withColumn("phase", F.explode(F.array(F.lit(0), F.lit(1))))
            .withColumn("status", F.when(F.col("phase") == 1, F.lit(S.DEBIT_SUCCESS))
                        .otherwise(F.col("status"))))


def unchecked_transition(tx: DataFrame) -> DataFrame:
    """A4: CREATED -> debit -> DEBIT_SUCCESS; DEBIT_SUCCESS -> credit -> FULFILLED;
    other statuses pass unchanged.  No funds check.  Keyed by the acting account."""
    status = F.col("status")
    keyed = tx.select(
        "txId", "instant", "seq", "phase", "amount",
        acting_account(status, F.col("fromAccount"), F.col("toAccount")).alias("account"),
        F.when(status == S.CREATED, -cents(F.col("amount")))
         .when(status == S.DEBIT_SUCCESS, cents(F.col("amount")))
         .otherwise(F.lit(0).cast("long")).alias("_d"),
        F.when(status == S.CREATED, F.lit(S.DEBIT_SUCCESS))
         .when(status == S.DEBIT_SUCCESS, F.lit(S.FULFILLED))
         .otherwise(status).alias("status"),
    )
    out = running_balance(keyed, "account", "_d", "balance_after")
    return out.select("txId", "phase", "account", "status", "amount", "balance_after")


def two_stage_transfer(tx: DataFrame) -> DataFrame:
    """A5: debit stage keyed by payer, keep DEBIT_SUCCESS, credit stage keyed by
    payee.  Each stage keeps its own balance per account."""
    created = tx.where(F.col("status") == S.CREATED).withColumn("_d", -cents(F.col("amount")))
    debited = (running_balance(created, "fromAccount", "_d", "debit_balance_after")
               .withColumn("status", F.lit(S.DEBIT_SUCCESS)))
    kept = debited.where(F.col("status") == S.DEBIT_SUCCESS).withColumn("_d", -F.col("_d"))
    credited = running_balance(kept, "toAccount", "_d", "credit_balance_after")
    return credited.select("txId", "fromAccount", "toAccount", "amount",
                           F.lit(S.FULFILLED).alias("status"),
                           "debit_balance_after", "credit_balance_after")
