"""The checked-debit fold (T2) of very busy accounts, over many tasks.

Whether a debit passes depends on all debits accepted before it.  Yet a run of
rows of one account is known by little: if it accepts all its debits, the
balance moves by the run's *sum*, and it does so if it starts with at least its
*need*.  The rows of a busy account are therefore cut along their order into
blocks:

1. blocks are summed up side by side: sum, need, the lowest point on the way,
   and the bare amounts;
2. a balance is never below what it were if all debits had passed, nor below
   zero.  From the blocks' sums and lowest points, added up in order, follows a
   bound for the balance at each block's start; a block whose need is within
   its bound is certain to accept all;
3. the blocks' true starting balances are found in order: a certain block adds
   its sum; of the others the bare amounts are walked, again in short runs that
   are passed whole if they accept all, or hold only debits above the balance;
4. all blocks are folded row by row, side by side, each from its start.

Steps 1 and 4 touch the rows and use all tasks; step 3 reads a few bytes a row
of the uncertain blocks only and keeps one block in memory.

Blocks are cut at places of a sample of the rows' order (account, rank,
instant, seq, phase), so rows of one instant are cut by ``seq``.  The sample
decides block sizes only, never a result.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary import schemas as S
from tributary.session import scratch_path

# An account is busy above this many rows, and among the most frequent ones.
BUSY_ROWS = 200_000
# Blocks for each task, and rows of the sample for each block.
BLOCKS = 3
SAMPLED = 64
# Rows of a short run inside a block.
RUN = 256
_NONE, _DEBIT, _CREDIT = 0, 1, 2
_LOWEST = -(1 << 62)
ORDER = ("_prio", *S.ORDER)


def busy_accounts(keyed: DataFrame, parts: int, busy_rows: int = BUSY_ROWS) -> dict[str, int]:
    """Rows of the accounts with more than ``busy_rows``: the ``parts`` most frequent ones at most.

    Any other account has at most a ``parts``-th of all rows, an even share for one task.
    """
    found = (keyed.where(F.col("account").isNotNull()).groupBy("account").agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") > busy_rows).orderBy(F.col("n").desc(), "account").limit(parts).collect())
    return {r.account: r.n for r in found}


def _order_columns() -> list:
    """The order as whole numbers; nulls first, as Spark sorts them."""
    values = [F.col("_prio").cast("long"), F.unix_micros("instant"), F.col("seq"), F.col("phase").cast("long")]
    return [F.coalesce(v, F.lit(_LOWEST)).alias(f"_place{i}") for i, v in enumerate(values)]


def cut_places(rows: DataFrame, total: int, blocks: int) -> list[tuple]:
    """Places in the order that cut ``rows`` into about ``blocks`` blocks."""
    share = min(1.0, SAMPLED * blocks / max(1, total))
    sample = sorted(map(tuple, rows.select("account", *_order_columns()).sample(share, seed=7).collect()))
    step = max(1, len(sample) // blocks)
    return sorted(set(sample[step::step]))


def with_block(rows: DataFrame, cuts: list[tuple], accounts: list[str]) -> DataFrame:
    """``rows`` with ``_block``: grows along (account, order); no two accounts share one."""
    first = [(a, -(1 << 63)) for a in accounts]
    borders = sorted([*cuts, *first])
    schema = T.StructType([*rows.schema.fields, T.StructField("_block", T.IntegerType())])
    n = len(rows.columns)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = zip(*[batch.column(i).to_pylist() for i in (0, *range(n, batch.num_columns))], strict=True)
            block = pa.array([bisect_right(borders, p) for p in places], type=pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], block], names=[*batch.schema.names[:n], "_block"])

    return rows.select("*", *_order_columns()).mapInArrow(number, schema)


def _kinds(status: pa.Array) -> np.ndarray:
    kind = {S.CREATED: _DEBIT, S.RETRY_BALANCE_NOT_ENOUGH: _DEBIT, S.DEBIT_SUCCESS: _CREDIT}
    return np.array([kind.get(s, _NONE) for s in status.to_pylist()], dtype=np.int8)


def _deltas(kind: np.ndarray, cents: np.ndarray) -> np.ndarray:
    return np.where(kind == _DEBIT, -cents, np.where(kind == _CREDIT, cents, 0))


def _summary(kind: np.ndarray, cents: np.ndarray) -> tuple[int, int, int]:
    """(sum, need, lowest) of rows that accept all their debits, the latter two relative to the start."""
    after = np.cumsum(_deltas(kind, cents))
    debit = kind == _DEBIT
    need = int(-after[debit].min()) if debit.any() else _LOWEST
    return int(after[-1]), need, int(min(0, after.min()))


SUMMARY = "account string, _block int, total long, need long, lowest long, odd boolean, init long, kinds binary, cents binary"


def _summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(account, status, _c, _init, _block), sorted by block and order -> one row per block."""
    names = ["account", "_block", "total", "need", "lowest", "odd", "init", "kinds", "cents"]
    types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.binary()]
    block, account, init, kinds, cents = None, None, 0, [], []

    def row() -> pa.RecordBatch:
        k, c = np.concatenate(kinds), np.concatenate(cents)
        values = [account, block, *_summary(k, c), bool((c[k != _NONE] < 0).any()), init, k.tobytes(), c.tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([v], type=t) for v, t in zip(values, types, strict=True)], names=names)

    for batch in batches:
        of = batch.column(4).to_numpy()
        k, c = _kinds(batch.column(1)), batch.column(2).fill_null(0).to_numpy()
        cut = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)]
        for s, e in zip(cut[:-1], cut[1:], strict=True):
            if s == e:
                continue
            if of[s] != block:
                if block is not None:
                    yield row()
                block, account, kinds, cents = int(of[s]), batch.column(0)[s].as_py(), [], []
                init = batch.column(3)[s].as_py() or 0
            kinds.append(k[s:e])
            cents.append(c[s:e])
    if block is not None:
        yield row()


def walk(balance: int, kinds: np.ndarray, cents: np.ndarray) -> int:
    """The balance after all rows, from the one before them; short runs are passed whole where they can be."""
    for s in range(0, len(kinds), RUN):
        k, c = kinds[s:s + RUN], cents[s:s + RUN]
        total, need, _ = _summary(k, c)
        if balance >= need:
            balance += total
        elif (k != _CREDIT).all() and c[k == _DEBIT].min() > balance:
            continue                                        # every debit is above the balance
        else:
            for kind, amount in zip(k.tolist(), c.tolist(), strict=True):
                if kind == _CREDIT:
                    balance += amount
                elif kind == _DEBIT and balance >= amount:
                    balance -= amount
    return balance


def certain_blocks(summaries: DataFrame, carried: dict[str, int]) -> list:
    """All blocks in order, each with whether it is certain to accept all its debits.

    One narrow row a block, of which there are about as many as tasks and busy accounts.
    """
    spark = summaries.sparkSession
    start = spark.createDataFrame(list(carried.items()), "account string, carried long")
    rows = (summaries.select("account", "_block", "total", "need", "lowest", "odd", "init")
            .join(F.broadcast(start), "account", "left"))
    own = W.partitionBy("account").orderBy("_block")
    before = own.rowsBetween(W.unboundedPreceding, -1)
    first = F.coalesce("carried", F.first("init").over(own.rowsBetween(W.unboundedPreceding, W.currentRow)))
    rows = rows.withColumn("start", first)
    moved = F.coalesce(F.sum("total").over(before), F.lit(0))
    rows = rows.withColumn("all", F.col("start") + moved)
    lowest = F.least(F.col("start"), F.coalesce(F.min(F.col("all") + F.col("lowest")).over(before), F.col("start")))
    odd = F.max((F.col("odd") | (F.col("start") < 0)).cast("int")).over(W.partitionBy("account"))
    bound = F.greatest(F.col("all"), F.col("all") - lowest)
    return (rows.select("account", "_block", "total", "start", ((odd == 0) & (bound >= F.col("need"))).alias("certain"))
            .orderBy("account", "_block").collect())


def _walked(blocks: list):
    """Uncertain blocks of each account, in order -> (block, balance at its start)."""
    by_account: dict[str, list] = {}
    for b in blocks:
        by_account.setdefault(b["account"], []).append((b["_block"], b["total"], b["start"], b["certain"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        account, waiting, balance, out = None, iter(()), 0, []

        def pass_certain(upto: int | None) -> None:
            """Certain blocks before ``upto`` (all that are left, if None) add their sums."""
            nonlocal balance
            for block, total, _, certain in waiting:
                out.append((block, balance))
                if block == upto:
                    return
                balance += total

        for batch in batches:
            for i in range(batch.num_rows):
                name = batch.column(0)[i].as_py()
                if name != account:
                    if account is not None:
                        pass_certain(None)
                    account, waiting, balance = name, iter(by_account[name]), by_account[name][0][2]
                pass_certain(batch.column(1)[i].as_py())
                balance = walk(balance, np.frombuffer(batch.column(2)[i].as_py(), dtype=np.int8),
                               np.frombuffer(batch.column(3)[i].as_py(), dtype=np.int64))
        if account is not None:
            pass_certain(None)
        yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in out], type=pa.int32()),
                                          pa.array([v for _, v in out], type=pa.int64())], names=["block", "balance"])
    return run


def block_starts(rows: DataFrame, parts: int, carried: dict[str, int]) -> tuple[dict[int, int], dict[int, str]]:
    """The balance at the start of every block, and the accounts by their last block.

    ``rows``: with ``_block``; ``carried``: balances of accounts before these rows.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "busy-blocks")
    (rows.select("account", "status", "_c", "_init", "_block", *ORDER)
     .repartition(parts, "_block").sortWithinPartitions("_block", *ORDER)
     .select("account", "status", "_c", "_init", "_block").mapInArrow(_summarised, SUMMARY).write.parquet(path))
    summaries = spark.read.schema(SUMMARY).parquet(path)
    blocks = certain_blocks(summaries, carried)
    starts: dict[int, int] = {}
    unsure = [b["_block"] for b in blocks if not b["certain"]]
    if unsure:
        accounts = {b["account"] for b in blocks if not b["certain"]}
        chosen = F.broadcast(spark.createDataFrame([(b,) for b in unsure], "_block int"))
        chain = (summaries.join(chosen, "_block").select("account", "_block", "kinds", "cents")
                 .repartition(max(1, min(parts, len(accounts))), "account").sortWithinPartitions("account", "_block")
                 .mapInArrow(_walked(blocks), "block int, balance long"))
        starts = {r.block: r.balance for r in chain.collect()}
    account, balance, last = None, 0, {}
    for b in blocks:
        if b["account"] != account:
            account, balance = b["account"], b["start"]
        starts.setdefault(b["_block"], balance)             # an account of certain blocks only
        balance += b["total"]
        last[account] = b["_block"]
    return starts, {block: name for name, block in last.items()}


def block_fold(starts: dict[int, int], last: dict[int, str], columns: int, out: pa.Schema):
    """The row by row fold of sorted blocks, each from its start; rows leave with status and balance replaced.

    Blocks in ``last`` end with one more row, their account's closing balance.
    """
    def closing(block: int, balance: int) -> pa.RecordBatch:
        values = [last[block], *[None] * (columns - 1), "balance", balance]
        return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(values, out, strict=True)], schema=out)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, balance, ended = None, 0, []
        for batch in batches:
            block, cents = batch.column(batch.num_columns - 1).to_pylist(), batch.column(columns).to_pylist()
            status, balances = [], []
            for b, st, c in zip(block, batch.column(6).to_pylist(), cents, strict=True):
                if b != current:
                    if current in last:
                        ended.append(closing(current, balance))
                    current, balance = b, starts[b]
                if st == S.CREATED or st == S.RETRY_BALANCE_NOT_ENOUGH:
                    if balance - c >= 0:
                        balance -= c
                        st = S.DEBIT_SUCCESS
                    else:
                        st = S.RETRY_BALANCE_NOT_ENOUGH
                elif st == S.DEBIT_SUCCESS:
                    balance += c
                    st = S.FULFILLED
                status.append(st)
                balances.append(balance)
            arrays = [batch.column(i) for i in range(columns)]
            arrays[6] = pa.array(status, pa.string())
            arrays += [pa.array(["out"] * len(status), pa.string()), pa.array(balances, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, schema=out)
        if current in last:
            ended.append(closing(current, balance))
        yield from ended
    return fold
