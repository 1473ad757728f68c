"""State of streams over several batches: published tables, change feeds, bounded deduplication, map state, late rows,
connected and chained stateful operators, and users' own functions."""

import json
import os
import subprocess
import sys
import time

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.test_streaming import BASE_S, _dir, _tx_stream, _write_tx
from tributary import schemas as S
from tributary.functions.user import PART_BYTES, flat_map, keyed_process, output, parts
from tributary.operators import legs as L
from tributary.operators.cogroup import cogroup
from tributary.session import scratch_path
from tributary.streaming import jobs, workflow
from tributary.streaming.published import PublishedTable, publish_state

KV = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _lines(folder, name, rows):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)
    order = 1_000_000 + len(os.listdir(folder))
    os.utime(path, (order, order))


def test_published_table_versions(spark):
    table = PublishedTable(spark, scratch_path(spark, "published"), ["k"], KV, buckets=8)
    assert table.versions() == [] and table.read().count() == 0
    table.merge(spark.createDataFrame([(f"k{i}", i) for i in range(40)] + [(None, 7)], KV), 0)
    before = table._manifest(0)
    table.merge(spark.createDataFrame([("k3", 300), ("new", 1)], KV), 4, gone=spark.createDataFrame([("k5", 0)], KV))
    want = {(f"k{i}", i) for i in range(40)} - {("k3", 3), ("k5", 5)} | {("k3", 300), ("new", 1), (None, 7)}
    assert set(_rows(table.read())) == want and table.versions() == [0, 4]
    after = table._manifest(4)
    assert 0 < sum(v == 4 for v in after.values()) <= 3            # other buckets were not written again
    assert {b: v for b, v in after.items() if v == 0}.items() <= before.items()
    assert set(_rows(table.read(0))) == {(f"k{i}", i) for i in range(40)} | {(None, 7)}
    # a batch that runs again, and one that broke off before its manifest was done
    table.merge(spark.createDataFrame([("k3", 300), ("new", 1)], KV), 4, gone=spark.createDataFrame([("k5", 0)], KV))
    spark.createDataFrame([("k1", 99)], KV).write.parquet(f"{table.path}/data/version=5/__bucket=0")
    assert set(_rows(table.read())) == want
    table.vacuum()
    assert set(_rows(table.read())) == want
    assert _rows(table.lookup(spark.createDataFrame([("k3",), ("k5",)], "k string"))) == [("k3", 300), ("k5", None)]
    keys = spark.createDataFrame([("k7",)], "k string")
    assert len(table.lookup(keys).inputFiles()) <= 1                # one bucket of eight
    table.merge(spark.createDataFrame([], KV), 9)
    assert table.versions() == [0, 4]


def test_running_counts_merge_only_changed_words(spark):
    src = _dir()
    _lines(src, "a.json", [{"text": "one two two"}, {"text": "three"}])
    _lines(src, "b.json", [{"text": "two four"}])
    lines = spark.readStream.schema("text string").option("maxFilesPerTrigger", 1).json(src)
    target = scratch_path(spark, "merged")
    out = jobs.run_merged(jobs.word_count_stream(lines), ["word"], target=target, buckets=16)
    assert _rows(out) == [("four", 1), ("one", 1), ("three", 1), ("two", 3)]
    changes = spark.read.parquet(f"{target}/changes/version=1")
    assert {r.word for r in changes.collect()} == {"two", "four"}


def test_state_feed_brings_the_table_up_to_date(spark):
    src, ckpt = _dir(), scratch_path(spark, "feed")
    table = PublishedTable(spark, scratch_path(spark, "feed-table"), ["word"],
                           T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())]))

    def publish():
        lines = spark.readStream.schema("text string").option("maxFilesPerTrigger", 1).json(src)
        jobs.run_available(jobs.word_count_stream(lines), "update", "feed", checkpoint=ckpt, target=scratch_path(spark, "x"))
        return publish_state(table, ckpt, {"word": F.col("key.word"), "n": F.col("value.count")})

    _lines(src, "a.json", [{"text": "one two two"}])
    _lines(src, "b.json", [{"text": "two"}])
    first = publish()
    assert _rows(table.read()) == [("one", 1), ("two", 3)]
    _lines(src, "c.json", [{"text": "three one"}])
    second = publish()
    assert second > first and _rows(table.read()) == [("one", 2), ("three", 1), ("two", 3)]
    assert {r.word for r in spark.read.parquet(f"{table.path}/changes/version={second}").collect()} == {"one", "three"}
    assert _rows(table.lookup(spark.createDataFrame([("one",), ("none",)], "word string"))) == [("none", None), ("one", 2)]


LEDGER = ([("t1", "external", "A", 9, 0, S.CREATED, 0), ("t2", "A", "B", 4, 1, S.CREATED, 0), ("t3", "External", "B", 2, 2, S.CREATED, 0)],
          [("t4", "B", "A", 1.25, 10, S.CREATED, 0), ("t5", "external", "A", 3, 11, S.CREATED, 0), ("t6", "A", "external", 2, 12, S.CREATED, 0)],
          [("t7", "A", "C", 1, 20, S.CREATED, 0)])


def _ledger(spark):
    src = _write_tx(*LEDGER)
    return _tx_stream(spark, src), spark.read.parquet(src)


def test_self_connect_over_batches_equals_batch(spark):
    stream, batch = _ledger(spark)
    assert _rows(jobs.run_self_connect(stream).select("txId", "account", "status", "amount", "balance_after")) == \
        _rows(L.self_connect_balance(batch))


def test_two_stages_in_one_stream_equal_batch(spark):
    stream, batch = _ledger(spark)
    out = jobs.run_available(jobs.two_stage_stream(stream), "append", "two")
    cols = ["txId", "fromAccount", "toAccount", "amount", "status", "debit_balance_after", "credit_balance_after"]
    assert _rows(out.select(*cols)) == _rows(L.two_stage_transfer(batch).select(*cols))


def test_buckets_of_accounts_equal_single_ones(spark):
    names = ["external", None, *[f"a{i}" for i in range(40)]]
    rows = [(f"t{i}", names[i * 7 % 42], names[(i * 11 + 1) % 42], 1 + i % 9, i, S.DEBIT_SUCCESS if i % 3 else S.CREATED, 0)
            for i in range(300)]
    src = _write_tx(rows[:150], rows[150:])
    cols = ["txId", "account", "status", "balance_after"]
    one = jobs.run_available(jobs.checked_debit_stream(_tx_stream(spark, src)), "append", "one")
    many = jobs.run_available(jobs.checked_debit_stream(_tx_stream(spark, src), 3), "append", "many")
    assert _rows(many.select(*cols)) == _rows(one.select(*cols)) and many.count() == 300
    # the bounded form has no rows of null accounts
    new = _write_tx(*[[(*r[:5], S.CREATED, 0) for r in part if None not in r[1:3]] for part in (rows[:150], rows[150:])])
    ckpt, cols = scratch_path(spark, "stages"), ["txId", "status", "debit_balance_after", "credit_balance_after"]
    out = jobs.run_available(jobs.two_stage_stream(_tx_stream(spark, new)), "append", "stages", checkpoint=ckpt)
    assert _rows(out.select(*cols)) == _rows(L.two_stage_transfer(spark.read.parquet(new)).select(*cols))
    assert "slot" in str(jobs.read_state(spark, ckpt, "balances", 0).schema)


def _tagged(spark, src):
    rows = spark.readStream.schema("tag string, txId string, account string, amount double, status string, instant timestamp, "
                                   "seq long, phase int").option("maxFilesPerTrigger", 1).json(src)
    return rows.where("tag = 'leg'"), rows.where("tag = 'state'")


def _event(tag, tx, status=None, seq=0):
    return {"tag": tag, "txId": tx, "account": "A", "amount": 1.0, "status": status, "seq": seq, "phase": 0,
            "instant": "2024-01-01T00:00:00Z"}


def test_map_state_is_joined_on_arrival(spark):
    src = _dir()
    _lines(src, "a.json", [_event("leg", "x", seq=1), _event("state", "y", "CREATED", 1), _event("state", "y", "FULFILLED", 2)])
    _lines(src, "b.json", [_event("state", "x", "CREATED", 3), _event("leg", "x", seq=4), _event("leg", "y", seq=5)])
    out = jobs.run_available(jobs.map_enrich_stream(*_tagged(spark, src), buckets=2), "append", "map")
    assert sorted((r.txId, str(r.tx_status)) for r in out.collect()) == [("x", "CREATED"), ("x", "None"), ("y", "FULFILLED")]


def test_map_state_holds_many_transfers_in_few_entries(spark):
    src, ckpt = _dir(), scratch_path(spark, "slots")
    _lines(src, "a.json", [_event("state", f"t{i}", "CREATED", i) for i in range(600)])
    _lines(src, "b.json", [_event("state", f"t{i}", "FULFILLED", i) for i in range(0, 600, 3)]
           + [_event("leg", f"t{i}", seq=i) for i in range(700)])
    out = jobs.run_available(jobs.map_enrich_stream(*_tagged(spark, src), buckets=2), "append", "slots", checkpoint=ckpt)
    want = {f"t{i}": ("CREATED" if i % 3 else "FULFILLED") if i < 600 else None for i in range(700)}
    assert {r.txId: r.tx_status for r in out.collect()} == want
    entries = jobs.read_state(spark, ckpt, "states")
    assert 0 < entries.count() <= 128


def test_map_state_forgets_after_its_time(spark):
    key = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        src, ckpt, target = _dir(), scratch_path(spark, "ttl"), scratch_path(spark, "ttl-out")

        def run():
            stream = jobs.map_enrich_stream(*_tagged(spark, src), ttl_ms=1_500, buckets=2)
            return jobs.run_available(stream, "append", "ttl", checkpoint=ckpt, target=target)

        _lines(src, "a.json", [_event("state", "x", "CREATED"), _event("leg", "x", seq=1)])
        assert [r.tx_status for r in run().collect()] == ["CREATED"]
        time.sleep(2)
        _lines(src, "b.json", [_event("leg", "x", seq=2)])
        assert sorted(str(r.tx_status) for r in run().collect()) == ["CREATED", "None"]
    finally:
        spark.conf.set(key, before)


def test_replays_are_dropped_with_flat_state(spark):
    src, ckpt, target = _dir(), scratch_path(spark, "once"), scratch_path(spark, "once-out")
    schema = "txId string, status string, retriedTimes int, phase int"
    sizes, n = [], 0
    for turn in range(5):
        message = lambda i: {"txId": f"t{i}", "status": "CREATED", "retriedTimes": 0, "phase": 0}
        fresh = [message(n + i) for i in range(20)]
        _lines(src, f"{turn}.json", fresh + fresh)               # a message again in its batch
        _lines(src, f"{turn}-again.json", fresh[:10])            # and within the bound
        n += 20
        messages = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(src)
        query = (workflow.once(messages, "3 seconds").writeStream.format("parquet").option("path", target)
                 .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        query.awaitTermination()
        sizes.append(query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
        time.sleep(4)
    out = spark.read.parquet(target)
    assert out.count() == out.select("txId").distinct().count() == n
    assert max(sizes) <= 40 and n == 100                         # what was read before the bound is forgotten


def test_final_windows_and_late_rows(spark):
    src = _dir()
    row = lambda s, v: {"ts": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime(BASE_S // 3600 * 3600 + s)), "kind": "a", "value": v}
    _lines(src, "a.json", [row(0, 1.0), row(700, 2.0)])
    _lines(src, "b.json", [row(4000, 4.0)])
    _lines(src, "c.json", [row(10, 8.0), row(4100, 16.0)])        # the first window is over: late
    _lines(src, "d.json", [row(9000, 32.0)])
    events = spark.readStream.schema("ts timestamp, kind string, value double").option("maxFilesPerTrigger", 1).json(src)
    final, late, progress = jobs.run_final_windows(events, "10 minutes", ["kind"], "value", "5 minutes", max_files=1)
    assert sorted((r.n, r.total) for r in final.collect()) == [(1, 1.0), (1, 2.0), (2, 20.0)]
    assert [r.value for r in late.collect()] == [8.0]
    state = [p["stateOperators"][0] for p in progress]
    assert sum(s["numRowsDroppedByWatermark"] for s in state) == 0       # none is lost on the way
    assert state[-1]["numRowsTotal"] < max(s["numRowsTotal"] for s in state)


def _pairs(x, y):
    a, b = x.column("a").to_pylist(), y.column("b").to_pylist()
    out = [(i, j) for i in a for j in b] or [(i, None) for i in a] or [(None, j) for j in b]
    return pa.table({"a": pa.array([i for i, _ in out], pa.int64()), "b": pa.array([j for _, j in out], pa.int64())})


def test_cogroup_cuts_hot_keys_and_meets_every_pair_once(spark):
    left = [("hot", i) for i in range(50)] + [("one", 900), ("left", 901), (None, 902)]
    right = [("hot", i) for i in range(100, 170)] + [("one", 800), ("right", 801), (None, 802)]
    a, b = spark.createDataFrame(left, "k string, a long"), spark.createDataFrame(right, "k string, b long")
    sizes = []
    out = cogroup(a, b, "k", _pairs, "a long, b long", block_rows=12).collect()
    want = [(i, j) for i in range(50) for j in range(100, 170)] + [(900, 800), (901, None), (None, 801), (902, 802)]
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str) and sizes == []

    def count(x, y):
        return pa.table({"k": x.column("k").slice(0, 1) if x.num_rows else pa.array(["-"]),
                         "n": pa.array([x.num_rows * y.num_rows], pa.int64()), "most": pa.array([max(x.num_rows, y.num_rows)], pa.int64())})

    merged = cogroup(a, b, "k", count, "k string, n long, most long", block_rows=12,
                     merge=lambda d: d.groupBy("k").agg(F.sum("n").alias("n"), F.max("most").alias("most")))
    got = {r.k: (r.n, r.most) for r in merged.collect()}
    assert got["hot"][0] == 3500 and got["hot"][1] < 50 and got["one"][0] == 1


def test_cogroup_along_an_order_sends_each_row_once(spark):
    left = [("hot", i, float(i % 40)) for i in range(200)] + [("hot", 900, None), ("one", 901, 1.0), ("left", 902, 1.0)]
    right = [("hot", float(i % 50)) for i in range(300)] + [("hot", None), ("one", 2.0), ("one", 1.0), ("right", 3.0)]
    right += [("hot", 7.0)] * 100                                   # one place with more rows than a block
    a, b = spark.createDataFrame(left, "k string, a long, x double"), spark.createDataFrame(right, "k string, y double")

    def behind(p, q):
        y = np.sort(q.column("y").to_numpy())
        n = len(y) - np.searchsorted(y, p.column("x").to_numpy(), side="right") + p.column("later").to_numpy()
        return pa.table({"a": p.column("a"), "n": pa.array(n.astype(np.int64)),
                         "seen": pa.array([p.num_rows + q.num_rows] * p.num_rows, pa.int64())})

    def run(block_rows):
        out = cogroup(a, b, "k", behind, "a long, n long, seen long", block_rows=block_rows, order=("x", "y"),
                      beyond={"later": "1"}, merge=lambda d: d.groupBy("a").agg(
                          F.sum("n").alias("n"), F.max("seen").alias("seen"), F.count("*").alias("calls")))
        return {r.a: (r.n, r.seen, r.calls) for r in out.collect()}

    want = {i: sum(y is None or x is not None and y > x for k, y in right if k == g) for g, i, x in left}
    want[900] = 0                                                   # nothing lies behind a null
    whole, cut = run(10_000), run(24)
    assert {i: n for i, (n, _, _) in whole.items()} == want and {i: n for i, (n, _, _) in cut.items()} == want
    assert max(seen for _, seen, _ in cut.values()) < 100
    # an order is handed to the function once, but at the place with too many rows
    assert all(calls == 1 for i, (_, _, calls) in cut.items() if i >= 900 or i % 40 > 20)


def test_flat_map_hands_over_bounded_batches(spark):
    long = parts(pa.record_batch({"t": ["x" * 100, None, "y" * 900, "", "z" * 90, "z" * 5], "n": [1, 2, 3, 4, 5, 6]}), 200)
    assert [p.column("n").to_pylist() for p in long] == [[1, 2], [3], [4, 5, 6]]

    def seen(batch):
        yield pa.table({"rows": pa.array([batch.num_rows], pa.int64()), "bytes": pa.array([batch.nbytes], pa.int64())})

    df = spark.range(4000, numPartitions=1).select(F.repeat(F.lit("word "), 400).alias("text"))
    got = flat_map(df, seen, "rows long, bytes long").collect()
    assert sum(r.rows for r in got) == 4000 and max(r.bytes for r in got) <= 1.1 * PART_BYTES


def test_keyed_process_on_a_table_in_a_new_application():
    code = (
        "import pandas as pd\n"
        "from pyspark.sql import types as T\n"
        "from tributary.functions.user import keyed_process\n"
        "from tributary.session import build_session\n"
        "def count(key, rows, state):\n"
        "    yield 'all', pd.DataFrame({'k': [key[0]], 'n': [len(rows)]})\n"
        "spark = build_session('local[2]', 2)\n"
        "df = spark.createDataFrame([('x',), ('y',), ('x',)], 'k string')\n"
        "schema = T.StructType([T.StructField('k', T.StringType()), T.StructField('n', T.LongType())])\n"
        "print(sorted(map(tuple, keyed_process(df, ['k'], count, schema).collect())))\n")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0 and "[('x', 2, 'all'), ('y', 1, 'all')]" in done.stdout, done.stderr[-2000:]


def test_users_functions(spark):
    def split(batch):
        words = [w for t in batch.column(0).to_pylist() for w in (t or "").split()]
        yield pa.table({"word": pa.array(words, pa.string())})
        yield pa.table({"word": pa.array([], pa.string())})

    df = spark.createDataFrame([("a b",), (None,), ("",), ("b c b",)], "text string")
    assert _rows(flat_map(df, split, "word string").groupBy("word").count()) == [("a", 1), ("b", 3), ("c", 1)]

    def running(key, rows, state):
        seen = int(state.get() or 0) + len(rows)
        state.put(str(seen))
        yield ("many" if seen > 2 else "few"), pd.DataFrame({"k": [key[0]], "n": [seen]})

    src = _dir()
    _lines(src, "a.json", [{"k": "x"}, {"k": "y"}, {"k": "x"}])
    _lines(src, "b.json", [{"k": "x"}])
    stream = spark.readStream.schema("k string").option("maxFilesPerTrigger", 1).json(src)
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType())])
    out = jobs.run_available(keyed_process(stream, ["k"], running, schema), "append", "user")
    assert _rows(output(out, "few")) == [("x", 2), ("y", 1)] and _rows(output(out, "many")) == [("x", 3)]


@pytest.mark.parametrize("pending", [False, True])
def test_external_rows_need_no_state(spark, pending):
    src = _write_tx([("t1", "external", "A", 9, 0, S.CREATED, 0), ("t2", "B", "external", 9, 1, S.DEBIT_SUCCESS, 0),
                     ("t3", "External", "A", 9, 2, S.RETRY_BALANCE_NOT_ENOUGH, 0), ("t4", "A", "B", 1, 3, S.CREATED, 0)],
                    [("late", "Z", "Y", 0, 100, S.CREATED, 0)], [("later", "Z", "Y", 0, 200, S.CREATED, 0)])
    tx = _tx_stream(spark, src)
    stream = jobs.pending_debit_stream(tx) if pending else jobs.checked_debit_stream(tx)
    ckpt = scratch_path(spark, "ext")
    got = {r.txId: r.status for r in jobs.run_available(stream, "append", "ext", checkpoint=ckpt).collect()}
    assert got["t1"] == S.DEBIT_SUCCESS and got["t2"] == S.FULFILLED
    assert got.get("t3") == (None if pending else S.DEBIT_SUCCESS)
    keys = {r.account for r in jobs.read_state(spark, ckpt, "balance").select("key.account").collect()}
    assert not any(k.lower() == "external" for k in keys)
