"""Structured Streaming: stream = batch, restart from checkpoint, timers."""

import os
import tempfile

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tributary import schemas as S
from tributary.operators import debit, legs
from tributary.session import scratch_path
from tributary.sources.ledger import ledger_from_events, read_ledger
from tributary.streaming import jobs


# Test times are seconds after this instant (rows at the epoch itself would sit
# on the initial watermark and be dropped as late).
BASE_S = 1_700_000_000


def _dir():
    return tempfile.mkdtemp(prefix="tributary-stream-")


def test_checked_debit_stream_equals_batch(spark):
    stream_tx = debit.first_round_feed(ledger_from_events(jobs.events_stream(spark, SF_SMALL)))
    got = jobs.run_available(jobs.checked_debit_stream(stream_tx), "append", "t2")
    batch = debit.checked_debit(debit.first_round_feed(read_ledger(spark, SF_SMALL)))
    cols = ["txId", "phase", "account", "status"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, batch.select(*cols).collect()))
    # balances of non-external accounts agree row by row
    nb = got.where(F.col("balance_after").isNotNull()).select("txId", "phase", "balance_after")
    bb = batch.where(F.lower("account") != "external").select("txId", "phase", "balance_after")
    assert sorted(map(tuple, nb.collect())) == sorted(map(tuple, bb.collect()))


def test_balance_stream_restarts_from_checkpoint(spark):
    table = pq.read_table(os.path.join(SF_SMALL, "events.parquet"))
    half = table.num_rows // 2
    src = _dir()
    pq.write_table(table.slice(0, half), os.path.join(src, "part-a.parquet"))
    schema = spark.read.parquet(os.path.join(SF_SMALL, "events.parquet")).schema
    ckpt = scratch_path(spark, "restart-ckpt")
    out = scratch_path(spark, "restart-out")

    def run():
        ev = spark.readStream.schema(schema).parquet(src).withColumn("ts", F.col("ts").cast("timestamp"))
        return jobs.run_available(jobs.account_balance_stream(ev), "complete", "restart",
                                  checkpoint=ckpt, target=out)

    first = {r.account: r.balance for r in run().collect()}
    pq.write_table(table.slice(half), os.path.join(src, "part-b.parquet"))
    second = {r.account: r.balance for r in run().collect()}
    expected = {r.account: r.balance for r in
                legs.account_balance(legs.split_legs(read_ledger(spark, SF_SMALL))).collect()}
    assert first != expected
    assert second == expected
    state = jobs.read_state(spark, ckpt).select(F.col("key.account").alias("account"),
                                                (F.col("value.sum") / 100.0).alias("balance"))
    assert {r.account: r.balance for r in state.collect()} == expected


def _write_tx(*batches):
    """Each batch of rows (txId, from, to, amount, second, status, retried) -> one
    parquet file of BANK_TX, read one file per micro-batch.  Event-time timers
    fire in the batch after the watermark passes them, so timer tests end with
    two later batches."""
    src = _dir()
    seq = 0
    for i, rows in enumerate(batches):
        pq.write_table(_tx_table(rows, seq), os.path.join(src, f"tx-{i}.parquet"))
        os.utime(os.path.join(src, f"tx-{i}.parquet"), (1_000_000 + i, 1_000_000 + i))
        seq += len(rows)
    return src


def _tx_table(rows, seq0):
    return pa.table({
        "txId": [r[0] for r in rows], "fromAccount": [r[1] for r in rows],
        "toAccount": [r[2] for r in rows], "amount": [float(r[3]) for r in rows],
        "instant": pa.array([(BASE_S + r[4]) * 1_000_000 for r in rows], pa.timestamp("us", tz="UTC")),
        "status": [r[5] for r in rows], "retriedTimes": pa.array([r[6] for r in rows], pa.int32()),
        "maxWaitTime": pa.array([0] * len(rows), pa.int64()),
        "seq": pa.array(list(range(seq0, seq0 + len(rows))), pa.int64()),
        "phase": pa.array([0] * len(rows), pa.int32()),
    })


def _tx_stream(spark, src):
    schema = ("txId string, fromAccount string, toAccount string, amount double, instant timestamp, "
              "status string, retriedTimes int, maxWaitTime long, seq long, phase int")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)


def test_pending_stream_timers(spark):
    src = _write_tx([
        ("t1", "A", "B", 8, 0, S.CREATED, 0),
        ("t2", "A", "B", 3, 1, S.CREATED, 0),
        ("c1", "external", "A", 5, 2, S.DEBIT_SUCCESS, 0),
    ], [("late", "Z", "Y", 0, 100, S.CREATED, 0)],    # moves the watermark past t1's deadline
        [("later", "Z", "Y", 0, 200, S.CREATED, 0)])
    out = jobs.run_available(jobs.pending_debit_stream(_tx_stream(spark, src), max_wait_ms=10_000),
                             "append", "t3")
    got = {r.txId: r.status for r in out.collect()}
    assert got["c1"] == S.FULFILLED and got["t2"] == S.DEBIT_SUCCESS
    assert got["t1"] == S.CANCELLED_BALANCE_NOT_ENOUGH
    assert got["late"] == S.DEBIT_SUCCESS


def test_wait_retry_stream(spark):
    src = _write_tx([
        ("r0", "A", "B", 1, 0, S.RETRY_BALANCE_NOT_ENOUGH, 0),
        ("r5", "A", "B", 1, 0, S.RETRY_BALANCE_NOT_ENOUGH, 5),
    ], [("late", "A", "B", 1, 100, S.RETRY_BALANCE_NOT_ENOUGH, 5)],
        [("later", "A", "B", 1, 200, S.RETRY_BALANCE_NOT_ENOUGH, 5)])
    out = jobs.run_available(jobs.wait_retry_stream(_tx_stream(spark, src)), "append", "t4")
    got = {r.txId: (r.route, r.status, r.retriedTimes, r.due_ms) for r in out.collect()}
    assert got["r0"] == ("retry", S.RETRY_BALANCE_NOT_ENOUGH, 1, BASE_S * 1000 + 500)
    assert got["r5"][:3] == ("cancel", S.CANCELLED_BALANCE_NOT_ENOUGH, 5)


def test_delayed_echo_stream(spark):
    src = _dir()
    parts = [(["hello", "world", "hello"], [0, 1_000_000, 1_500_000]),
             (["tick"], [100_000_000]), (["tock"], [200_000_000])]
    for i, (w, ts) in enumerate(parts):
        f = os.path.join(src, f"w-{i}.parquet")
        stamps = [BASE_S * 1_000_000 + t for t in ts]
        pq.write_table(pa.table({"word": w, "ts": pa.array(stamps, pa.timestamp("us", tz="UTC"))}), f)
        os.utime(f, (1_000_000 + i, 1_000_000 + i))
    words = (spark.readStream.schema("word string, ts timestamp")
             .option("maxFilesPerTrigger", 1).parquet(src))
    out = jobs.run_available(jobs.delayed_echo_stream(words), "append", "t5")
    got = sorted((r.word, r.echo_ms) for r in out.collect())
    base = BASE_S * 1000
    assert ("hello", base + 2000) in got and ("hello", base + 3500) in got and ("world", base + 3000) in got


def test_control_block_stream(spark):
    src = _dir()
    pq.write_table(pa.table({
        "key": ["harbour", "pebble", "pebble", "lantern", "harbour", "harbour", "orchard"],
        "tag": ["data", "control", "data", "data", "control", "data", "data"],
        "value": ["before", "", "blocked", "free", "", "after", "free too"],
        "seq": pa.array([0, 1, 2, 3, 4, 5, 6], pa.int64()),
    }), os.path.join(src, "c.parquet"))
    tagged = spark.readStream.schema("key string, tag string, value string, seq long").parquet(src)
    out = jobs.run_available(jobs.control_block_stream(tagged), "append", "j1")
    # a data row that comes before its control row passes
    assert sorted(r.value for r in out.collect()) == ["before", "free", "free too"]


def test_topic_workflows_equal_bounded_rounds(spark):
    from tributary.operators.workflow import workflow_pending, workflow_retry
    from tributary.streaming.workflow import run_until_quiet
    tx = read_ledger(spark, SF_SMALL)
    for pending_design, bounded in ((False, workflow_retry), (True, workflow_pending)):
        completed, loops = run_until_quiet(tx, pending_design)
        got = {(r.txId, r.status, r.retriedTimes) for r in completed.collect()}
        done, _, rounds = bounded(tx)
        want = {(r.txId, r.status, r.retriedTimes) for r in done.collect()}
        assert loops == rounds
        if pending_design:
            # the stream keeps waiting on what the bounded run cancels at end of input
            assert got <= want
            assert {g for g in want - got if g[1] != S.CANCELLED_BALANCE_NOT_ENOUGH} == set()
        else:
            assert got == want


def test_transfer_state_lookup_by_state_name(spark):
    """Q3: balances read by state name from the checked-debit stream's checkpoint."""
    ckpt = scratch_path(spark, "t2-state")
    tx = debit.first_round_feed(ledger_from_events(jobs.events_stream(spark, SF_SMALL)))
    jobs.run_available(jobs.checked_debit_stream(tx), "append", "t2-state", checkpoint=ckpt)
    state = jobs.read_state(spark, ckpt, state_var="balance")
    got = {r.key.account: r.value.cents for r in state.collect()}
    batch = debit.checked_debit(debit.first_round_feed(read_ledger(spark, SF_SMALL)))
    last = (batch.where(F.lower("account") != "external")
            .groupBy("account").agg(F.max_by("balance_after", F.struct("instant", "seq", "phase")).alias("b")))
    want = {r.account: int(round(r.b * 100)) for r in last.collect()}
    assert got == want


def test_text_line_stream_word_count(spark):
    """S2 + A2: a folder of text lines as a stream, running word counts."""
    from tests.test_fixtures import VERSE
    from tributary.sources.topics import read_lines
    src = _dir()
    with open(os.path.join(src, "lines.txt"), "w") as fh:
        fh.write("\n".join(VERSE) + "\n")
    lines = read_lines(spark, path=src).withColumnRenamed("value", "text")
    counts = {r.word: r.cnt for r in jobs.run_available(jobs.word_count_stream(lines), "complete", "lines").collect()}
    assert counts["to"] == 4 and len(counts) == 26


def test_live_wait_stage_republishes_after_backoff(spark):
    """T4 wired into T7 with processing-time timers: a RETRY transfer comes back
    on the raw topic with counter+1 after its backoff; one retried 5 times is
    cancelled to the completed topic; a DEBIT_SUCCESS passes to raw."""
    import glob
    import json
    import time as _time
    from tributary.streaming.workflow import _FIELDS, after_debit_job
    from tributary.functions.codec import to_messages
    from tributary.sources.topics import topic_path
    base = _dir()
    rows = [("r0", "A", "B", 1.0, S.RETRY_BALANCE_NOT_ENOUGH, 0),
            ("r5", "A", "B", 1.0, S.RETRY_BALANCE_NOT_ENOUGH, 5),
            ("d1", "A", "B", 1.0, S.DEBIT_SUCCESS, 0)]
    tx = spark.createDataFrame(
        [(t, f, to, a, st, n) for t, f, to, a, st, n in rows],
        "txId string, fromAccount string, toAccount string, amount double, status string, retriedTimes int")
    tx = tx.select("txId", "fromAccount", "toAccount", "amount",
                   F.timestamp_seconds(F.lit(BASE_S)).alias("instant"), "status", "retriedTimes",
                   F.lit(0).cast("long").alias("maxWaitTime"), F.lit(0).cast("long").alias("seq"),
                   F.lit(0).alias("phase"))
    to_messages(tx, fields=_FIELDS).select("key", "value").write.json(
        os.path.join(topic_path(base, S.TOPIC_RETRY), "seed"))

    def read(topic):
        out = {}
        for f in glob.glob(os.path.join(topic_path(base, topic), "*", "*.json")):
            for line in open(f):
                v = json.loads(json.loads(line)["value"])
                out[v["txId"]] = v
        return out

    q = after_debit_job(spark, base, False, scratch_path(spark, "live-wait"), live_wait=True,
                        trigger={"processingTime": "500 milliseconds"})
    try:
        deadline = _time.time() + 60
        while _time.time() < deadline and "r0" not in read(S.TOPIC_RAW):
            _time.sleep(1)
    finally:
        q.stop()
    raw, done = read(S.TOPIC_RAW), read(S.TOPIC_COMPLETED)
    assert raw["r0"]["retriedTimes"] == 1 and raw["r0"]["status"] == S.RETRY_BALANCE_NOT_ENOUGH
    assert raw["d1"]["phase"] == 1
    assert done["r5"]["status"] == S.CANCELLED_BALANCE_NOT_ENOUGH


def test_live_pending_deadline_cancels(spark):
    """T3 wired into T8 with processing-time deadlines: an unfunded debit waits
    in the pending list and is cancelled once its max wait has passed."""
    import glob
    import json
    import time as _time
    from tributary.streaming.workflow import balance_job, seed
    from tributary.sources.ledger import transfers_from_rows
    from tributary.sources.topics import topic_path
    base = _dir()
    seed(transfers_from_rows(spark, [("p1", "A", "B", 5), ("ok", "external", "C", 1)]), base)

    def read():
        out = {}
        for f in glob.glob(os.path.join(topic_path(base, S.TOPIC_RETRY), "*", "*.json")):
            for line in open(f):
                v = json.loads(json.loads(line)["value"])
                out[(v["txId"], v["status"])] = v
        return out

    q = balance_job(spark, base, True, scratch_path(spark, "live-pending"), live_max_wait_ms=1500,
                    trigger={"processingTime": "500 milliseconds"})
    try:
        deadline = _time.time() + 60
        while _time.time() < deadline and ("p1", S.CANCELLED_BALANCE_NOT_ENOUGH) not in read():
            _time.sleep(1)
    finally:
        q.stop()
    got = read()
    assert ("p1", S.CANCELLED_BALANCE_NOT_ENOUGH) in got
    assert ("ok", S.DEBIT_SUCCESS) in got
    assert ("p1", S.DEBIT_SUCCESS) not in got


def test_enrich_stream_equals_batch(spark):
    """J3 stream form: latest tx state kept by a streaming aggregation, legs
    enriched per micro-batch, equal to the bounded broadcast_enrich."""
    from tributary.operators.joins import enrich, latest_per_key
    from tributary.operators.legs import split_legs
    feed = debit.first_round_feed(ledger_from_events(jobs.events_stream(spark, SF_SMALL)))
    checked = jobs.checked_debit_stream(feed).select("txId", "status", "instant", "seq", "phase")
    states_path = scratch_path(spark, "j3-states")                       # the state topic
    states = jobs.run_available(checked, "append", "j3-states", target=states_path)
    state_table = scratch_path(spark, "j3-latest")
    latest = jobs.latest_state_stream(spark.readStream.schema(states.schema).parquet(states_path),
                                      "txId", ["status"], ["instant", "seq", "phase"])
    jobs.run_available(latest.withColumnRenamed("status", "tx_status"), "complete", "j3-latest",
                       target=state_table)
    legs_stream = split_legs(ledger_from_events(jobs.events_stream(spark, SF_SMALL)),
                             fields=("txId", "account", "amount", "phase"))
    target = scratch_path(spark, "j3-out")
    q = jobs.enrich_stream(legs_stream, state_table, "txId", target, scratch_path(spark, "j3-ck"))
    q.awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(target).select("txId", "account", "phase", "tx_status").collect()))
    bl = split_legs(read_ledger(spark, SF_SMALL), fields=("txId", "account", "amount", "phase"))
    state = latest_per_key(debit.checked_debit(debit.first_round_feed(read_ledger(spark, SF_SMALL))),
                           "txId", ["status"], ["instant", "seq", "phase"]).withColumnRenamed("status", "tx_status")
    want = sorted(map(tuple, enrich(bl, state, "txId").select("txId", "account", "phase", "tx_status").collect()))
    assert got == want


def test_streams_over_a_table_of_several_files(spark):
    """A table that is a folder of files streams like one that is a file."""
    src = _dir()
    whole = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    whole.repartition(3).write.parquet(os.path.join(src, "events.parquet"))
    for max_files in (None, 1):
        stream = jobs.read_table_stream(spark, src, "events", max_files)
        got = jobs.run_available(stream, "append", "folder")
        assert got.exceptAll(whole).count() == 0 and got.count() == whole.count()


def test_replayed_messages_change_no_balance(spark):
    """Messages published twice (an at-least-once sink after a replay) are taken once."""
    from tributary.sources.topics import topic_path
    from tributary.streaming.workflow import _FIELDS, balance_job, seed
    base, checkpoint = _dir(), _dir()
    seed(read_ledger(spark, SF_SMALL).limit(300), base)
    raw = f"{topic_path(base, S.TOPIC_RAW)}/"
    spark.read.json(raw + "seed").write.json(raw + "again")
    for _ in range(2):
        balance_job(spark, base, False, checkpoint).awaitTermination()
        spark.read.json(raw + "seed").write.mode("overwrite").json(raw + "third")
    out = spark.read.json(f"{topic_path(base, S.TOPIC_RETRY)}/*")
    assert len(_FIELDS) > 5 and out.count() == 300


def test_interval_join_ends_without_a_scan_of_all_state(spark):
    """One micro-batch for all rows, none that only looks through the state; the session's settings stay."""
    import glob

    from tributary.plans.registry import load_all
    from tributary.session import ensure_checkpoint_dir
    before = {key: spark.conf.get(key, None) for key in jobs.ROWS_ONLY}
    found = os.path.join(ensure_checkpoint_dir(spark), "interval-join-ckpt-*")
    known = set(glob.glob(found))
    assert load_all()["interval_join_stream"].build(spark, SF_SMALL).count() > 0
    checkpoint, = set(glob.glob(found)) - known
    assert [f for f in os.listdir(os.path.join(checkpoint, "commits")) if f.isdigit()] == ["0"]
    assert {key: spark.conf.get(key, None) for key in jobs.ROWS_ONLY} == before
