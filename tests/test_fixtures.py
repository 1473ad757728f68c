"""Golden tests on fixed inputs: the verse sample is a fixed value, all other inputs are our own."""

from pyspark.sql import functions as F

from tributary import schemas as S
from tributary.functions import ledger as L
from tributary.operators import debit, joins, legs, wordcount
from tributary.sources.ledger import chain_transfers, transfers_from_rows

# Fixed input: four lines of verse used as the word-count sample.
VERSE = [
    "To be, or not to be,--that is the question:--",
    "Whether 'tis nobler in the mind to suffer",
    "The slings and arrows of outrageous fortune",
    "Or to take arms against a sea of troubles,",
]


def test_x1_word_count(spark):
    lines = spark.createDataFrame([(v,) for v in VERSE], "text string")
    counts = {r.word: r.cnt for r in wordcount.word_count(lines).collect()}
    assert len(counts) == 26
    assert sum(counts.values()) == 34
    assert counts["to"] == 4 and counts["the"] == 3
    assert counts["be"] == counts["of"] == counts["or"] == 2
    assert all(v == 1 for k, v in counts.items() if k not in {"to", "the", "be", "of", "or"})


def test_x1_running_count_matches_final(spark):
    lines = spark.createDataFrame([(i, v) for i, v in enumerate(VERSE)], "line long, text string")
    running = wordcount.word_count_running(lines, ["line"])
    last = {r.word: r.m for r in running.groupBy("word").agg(F.max("running_count").alias("m")).collect()}
    assert last["to"] == 4
    rows = running.where(F.col("word") == "to").orderBy("line", "pos").collect()
    assert [r.running_count for r in rows] == [1, 2, 3, 4]


def test_x2_control_block(spark):
    control = spark.createDataFrame([("pebble",), ("harbour",), (None,)], "key string")
    data = spark.createDataFrame([("lantern",), ("pebble",), ("pebble",), ("orchard",), ("harbour",)], "key string")
    out = sorted(r.key for r in joins.block_by_control(data, control, "key").collect())
    assert out == ["lantern", "orchard"]


def test_x3_self_connect(spark):
    tx = transfers_from_rows(spark, [("a", "100001", "100002", 1), ("b", "100002", "100003", 1)])
    out = legs.self_connect_balance(tx).collect()
    assert len(out) == 4
    assert sorted((r.txId, r.status) for r in out) == [
        ("a", S.DEBIT_SUCCESS), ("a", S.FULFILLED), ("b", S.DEBIT_SUCCESS), ("b", S.FULFILLED)]
    bal = {r.account: r.balance for r in legs.account_balance(legs.split_legs(tx)).collect()}
    assert bal == {"100001": -1.0, "100002": 0.0, "100003": 1.0}


def test_x4_chain(spark):
    tx = chain_transfers(spark.range(1, 11))
    lg = legs.split_legs(tx)
    assert lg.count() == 20
    bal = {r.account: r.balance for r in legs.account_balance(lg).collect()}
    assert bal["100001"] == -1.0 and bal["100011"] == 1.0
    assert all(bal[str(a)] == 0.0 for a in range(100002, 100011))


def test_x5_lookup_and_range(spark):
    tx = transfers_from_rows(spark, [("t", "100001", "100002", 1)])
    bal = legs.account_balance(legs.split_legs(tx))
    keys = spark.createDataFrame([("100002",), ("100001",), ("100999",)], "account string")
    got = {r.account: r.balance for r in joins.lookup(keys, bal, "account").collect()}
    assert got == {"100002": 1.0, "100001": -1.0, "100999": None}
    rng = joins.lookup(joins.range_keys(spark, "100001-100003"), bal, "account").orderBy("pos").collect()
    assert [(r.account, r.balance) for r in rng] == [("100001", -1.0), ("100002", 1.0), ("100003", None)]


def test_x6_double_odds(spark):
    df = spark.createDataFrame([(v,) for v in [1, 2, 3, 4, 5, -3]], "v long")
    out = [r.d for r in df.where(F.col("v") % 2 == 1).select((F.col("v") * 2).alias("d")).orderBy("d").collect()]
    assert out == [2, 6, 10]


def _tx(spark, rows):
    return transfers_from_rows(spark, rows)


def test_y1_checked_debit_trace(spark):
    tx = _tx(spark, [
        ("1", "A", "B", 5, S.CREATED),
        ("2", "external", "A", 10, S.DEBIT_SUCCESS),
        ("3", "A", "B", 5, S.RETRY_BALANCE_NOT_ENOUGH),
        ("4", "A", "C", 5, S.CREATED),
        ("5", "A", "D", 7, S.FULFILLED),
        ("6", "External", "A", 10, S.CREATED),
    ])
    out = {r.txId: (r.status, r.balance_after) for r in debit.checked_debit(tx).collect()}
    assert out["1"] == (S.RETRY_BALANCE_NOT_ENOUGH, 0.0)
    assert out["2"] == (S.FULFILLED, 10.0)
    assert out["3"] == (S.DEBIT_SUCCESS, 5.0)
    assert out["4"] == (S.DEBIT_SUCCESS, 0.0)
    assert out["5"] == (S.FULFILLED, 0.0)
    assert out["6"] == (S.DEBIT_SUCCESS, -10.0)


def test_y2_pending_trace(spark):
    tx = _tx(spark, [
        ("t1", "A", "B", 8, S.CREATED),
        ("t2", "A", "B", 3, S.CREATED),
        ("t3", "A", "B", 2, S.CREATED),
        ("c1", "external", "A", 5, S.DEBIT_SUCCESS),
        ("t9", "A", "B", 0, S.RETRY_BALANCE_NOT_ENOUGH),
    ])
    out = {r.txId: (r.status, r.balance_after) for r in debit.pending_debit(tx, max_wait_ms=None).collect()}
    assert out["c1"] == (S.FULFILLED, 5.0)
    assert out["t2"][0] == S.DEBIT_SUCCESS and out["t3"] == (S.DEBIT_SUCCESS, 0.0)
    assert out["t1"][0] == S.CANCELLED_BALANCE_NOT_ENOUGH
    assert "t9" not in out
    assert len(out) == 4


def test_y2_pending_deadline(spark):
    # t1 waits 2 s; the credit at 3 s comes after its deadline, so t1 is cancelled
    # before the credit and the credit stays on the balance.
    tx = _tx(spark, [("t1", "A", "B", 1, S.CREATED), ("x", "A", "B", 0, "OTHER"),
                     ("x2", "A", "B", 0, "OTHER"), ("c1", "external", "A", 5, S.DEBIT_SUCCESS)])
    out = {r.txId: (r.status, r.balance_after) for r in debit.pending_debit(tx, max_wait_ms=2000).collect()}
    assert out["t1"] == (S.CANCELLED_BALANCE_NOT_ENOUGH, 0.0)
    assert out["c1"] == (S.FULFILLED, 5.0)


def test_y3_retry_backoff(spark):
    df = spark.range(0, 7).select(F.col("id").cast("int").alias("n"))
    got = {r.n: (r.d, r.route) for r in df.select(
        "n", L.retry_delay_ms(F.col("n")).alias("d"), L.retry_decision(F.col("n")).alias("route")).collect()}
    assert [got[i][0] for i in range(5)] == [500, 5000, 10000, 10000, 10000]
    assert [got[i][1] for i in range(7)] == ["retry"] * 5 + ["cancel"] * 2


def test_y4_routes(spark):
    df = spark.createDataFrame([(s,) for s in S.STATUSES], "status string")
    v1 = {r.status: r.r for r in df.select("status", L.route_after_debit(F.col("status")).alias("r")).collect()}
    assert v1 == {S.DEBIT_SUCCESS: "raw", S.FULFILLED: "completed", S.RETRY_BALANCE_NOT_ENOUGH: "wait",
                  S.CREATED: None, S.CANCELLED_BALANCE_NOT_ENOUGH: None}
    v2 = {r.status: r.r for r in df.select("status", L.route_after_debit2(F.col("status")).alias("r")).collect()}
    assert v2[S.DEBIT_SUCCESS] == "raw"
    assert all(v == "completed" for k, v in v2.items() if k != S.DEBIT_SUCCESS)


def test_json_round_trip_with_decimal_and_iso_instants(spark):
    from tributary.functions.codec import decode_frame
    msgs = spark.createDataFrame([
        ('{"txId":"a","fromAccount":"1","toAccount":"2","amount":1.5,"instant":1622505600.123456789,'
         '"status":"CREATED","retriedTimes":0,"maxWaitTime":0}',),
        ('{"txId":"b","fromAccount":"1","toAccount":"2","amount":2.0,"instant":"2021-06-01T00:00:00.5Z",'
         '"status":"CREATED","retriedTimes":1,"maxWaitTime":7}',)], "value string")
    out = {r.txId: r for r in decode_frame(msgs).collect()}
    assert out["a"].instant is not None and out["b"].instant is not None
    micros_a = spark.createDataFrame([(out["a"].instant,)], "t timestamp").select(F.unix_micros("t")).first()[0]
    assert micros_a == 1622505600123456
    assert out["b"].retriedTimes == 1 and out["b"].maxWaitTime == 7


def test_topic_round_trip_through_directory(spark, tmp_path):
    from tributary.sinks.topics import routed_messages, text_messages, write_topics
    from tributary.sources.topics import read_topic
    tx = _tx(spark, [("a", "1", "2", 1, S.DEBIT_SUCCESS), ("b", "1", "2", 2, S.FULFILLED)])
    base = str(tmp_path / "topics")
    write_topics(routed_messages(tx, key=F.col("fromAccount")), base)
    raw = read_topic(spark, S.TOPIC_RAW, base=base, stream=False).collect()
    done = read_topic(spark, S.TOPIC_COMPLETED, base=base, stream=False).collect()
    assert [r.txId for r in raw] == ["a"] and [r.txId for r in done] == ["b"]
    assert raw[0].instant is not None
    lines = spark.createDataFrame([("hello",)], "text string")
    msg = text_messages(lines, F.upper(F.col("text"))).first()
    assert msg.key == msg.value == "HELLO"


def test_k1_print_rows_batch_and_stream(spark, tmp_path, capsys):
    from tributary.sinks.topics import print_rows
    from tributary.sources.topics import read_lines
    many = spark.range(57).selectExpr("concat('row ', id) AS text")
    assert print_rows(many, label="myOutput") is None
    printed = capsys.readouterr().out
    assert all(f"myOutput | row {i}\n" in printed for i in range(57))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "l.txt").write_text("\n".join(VERSE) + "\n")
    q = print_rows(read_lines(spark, path=str(tmp_path / "in")), label="myOutput")
    q.processAllAvailable()
    q.stop()
    assert q.exception() is None
    printed = capsys.readouterr().out
    assert all(f"myOutput | {v}" in printed for v in VERSE)


def test_running_count_with_a_wide_second_order_column(spark):
    """Turns beyond 2^20 of one conversation stay before the next conversation's."""
    rows = [(1, 0, "word"), (1, 1_048_581, "word"), (2, 0, "word"), (2, 7, "word"), (3, None, "word")]
    df = spark.createDataFrame(rows[:4], "conv_id long, turn long, text string")
    got = {(r.conv_id, r.turn): r.running_count
           for r in wordcount.word_count_running(df, ["conv_id", "turn"]).collect()}
    assert got == {(1, 0): 1, (1, 1_048_581): 2, (2, 0): 3, (2, 7): 4}


def test_descending_range_is_empty(spark):
    ranges = spark.createDataFrame([("5-1",), ("3-5",), ("4-4",)], "r string")
    got = [r[0] for r in ranges.select(L.expand_range(F.col("r"))).collect()]
    assert got == [[], ["3", "4", "5"], ["4"]]


def test_half_cents_round_alike_in_batch_and_stream(spark):
    from tributary.streaming.processors import whole_cents
    amounts = [0.125, 0.375, 2.5, 0.005, -0.125, 1.005, 10.0, 0.0]
    df = spark.createDataFrame([(a,) for a in amounts], "a double")
    assert [r[0] for r in df.select(L.cents(F.col("a"))).collect()] == whole_cents(amounts).tolist()


def test_workflow_own_limit_raises_and_state_is_compacted(spark, monkeypatch):
    import pytest

    from tributary.operators import workflow
    tx = transfers_from_rows(spark, [("d", S.EXTERNAL_ACCOUNT, "a0", 1)]
                             + [(f"c{i}", f"a{i}", f"a{i + 1}", 1) for i in range(4)])
    with pytest.raises(RuntimeError, match="in flight"):
        workflow.workflow_pending(tx, max_rounds=2)
    monkeypatch.setattr(workflow, "COMPACT_ROUNDS", 2)
    done, balances, rounds = workflow.workflow_pending(tx)
    assert {r.txId: r.status for r in done.collect()} == {k: S.FULFILLED for k in ("d", "c0", "c1", "c2", "c3")}
    assert rounds > 4 and sum(r.balance for r in balances.collect()) == 0
