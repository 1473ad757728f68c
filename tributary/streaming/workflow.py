"""The two feedback workflows as streaming jobs over topics.

Two queries exchange messages through topics, like the live system:

* balance job: raw topic -> checked debit (T2) or pending-list debit (T3),
  keyed by acting account, balances (and pending lists) in the state store
  -> retry topic;
* after-debit job: retry topic -> routes.  v1: DEBIT_SUCCESS back to raw,
  FULFILLED to completed, RETRY to the wait stage (retry with counter+1, or
  cancel after 5 retries); v2: DEBIT_SUCCESS to raw, all else completed.

Topics are Kafka topics (``kafka_servers``) or folders (``sources.topics``);
each job writes all its routes with a computed topic column.  Both sinks are
at least once: a replayed batch can publish its messages again (a folder's
batch is rewritten under new file names, which the other job's file source
takes for new).  So both jobs drop messages whose (txId, status, retriedTimes,
phase) they have read within the last ``REPLAY_BOUND``, and a replay within that
time moves no money twice.  What was read is kept in the job's state that long
and no longer: the mark that drops it follows the time at which batches begin,
not the transfers' instants, so no message ever counts as late, however old.

``run_until_quiet`` drives the loop offline: alternate ``availableNow`` runs
of the two jobs until the balance job reads nothing new.  With
``credits_first`` each balance run applies one round's credits before its
debits, so the loop computes the same result as the bounded rounds of
``operators.workflow``.  The live wait stage waits with processing-time
timers (``WaitRetryProcessor``); the offline loop re-emits at once and
records the due time, since replay has no wall clock to wait for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary import schemas as S
from tributary.functions.codec import decode_frame, to_messages
from tributary.functions.ledger import is_external, retry_delay_ms
from tributary.session import scratch_path
from tributary.sources.topics import MESSAGE, ensure_folder, read_messages, topic_path
from tributary.streaming import jobs

# BANK_TX plus the ordering columns, as carried inside the messages.
ORDERED_TX = T.StructType(S.BANK_TX.fields + [T.StructField("seq", T.LongType()),
                                               T.StructField("phase", T.IntegerType())])
_FIELDS = ORDERED_TX.fieldNames()


# What a message is known by, and how long: longer than any replay may take.
_MESSAGE_ID = ["txId", "status", "retriedTimes", "phase"]
REPLAY_BOUND = "7 days"


def once(messages: DataFrame, bound: str = REPLAY_BOUND) -> DataFrame:
    """A stream without the messages that were read before, as far back as ``bound``; its state is dropped behind it."""
    read_at = "_read_at"
    return (messages.withColumn(read_at, F.current_timestamp()).withWatermark(read_at, bound)
            .dropDuplicatesWithinWatermark(_MESSAGE_ID).drop(read_at))


def _read(spark: SparkSession, base: str, topic: str, kafka_servers: str | None = None) -> DataFrame:
    """Transfers of a topic, each message once."""
    if kafka_servers:
        msgs = read_messages(spark, topic, kafka_servers=kafka_servers)
    else:
        path = topic_path(base, topic)
        ensure_folder(spark, path)
        msgs = spark.readStream.schema(MESSAGE).json(f"{path}/*")
    return once(decode_frame(msgs, "value", schema=ORDERED_TX).select(*_FIELDS))


def _start(msgs: DataFrame, base: str, name: str, checkpoint: str, trigger: dict, kafka_servers: str | None):
    """Start writing a stream of (topic, key, value) to Kafka or to topic folders."""
    if kafka_servers:
        writer = (msgs.selectExpr("topic", "CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
                  .writeStream.format("kafka").option("kafka.bootstrap.servers", kafka_servers))
    else:
        writer = msgs.writeStream.foreachBatch(_writer(base, name))
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _writer(base: str, name: str):
    """One write for all topics of a batch; a batch that runs again first takes away what it had published."""
    def write(batch: DataFrame, batch_id: int) -> None:
        path = batch.sparkSession._jvm.org.apache.hadoop.fs.Path
        fs = path(base).getFileSystem(batch.sparkSession._jsc.hadoopConfiguration())
        at = f"from={name}-{batch_id}"
        for f in fs.globStatus(path(f"{base}/topic=*/{at}")) or []:
            fs.delete(f.getPath(), True)
        (batch.select("topic", F.lit(f"{name}-{batch_id}").alias("from"), "key", "value")
         .write.mode("append").partitionBy("topic", "from").json(base))
    return write


def seed(tx: DataFrame, base: str) -> None:
    """Publish new transfers on the raw topic."""
    msgs = to_messages(tx, fields=_FIELDS)
    msgs.select("key", "value").write.mode("overwrite").json(f"{topic_path(base, S.TOPIC_RAW)}/seed")


def balance_job(spark: SparkSession, base: str, pending_design: bool, checkpoint: str,
                live_max_wait_ms: int | None = None, trigger: dict | None = None,
                kafka_servers: str | None = None):
    """The balance stage.  With ``live_max_wait_ms`` (v2) pending debits get a
    processing-time deadline and are cancelled when it passes (the live
    design; run with a processing-time ``trigger``)."""
    jobs.use_rocksdb(spark)
    raw = _read(spark, base, S.TOPIC_RAW, kafka_servers)
    keyed = jobs._keyed(raw)
    ordinary = keyed.where(~is_external(F.col("account"))).groupBy("account")
    live = pending_design and live_max_wait_ms is not None
    if pending_design:
        processor = jobs.P.PendingDebitProcessor(max_wait_ms=live_max_wait_ms, event_time=False, credits_first=not live)
    else:
        processor = jobs.P.CheckedDebitProcessor(credits_first=True)
    out = ordinary.transformWithStateInPandas(processor, jobs.P.TX_OUT, "append", "ProcessingTime" if live else "None")
    out = out.unionByName(jobs.approved_external(keyed, pending_design))
    msgs = to_messages(out, fields=_FIELDS).withColumn("topic", F.lit(S.TOPIC_RETRY))
    return _start(msgs, base, "balance", checkpoint, trigger or {"availableNow": True}, kafka_servers)


def after_debit_job(spark: SparkSession, base: str, pending_design: bool, checkpoint: str,
                    live_wait: bool = False, trigger: dict | None = None, kafka_servers: str | None = None):
    """The after-debit split.  ``live_wait`` (v1) routes RETRY transfers through
    the wait stage with processing-time backoff timers (the live design; run it
    with a processing-time ``trigger``); otherwise they are re-emitted at once
    with their due time recorded (offline replay)."""
    tx = _read(spark, base, S.TOPIC_RETRY, kafka_servers)
    st = F.col("status")
    n = F.col("retriedTimes")
    if live_wait and not pending_design:
        from tributary.streaming.processors import RECORD_OUT, WaitRetryRecordProcessor
        jobs.use_rocksdb(spark)
        passing = (tx.where(st.isin(S.DEBIT_SUCCESS, S.FULFILLED))
                   .withColumn("topic", F.when(st == S.DEBIT_SUCCESS, F.lit(S.TOPIC_RAW))
                               .otherwise(F.lit(S.TOPIC_COMPLETED)))
                   .withColumn("phase", F.when(st == S.DEBIT_SUCCESS, F.col("phase") + 1)
                               .otherwise(F.col("phase"))))
        waited = (tx.where(st == S.RETRY_BALANCE_NOT_ENOUGH).groupBy("txId")
                  .transformWithStateInPandas(WaitRetryRecordProcessor(event_time=False), RECORD_OUT,
                                              "append", "ProcessingTime"))
        msgs = to_messages(passing.unionByName(waited), fields=_FIELDS, keep=("topic",))
        return _start(msgs, base, "after", checkpoint, trigger or {"processingTime": "1 second"}, kafka_servers)
    if pending_design:
        topic = F.when(st == S.DEBIT_SUCCESS, F.lit(S.TOPIC_RAW)).otherwise(F.lit(S.TOPIC_COMPLETED))
        routed = tx.withColumn("topic", topic)
    else:
        retry = (st == S.RETRY_BALANCE_NOT_ENOUGH) & (n < S.MAX_RETRIES)
        cancel = (st == S.RETRY_BALANCE_NOT_ENOUGH) & (n >= S.MAX_RETRIES)
        # every new column from the incoming values, in one projection
        routed = (tx.where(st.isin(S.DEBIT_SUCCESS, S.FULFILLED, S.RETRY_BALANCE_NOT_ENOUGH))
                  .select(
                      *[c for c in _FIELDS if c not in ("status", "retriedTimes", "maxWaitTime")],
                      F.when(st == S.FULFILLED, F.lit(S.TOPIC_COMPLETED))
                       .when(cancel, F.lit(S.TOPIC_COMPLETED)).otherwise(F.lit(S.TOPIC_RAW)).alias("topic"),
                      F.when(retry, F.unix_millis("instant") + retry_delay_ms(n))
                       .otherwise(F.col("maxWaitTime")).alias("maxWaitTime"),
                      F.when(retry, n + 1).otherwise(n).alias("retriedTimes"),
                      F.when(cancel, F.lit(S.CANCELLED_BALANCE_NOT_ENOUGH)).otherwise(st).alias("status")))
    routed = routed.withColumn("phase", F.when(F.col("status") == S.DEBIT_SUCCESS, F.col("phase") + 1)
                               .otherwise(F.col("phase")))
    msgs = to_messages(routed, fields=_FIELDS, keep=("topic",))
    return _start(msgs, base, "after", checkpoint, {"availableNow": True}, kafka_servers)


def run_until_quiet(tx: DataFrame, pending_design: bool, base: str | None = None,
                    max_loops: int | None = None) -> tuple[DataFrame, int]:
    """Seed ``tx`` and alternate the two jobs until no new raw message arrives.

    ``max_loops`` is a limit of the caller's own; reaching it raises.

    Returns the completed topic (decoded) and the number of loops.
    """
    spark = tx.sparkSession
    base = base or scratch_path(spark, "topics")
    ck_balance = scratch_path(spark, "balance-job")
    ck_after = scratch_path(spark, "after-debit-job")
    seed(tx, base)
    loops = 0
    while True:
        if max_loops is not None and loops >= max_loops:
            raise RuntimeError(f"messages still in flight after {max_loops} loops")
        q = balance_job(spark, base, pending_design, ck_balance)
        q.awaitTermination()
        read = sum(p["numInputRows"] for p in q.recentProgress)
        if read == 0:
            break
        loops += 1
        q = after_debit_job(spark, base, pending_design, ck_after)
        q.awaitTermination()
    completed = decode_frame(spark.read.schema(MESSAGE).json(f"{topic_path(base, S.TOPIC_COMPLETED)}/*"),
                             "value", schema=ORDERED_TX)
    return completed.select(*_FIELDS), loops
