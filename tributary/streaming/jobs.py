"""Streaming jobs: sources as streams, stateful operators, restartable sinks.

Offline the "topics" are folders of files read with the file stream source;
with a Kafka connector on the classpath the same jobs read
``format("kafka")`` (see ``sources.topics``).  Every query has a checkpoint
under the shared ``spark.checkpoint.dir``, so a restarted query resumes
exactly where it stopped, and sinks are idempotent per micro-batch:

* append results go to the file sink (exactly-once with the checkpoint);
* complete/update results go through ``foreachBatch`` and overwrite a table
  folder, keyed by batch, so a replayed batch writes the same thing.

``run_available`` drains what is available now (``availableNow``) and
returns the written table as a batch DataFrame.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary import schemas as S
from tributary.functions.ledger import acting_account, is_external
from tributary.operators.wordcount import tokenize
from tributary.session import scratch_path
from tributary.sources.ledger import ledger_from_events
from tributary.sources.tables import read_table, table_path
from tributary.streaming import processors as P
from tributary.streaming.published import PublishedTable


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """transformWithState keeps several state variables per key, which needs the
    RocksDB state store.  The provider is recorded per query in its checkpoint,
    so switching the session default does not affect existing queries."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, None) != ROCKSDB_PROVIDER:
        spark.conf.set(key, ROCKSDB_PROVIDER)
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def read_table_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """A driver table as a file stream (schema taken from the file, never inferred per batch)."""
    schema = read_table(spark, sf_dir, name).schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    path = table_path(sf_dir, name)
    if _is_folder(spark, path):
        return reader.parquet(path)
    # a file source watches folders: of this one only the table's file
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def _is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path of any file system that Spark reads is a folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory()


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table_stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


# For a query that gives out nothing when its watermark moves, an inner interval join: no scan of all state
# after the last rows (the next rows' batch drops old state), and no look-up before each write that only counts rows.
ROWS_ONLY = {"spark.sql.streaming.noDataMicroBatches.enabled": "false",
             "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings as ``conf`` inside, as before after it; a query keeps those of its start."""
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def run_available(df: DataFrame, output_mode: str = "append", name: str = "stream",
                  checkpoint: str | None = None, target: str | None = None,
                  conf: dict[str, str] | None = None) -> DataFrame:
    """Run a streaming DataFrame over all available input and return its result table; ``conf``: settings of this query."""
    with settings(df.sparkSession, conf or {}):
        return _run_available(df, output_mode, name, checkpoint, target)


def _run_available(df: DataFrame, output_mode: str, name: str, checkpoint: str | None, target: str | None) -> DataFrame:
    spark = df.sparkSession
    checkpoint = checkpoint or scratch_path(spark, f"{name}-ckpt")
    target = target or scratch_path(spark, f"{name}-out")
    if output_mode == "append":
        query = (df.writeStream.format("parquet").option("path", target)
                 .option("checkpointLocation", checkpoint).outputMode("append")
                 .trigger(availableNow=True).start())
    else:
        def write_batch(batch: DataFrame, batch_id: int) -> None:
            if output_mode == "complete":
                batch.write.mode("overwrite").parquet(target)
            else:
                batch.write.mode("append").parquet(f"{target}/batch={batch_id}")
        query = (df.writeStream.foreachBatch(write_batch)
                 .option("checkpointLocation", checkpoint).outputMode(output_mode)
                 .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return spark.read.parquet(target)


def run_merged(df: DataFrame, key: list[str], name: str = "stream", checkpoint: str | None = None,
               target: str | None = None, buckets: int = 32) -> DataFrame:
    """Run a keyed aggregation over all available input in update mode: every
    batch merges the keys that changed into a ``PublishedTable``, which readers
    can use meanwhile; returns the table."""
    table = PublishedTable(df.sparkSession, target or scratch_path(df.sparkSession, f"{name}-out"), key, df.schema, buckets)
    query = (df.writeStream.foreachBatch(lambda batch, batch_id: table.merge(batch, batch_id))
             .option("checkpointLocation", checkpoint or scratch_path(df.sparkSession, f"{name}-ckpt"))
             .outputMode("update").trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return table.read()


def word_count_stream(lines: DataFrame) -> DataFrame:
    """A2 as a stream: running counts per word; in update mode a batch gives the words it changed."""
    return tokenize(lines).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def account_balance_stream(events: DataFrame) -> DataFrame:
    """A3 as a stream: running balance per account from the legs of each transfer."""
    from tributary.operators.legs import account_balance_of
    return account_balance_of(ledger_from_events(events))


_TX_IN = ["account", "txId", "fromAccount", "toAccount", "amount", "instant", "status",
          "retriedTimes", "maxWaitTime", "seq", "phase"]


def _keyed(tx: DataFrame) -> DataFrame:
    return tx.select(acting_account(F.col("status"), F.col("fromAccount"), F.col("toAccount")).alias("account"),
                     *_TX_IN[1:])


BUCKETS = 1024


def _bucketed(rows: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """``rows`` with ``bucket``, a stateful operator's key that holds many of ``key``, and their ``slot`` of it."""
    number = F.pmod(F.xxhash64(key), F.lit(buckets * P.SLOTS))
    return (rows.withColumn("bucket", F.pmod(number, F.lit(buckets)).cast("int"))
            .withColumn("slot", F.floor(number / buckets).cast("int")))


def checked_debit_stream(tx: DataFrame, buckets: int | None = None) -> DataFrame:
    """T2 on a stream.  ``external`` rows are approved by predicate without
    state (they are the hot key); all other accounts go through
    ``CheckedDebitProcessor`` keyed by the acting account, or, where nobody
    reads the state, through ``BucketDebitProcessor`` keyed by ``buckets`` of
    them: a key costs some milliseconds, however few rows it has."""
    use_rocksdb(tx.sparkSession)
    keyed = _keyed(tx)
    ordinary = keyed.where(~is_external(F.col("account")))
    if buckets is None:
        folded = ordinary.groupBy("account").transformWithStateInPandas(P.CheckedDebitProcessor(), P.TX_OUT, "append", "None")
    else:
        folded = (_bucketed(ordinary, "account", buckets).groupBy("bucket")
                  .transformWithStateInPandas(P.BucketDebitProcessor(), P.TX_OUT, "append", "None"))
    return folded.unionByName(approved_external(keyed, pending_design=False))


def approved_external(keyed: DataFrame, pending_design: bool) -> DataFrame:
    """Rows of ``external`` accounts, approved by predicate and without state:
    they pay every deposit, so their key is a hot one, and their balance is
    never asked.  ``balance_after`` is null.  The pending-list design drops what
    is neither new nor a credit."""
    st = F.col("status")
    debit = st == S.CREATED if pending_design else st.isin(S.CREATED, S.RETRY_BALANCE_NOT_ENOUGH)
    credit = st == S.DEBIT_SUCCESS
    rows = keyed.where(is_external(F.col("account")))
    if pending_design:
        rows = rows.where(debit | credit)
    status = F.when(debit, F.lit(S.DEBIT_SUCCESS)).when(credit, F.lit(S.FULFILLED)).otherwise(st)
    return rows.select(*[status.alias("status") if c == "status" else F.col(c) for c in _TX_IN],
                       F.lit(None).cast("double").alias("balance_after"))


def self_connect_legs(tx: DataFrame) -> DataFrame:
    """J2's two keyings of a stream of transfers: a DEBIT_SUCCESS leg for the payer, a FULFILLED leg for the payee."""
    from tributary.operators.legs import split_legs
    return split_legs(tx, S.DEBIT_SUCCESS, S.FULFILLED)


def self_connect_stream(legs: DataFrame) -> DataFrame:
    """J2 for all accounts but ``external``: both keyings share one balance per account."""
    use_rocksdb(legs.sparkSession)
    return (legs.where(~is_external(F.col("account"))).groupBy("account")
            .transformWithStateInPandas(P.SelfConnectProcessor(), P.CONNECT_OUT, "append", "None"))


def external_legs_writer(spark: SparkSession, target: str):
    """J2 for ``external``, the hot key, batch by batch: a blocked running sum
    over the batch, which no single task orders, on top of the sums of the
    batches before (a row per batch and spelling of the name)."""
    from tributary.functions.ledger import cents, from_cents
    from tributary.operators.legs import running_balance
    sums = "batch long, account string, total long"

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.where(is_external(F.col("account"))).withColumn("_d", cents(F.col("amount")))
        ensure = spark._jvm.org.apache.hadoop.fs.Path(f"{target}-sums")
        ensure.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(ensure)
        before = (spark.read.schema(sums).parquet(f"{target}-sums/*").where(F.col("batch") < batch_id)
                  if batch_id else spark.createDataFrame([], sums))
        before = before.groupBy("account").agg(F.sum("total").alias("_before"))
        out = running_balance(rows, "account", "_d", "_run", as_cents=True).join(F.broadcast(before), "account", "left")
        (out.select("account", "txId", "status", "amount",
                    from_cents(F.col("_run") + F.coalesce("_before", F.lit(0))).alias("balance_after"))
         .write.mode("overwrite").parquet(f"{target}/batch={batch_id}"))
        (rows.groupBy("account").agg(F.sum("_d").alias("total"))
         .select(F.lit(batch_id).cast("long").alias("batch"), "account", "total")
         .write.mode("overwrite").parquet(f"{target}-sums/{batch_id}"))
    return write


def run_self_connect(tx: DataFrame, checkpoint: str | None = None, target: str | None = None) -> DataFrame:
    """J2 over all available input: a stateful query for ordinary accounts, one of blocked sums for ``external``."""
    spark = tx.sparkSession
    checkpoint, target = checkpoint or scratch_path(spark, "connect-ckpt"), target or scratch_path(spark, "connect-out")
    legs = self_connect_legs(tx)
    ordinary = run_available(self_connect_stream(legs), "append", "connect", f"{checkpoint}-ordinary", f"{target}-ordinary")
    query = (legs.writeStream.foreachBatch(external_legs_writer(spark, f"{target}-external"))
             .option("checkpointLocation", f"{checkpoint}-external").trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    external = spark.read.schema(P.CONNECT_OUT).parquet(f"{target}-external/*")
    return ordinary.unionByName(external)


def two_stage_stream(tx: DataFrame) -> DataFrame:
    """A5 as one query of two stateful operators: debit keyed by (a bucket of)
    the payer, then, keyed anew, credit by the payee.  Each stage has its own
    balances; a key's rows of one micro-batch are in one task, so the trigger
    bounds them."""
    use_rocksdb(tx.sparkSession)
    first, second = P.stage_schema("debit_balance_after"), P.stage_schema("debit_balance_after", "credit_balance_after")
    created = tx.where(F.col("status") == S.CREATED).select(*P.STAGE_IN)
    debited = _bucketed(created, "fromAccount").groupBy("bucket").transformWithStateInPandas(
        P.StageProcessor(-1, S.DEBIT_SUCCESS, "fromAccount", "debit_balance_after", first.fieldNames()),
        first, "append", "None")
    return (_bucketed(debited.where(F.col("status") == S.DEBIT_SUCCESS), "toAccount").groupBy("bucket")
            .transformWithStateInPandas(
                P.StageProcessor(1, S.FULFILLED, "toAccount", "credit_balance_after", second.fieldNames()),
                second, "append", "None"))


def map_enrich_stream(legs: DataFrame, state_events: DataFrame, ttl_ms: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """J3/T6 as one stateful query: ``state_events`` (txId, status and order)
    are kept in map state by buckets of transfers; ``legs`` meet it as they
    come.  With ``ttl_ms`` entries leave the map that long after they were put."""
    use_rocksdb(legs.sparkSession)
    none = lambda kind: F.lit(None).cast(kind)
    order = ["instant", "seq", "phase"]
    tagged = (state_events.select(F.lit("state").alias("tag"), "txId", none("string").alias("account"),
                                  none("double").alias("amount"), "status", *order)
              .unionByName(legs.select(F.lit("leg").alias("tag"), "txId", "account", "amount",
                                       none("string").alias("status"), *order)))
    keyed = _bucketed(tagged, "txId", buckets)
    return keyed.groupBy("bucket").transformWithStateInPandas(
        P.MapEnrichProcessor(ttl_ms), P.ENRICHED_OUT, "append", "None" if ttl_ms is None else "ProcessingTime")


def pending_debit_stream(tx: DataFrame, max_wait_ms: int = S.PENDING_MAX_WAIT_MS,
                         watermark: str = "0 seconds") -> DataFrame:
    """T3 on a stream in event time: timers fire as the watermark passes deadlines."""
    use_rocksdb(tx.sparkSession)
    keyed = _keyed(tx).withWatermark("instant", watermark)
    folded = (keyed.where(~is_external(F.col("account"))).groupBy("account")
              .transformWithStateInPandas(P.PendingDebitProcessor(max_wait_ms=max_wait_ms, event_time=True),
                                          P.TX_OUT, "append", "EventTime"))
    return folded.unionByName(approved_external(keyed, pending_design=True))


def wait_retry_stream(tx: DataFrame, watermark: str = "0 seconds") -> DataFrame:
    """T4 on a stream in event time, keyed by txId."""
    use_rocksdb(tx.sparkSession)
    return (tx.withWatermark("instant", watermark).groupBy("txId")
            .transformWithStateInPandas(P.WaitRetryProcessor(event_time=True), P.RETRY_OUT,
                                        "append", "EventTime"))


def delayed_echo_stream(words: DataFrame, ts_col: str = "ts", watermark: str = "0 seconds") -> DataFrame:
    """T5 on a stream in event time, keyed by the word."""
    use_rocksdb(words.sparkSession)
    return (words.withWatermark(ts_col, watermark).groupBy("word")
            .transformWithStateInPandas(P.DelayedEchoProcessor(event_time=True, ts_col=ts_col),
                                        P.ECHO_OUT, "append", "EventTime"))


def control_block_stream(tagged: DataFrame) -> DataFrame:
    """J1 on a stream: ``tagged`` has (key, tag 'control'|'data', value, seq)."""
    use_rocksdb(tagged.sparkSession)
    return (tagged.groupBy("key")
            .transformWithStateInPandas(P.ControlBlockProcessor(), P.BLOCK_OUT, "append", "None"))


def read_state(spark: SparkSession, checkpoint: str, state_var: str | None = None,
               operator_id: int | None = None) -> DataFrame:
    """Committed state of a stream's last batch (a snapshot, not a live value)."""
    reader = spark.read.format("statestore")
    if state_var:
        reader = reader.option("stateVarName", state_var)
    if operator_id is not None:
        reader = reader.option("operatorId", operator_id)
    return reader.load(checkpoint)


def windowed_counts_stream(events: DataFrame, size: str, keys: list[str], value_col: str,
                           watermark: str) -> DataFrame:
    """W1/W4 on a stream: tumbling windows with a watermark bounding the state."""
    from tributary.operators.windows import tumbling
    return tumbling(events.withWatermark("ts", watermark), "ts", size, keys, value_col)


def split_late(events: DataFrame, size: str, watermark: str, target: str, checkpoint: str) -> None:
    """Write all available rows of ``events``, by batch, to ``late=false`` or ``late=true`` below ``target``.

    A row is late if its window had ended at the watermark when its batch began:
    the largest event time of all batches before, less ``watermark``.  Batches
    are told from what is written of each (its largest event time), so one that
    runs again is split alike.
    """
    spark = events.sparkSession
    tops = "batch long, top timestamp"

    def route(batch: DataFrame, batch_id: int) -> None:
        mark = None
        if batch_id:
            before = spark.read.schema(tops).parquet(f"{target}-tops/*").where(F.col("batch") < batch_id)
            mark = before.agg((F.max("top") - F.expr(f"INTERVAL {watermark}")).alias("mark")).first().mark
        late = F.coalesce(F.window("ts", size)["end"] <= F.lit(mark), F.lit(False)) if mark else F.lit(False)
        out = f"{target}-rows/batch={batch_id}"
        batch.withColumn("late", late).write.mode("overwrite").partitionBy("late").parquet(out)
        rows = spark.read.schema(events.schema).parquet(out)
        (rows.agg(F.max("ts").alias("top")).select(F.lit(batch_id).cast("long").alias("batch"), "top")
         .write.mode("overwrite").parquet(f"{target}-tops/{batch_id}"))

    query = (events.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def run_final_windows(events: DataFrame, size: str, keys: list[str], value_col: str, watermark: str,
                      checkpoint: str | None = None, target: str | None = None,
                      max_files: int | None = None) -> tuple[DataFrame, DataFrame, list[dict]]:
    """(final windows, late rows, progress of the windows' query) over all available input.

    Late rows are parted first and have an output of their own (``split_late``);
    the windows read the rest in append mode, so each is given out once, when
    the watermark has passed its end, and its state is dropped then.
    """
    spark = events.sparkSession
    checkpoint, target = checkpoint or scratch_path(spark, "final-ckpt"), target or scratch_path(spark, "final-out")
    split_late(events, size, watermark, target, f"{checkpoint}-late")
    reader = spark.readStream.schema(events.schema)
    reader = reader.option("maxFilesPerTrigger", max_files) if max_files else reader
    final = windowed_counts_stream(reader.parquet(f"{target}-rows/*/late=false"), size, keys, value_col, watermark)
    query = (final.writeStream.format("parquet").option("path", f"{target}-windows").outputMode("append")
             .option("checkpointLocation", f"{checkpoint}-windows").trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    parted = T.StructType([*events.schema.fields, T.StructField("batch", T.LongType()), T.StructField("late", T.BooleanType())])
    late = spark.read.schema(parted).parquet(f"{target}-rows").where(F.col("late")).select(*events.columns)
    return spark.read.schema(final.schema).parquet(f"{target}-windows"), late, list(query.recentProgress)


def interval_join_stream(left: DataFrame, right: DataFrame, key_l: str, key_r: str,
                         ts_l: str, ts_r: str, within: str, watermark: str) -> DataFrame:
    """U2 on two streams: equi-join plus a time bound (right time in
    [left time, left time + within]); watermarks on both sides let the state
    of old rows be dropped."""
    lw = left.withWatermark(ts_l, watermark)
    rw = right.withWatermark(ts_r, watermark)
    cond = ((lw[key_l] == rw[key_r]) & (rw[ts_r] >= lw[ts_l])
            & (rw[ts_r] <= lw[ts_l] + F.expr(f"INTERVAL {within}")))
    return lw.join(rw, cond, "inner")


def latest_state_stream(state_events: DataFrame, key: str, value_cols: list[str],
                        order_cols: list[str]) -> DataFrame:
    """A6/T6 on a stream: latest value per key (an upsert map) as a streaming
    aggregation; run it in update or complete mode into a table."""
    from tributary.operators.joins import latest_per_key
    return latest_per_key(state_events, key, value_cols, order_cols)


def enrich_stream(rows: DataFrame, state_path: str, key: str, target: str, checkpoint: str,
                  trigger: dict | None = None):
    """J3 on a stream: each micro-batch of rows joins the current state table
    (re-read per batch, so state updates are seen) and is appended to
    ``target`` in a per-batch folder (idempotent on replay)."""
    spark = rows.sparkSession

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        state = spark.read.parquet(state_path)
        batch.join(state, on=key, how="left").write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return (rows.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
