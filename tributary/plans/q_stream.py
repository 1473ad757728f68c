"""Registered streaming queries: run as Structured Streaming over the table
files (``availableNow``), checkpointed in the shared folder, and returned as
their written result table."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.operators import joins
from tributary.operators.debit import first_round_feed
from tributary.operators.legs import split_legs
from tributary.plans import sql as Q
from tributary.plans.q_state import LOOKUP_ACCOUNTS
from tributary.plans.q_text import LOOKUP_WORDS
from tributary.plans.registry import REGISTRY, register
from tributary.session import scratch_path
from tributary.sources.ledger import ledger_from_events
from tributary.streaming import jobs
from tributary.streaming.published import PublishedTable, publish_state


@register("word_count_stream", REGISTRY["word_count"].sql, ("documents",))
def q_word_count_stream(spark, sf_dir):
    """A2 as a stream: running word counts over the documents files; changed words are merged into a published table."""
    lines = jobs.read_table_stream(spark, sf_dir, "documents").select("text")
    return jobs.run_merged(jobs.word_count_stream(lines), ["word"], "word-count")


@register("account_balance_stream", REGISTRY["account_balance"].sql, ("events",))
def q_account_balance_stream(spark, sf_dir):
    """A3 as a stream: running balance per account; changed accounts are merged into a published table."""
    ev = jobs.events_stream(spark, sf_dir)
    return jobs.run_merged(jobs.account_balance_stream(ev), ["account"], "balance")


@register("debit_check_stream", "WITH RECURSIVE " + Q.checked_debit_sql(Q.FIRST_ROUND)
          + " SELECT txId, phase, account, status, amount FROM checked", ("events",))
def q_debit_check_stream(spark, sf_dir):
    """T2 as a stream: ``transformWithState`` keyed by acting account (value
    state ``balance``); the external account is approved without state."""
    tx = first_round_feed(ledger_from_events(jobs.events_stream(spark, sf_dir)))
    out = jobs.run_available(jobs.checked_debit_stream(tx), "append", "debit")
    return out.select("txId", "phase", "account", "status", "amount")


@register("balance_state_lookup", REGISTRY["balance_lookup"].sql, ("events",))
def q_balance_state_lookup(spark, sf_dir):
    """Q2/Q3/Q5: run the balance stream, then look accounts up in its
    checkpointed state (state reader), unknown account -> null."""
    ckpt = scratch_path(spark, "balance-state")
    jobs.run_available(jobs.account_balance_stream(jobs.events_stream(spark, sf_dir)),
                       "complete", "balance-state", checkpoint=ckpt)
    state = jobs.read_state(spark, ckpt).select(
        F.col("key.account").alias("account"),
        (F.col("value.sum").cast("double") / 100.0).alias("balance"))
    keys = spark.createDataFrame([(a,) for a in LOOKUP_ACCOUNTS], "account string")
    return joins.lookup(keys, state, "account").select("account", "balance")


@register("word_state_lookup", REGISTRY["word_lookup"].sql, ("documents",))
def q_word_state_lookup(spark, sf_dir):
    """Q1: count of requested words read from the word-count stream's state."""
    ckpt = scratch_path(spark, "word-state")
    lines = jobs.read_table_stream(spark, sf_dir, "documents").select("text")
    jobs.run_available(jobs.word_count_stream(lines), "complete", "word-state", checkpoint=ckpt)
    state = jobs.read_state(spark, ckpt).select(F.col("key.word").alias("word"),
                                                F.col("value.count").alias("cnt"))
    keys = spark.createDataFrame([(w,) for w in LOOKUP_WORDS], "word string")
    return joins.lookup(keys, state, "word").select("word", "cnt")


@register("tumbling_window_stream", REGISTRY["tumbling_window"].sql, ("events",))
def q_tumbling_window_stream(spark, sf_dir):
    """W1 + W4 as a stream: daily windows per event type with a one-hour
    watermark (complete mode keeps every window for comparison)."""
    ev = jobs.events_stream(spark, sf_dir)
    return jobs.run_available(jobs.windowed_counts_stream(ev, "1 day", ["event_type"], "value", "1 hour"),
                              "complete", "windows")


_WITHIN_DAYS = 90


@register("interval_join_stream", f"""
SELECT o.o_orderkey AS orderkey, l.l_linenumber, o.o_custkey, o.o_orderdate, l.l_shipdate, l.l_extendedprice
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
 AND l.l_shipdate >= o.o_orderdate AND l.l_shipdate <= o.o_orderdate + INTERVAL {_WITHIN_DAYS} DAY
""", ("orders", "lineitem"))
def q_interval_join_stream(spark, sf_dir):
    """U2 as a stream-stream join: each order with its lineitems shipped within
    90 days of the order date, watermarks on both sides."""
    o = (jobs.read_table_stream(spark, sf_dir, "orders")
         .select(F.col("o_orderkey").alias("orderkey"), "o_custkey",
                 F.col("o_orderdate").cast("timestamp").alias("o_orderdate")))
    li = (jobs.read_table_stream(spark, sf_dir, "lineitem")
          .select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("timestamp").alias("l_shipdate"),
                  "l_extendedprice"))
    joined = jobs.interval_join_stream(o, li, "orderkey", "l_orderkey", "o_orderdate", "l_shipdate",
                                       f"{_WITHIN_DAYS} DAYS", "3650 days")
    out = jobs.run_available(joined.select("orderkey", "l_linenumber", "o_custkey", "o_orderdate",
                                           "l_shipdate", "l_extendedprice"), "append", "interval-join", conf=jobs.ROWS_ONLY)
    return out


@register("self_connect_stream", REGISTRY["self_connect_balance"].sql, ("events",))
def q_self_connect_stream(spark, sf_dir):
    """J2 as connected streams: legs of both keyings share one balance per account; ``external`` on its own path."""
    return jobs.run_self_connect(ledger_from_events(jobs.events_stream(spark, sf_dir)))


@register("two_stage_transfer_stream", REGISTRY["two_stage_transfer"].sql, ("events",))
def q_two_stage_transfer_stream(spark, sf_dir):
    """A5 as one stream of two stateful operators, keyed anew in between."""
    tx = ledger_from_events(jobs.events_stream(spark, sf_dir)).withColumn("phase", F.lit(0))
    out = jobs.run_available(jobs.two_stage_stream(tx), "append", "two-stage")
    return out.select("txId", "fromAccount", "toAccount", "amount", "status",
                      "debit_balance_after", "credit_balance_after")


@register("broadcast_enrich_stream", REGISTRY["broadcast_enrich"].sql, ("events",))
def q_broadcast_enrich_stream(spark, sf_dir):
    """J3/T6 as a stream: the checked debit's states are kept in map state, the legs meet it as they come."""
    tx = ledger_from_events(jobs.events_stream(spark, sf_dir))
    states = jobs.checked_debit_stream(first_round_feed(tx), jobs.BUCKETS).select("txId", "status", "instant", "seq", "phase")
    legs = split_legs(tx).select("txId", "account", "amount", "instant", "seq", "phase")
    return jobs.run_available(jobs.map_enrich_stream(legs, states), "append", "map-enrich")


@register("final_windows_stream", f"""
WITH w AS ({REGISTRY["tumbling_window"].sql}), mark AS (SELECT max(ts) - INTERVAL 1 HOUR AS m FROM events)
SELECT w.* FROM w, mark WHERE w.window_end <= mark.m
""", ("events",))
def q_final_windows_stream(spark, sf_dir):
    """The daily windows that a watermark of one hour has closed, given out once (append mode)."""
    ev = jobs.events_stream(spark, sf_dir)
    return jobs.run_final_windows(ev, "1 day", ["event_type"], "value", "1 hour")[0]


@register("balance_feed_lookup", REGISTRY["balance_lookup"].sql, ("events",))
def q_balance_feed_lookup(spark, sf_dir):
    """Q5: what changed in a balance stream's state is merged into a published table; a lookup reads its keys' buckets."""
    ckpt = scratch_path(spark, "balance-feed")
    jobs.run_available(jobs.account_balance_stream(jobs.events_stream(spark, sf_dir)), "update", "balance-feed",
                       checkpoint=ckpt)
    schema = T.StructType([T.StructField("account", T.StringType()), T.StructField("balance", T.DoubleType())])
    table = PublishedTable(spark, scratch_path(spark, "balance-published"), ["account"], schema)
    publish_state(table, ckpt, {"account": F.col("key.account"), "balance": F.col("value.sum").cast("double") / 100.0})
    return table.lookup(spark.createDataFrame([(a,) for a in LOOKUP_ACCOUNTS], "account string"))
