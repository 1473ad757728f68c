"""Registered window, union, join and coGroup queries (operators the modelled
system describes in prose only; built here as user-level operators)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tributary.operators import joins, windows
from tributary.operators.cogroup import cogroup
from tributary.plans.registry import register
from tributary.sources.tables import read_events, read_table

_AGG_SQL = "count(*) AS n, round(sum(value), 2) AS total"


@register("tumbling_window", f"""
SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start,
       time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
       event_type, {_AGG_SQL}
FROM events GROUP BY 1, 2, 3
""", ("events",))
def q_tumbling_window(spark, sf_dir):
    """Daily tumbling windows per event type."""
    return windows.tumbling(read_events(spark, sf_dir), "ts", "1 day", ["event_type"], "value")


@register("sliding_window", f"""
WITH w AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, event_type, value FROM events
  UNION ALL
  SELECT time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE, event_type, value FROM events)
SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, event_type, {_AGG_SQL}
FROM w GROUP BY 1, 2, 3
""", ("events",))
def q_sliding_window(spark, sf_dir):
    """Sliding windows of 10 minutes every 5 minutes per event type."""
    return windows.sliding(read_events(spark, sf_dir), "ts", "10 minutes", "5 minutes",
                           ["event_type"], "value")


@register("session_window", f"""
WITH g AS (
  SELECT user_id, ts, value,
         CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 1 HOUR
              THEN 1 ELSE 0 END AS new_session
  FROM events),
s AS (SELECT *, sum(new_session) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 1 HOUR AS session_end, {_AGG_SQL}
FROM s GROUP BY user_id, sid
""", ("events",))
def q_session_window(spark, sf_dir):
    """Per-user sessions that close after one hour without events."""
    return windows.session(read_events(spark, sf_dir), "ts", "1 hour", ["user_id"], "value")


@register("window_all", f"""
SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start,
       time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end, {_AGG_SQL}
FROM events GROUP BY 1, 2
""", ("events",))
def q_window_all(spark, sf_dir):
    """Non-keyed daily windows over all events."""
    return windows.window_all(read_events(spark, sf_dir), "ts", "1 day", "value")


@register("union_streams", """
SELECT 'orders' AS src, o_orderkey AS orderkey, o_orderdate AS ts, o_totalprice AS amount FROM orders
UNION ALL
SELECT 'lineitem', l_orderkey, l_shipdate, l_extendedprice FROM lineitem
""", ("orders", "lineitem"))
def q_union_streams(spark, sf_dir):
    """Union of two inputs with one schema (bag semantics, UNION ALL)."""
    o = read_table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("src"), F.col("o_orderkey").alias("orderkey"),
        F.col("o_orderdate").alias("ts"), F.col("o_totalprice").alias("amount"))
    li = read_table(spark, sf_dir, "lineitem").select(
        F.lit("lineitem").alias("src"), F.col("l_orderkey").alias("orderkey"),
        F.col("l_shipdate").alias("ts"), F.col("l_extendedprice").alias("amount"))
    return o.unionByName(li)


@register("join_streams", """
SELECT l.l_orderkey, l.l_linenumber, o.o_custkey, o.o_orderdate, l.l_shipdate, l.l_extendedprice
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""", ("orders", "lineitem"))
def q_join_streams(spark, sf_dir):
    """Keyed inner join of two inputs (both large: shuffle join on the key)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")
    o = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    return li.join(o, on="l_orderkey", how="inner").select(
        "l_orderkey", "l_linenumber", "o_custkey", "o_orderdate", "l_shipdate", "l_extendedprice")


@register("cogroup_counts", """
WITH a AS (SELECT o_orderkey AS orderkey, count(*) AS n_orders FROM orders GROUP BY 1),
b AS (SELECT l_orderkey AS orderkey, count(*) AS n_lines FROM lineitem GROUP BY 1)
SELECT coalesce(a.orderkey, b.orderkey) AS orderkey,
       coalesce(a.n_orders, 0) AS n_orders, coalesce(b.n_lines, 0) AS n_lines
FROM a FULL OUTER JOIN b ON a.orderkey = b.orderkey
""", ("orders", "lineitem"))
def q_cogroup_counts(spark, sf_dir):
    """coGroup of orders and lineitems by order key, as per-key sizes."""
    o = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"))
    li = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderkey"))
    return joins.cogroup_counts(o, li, "orderkey", "n_orders", "n_lines")


# Orders and lines of every third order key meet under one key: a third of all rows.
_HOT_KEY = "CASE WHEN {0} % 3 = 0 THEN 0 ELSE {0} END"


def _lines_above(orders: pa.Table, lines: pa.Table) -> pa.Table:
    """A user's function: for each order, how many lines of its group cost more than a tenth of it (``beyond``: those
    of later ranges, which all do)."""
    price = np.sort(lines.column("l_extendedprice").to_numpy())
    tenth = orders.column("o_totalprice").to_numpy() / 10
    above = len(price) - np.searchsorted(price, tenth, side="right") + orders.column("beyond").to_numpy()
    return orders.select(["o_orderkey"]).append_column("n_above", pa.array(above.astype(np.int64)))


@register("cogroup_user", f"""
WITH o AS (SELECT {_HOT_KEY.format("o_orderkey")} AS k, o_orderkey, o_totalprice FROM orders),
l AS (SELECT {_HOT_KEY.format("l_orderkey")} AS k, l_extendedprice FROM lineitem)
SELECT o_orderkey, CAST(count(*) FILTER (l_extendedprice > o_totalprice / 10) AS BIGINT) AS n_above
FROM o LEFT JOIN l ON o.k = l.k GROUP BY o_orderkey
""", ("orders", "lineitem"))
def q_cogroup_user(spark, sf_dir):
    """U3 with a user's function over orders and lines of a key, one of which holds a third of all rows."""
    o = read_table(spark, sf_dir, "orders").select(
        F.expr(_HOT_KEY.format("o_orderkey")).alias("k"), "o_orderkey", "o_totalprice")
    li = read_table(spark, sf_dir, "lineitem").select(F.expr(_HOT_KEY.format("l_orderkey")).alias("k"), "l_extendedprice")
    return cogroup(o, li, "k", _lines_above, "o_orderkey long, n_above long",
                   merge=lambda out: out.groupBy("o_orderkey").agg(F.sum("n_above").alias("n_above")), block_rows=10_000,
                   order=("o_totalprice / 10", "l_extendedprice"), beyond={"beyond": "1"})


@register("delayed_echo", """
SELECT event_id, event_type AS word, ts + INTERVAL 2 SECOND AS echo_at FROM events
""", ("events",))
def q_delayed_echo(spark, sf_dir):
    """T5 (event time, bounded): each word (event type) echoed 2 s after it
    arrived; the streaming form uses a timer per key (streaming.processors)."""
    ev = read_events(spark, sf_dir)
    return ev.select("event_id", F.col("event_type").alias("word"),
                     (F.col("ts") + F.expr("INTERVAL 2 SECONDS")).alias("echo_at"))
