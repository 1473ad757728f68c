"""Skew-safe operators against their direct (single-level) forms."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SF_MID, SF_SMALL
from tributary.operators import windows
from tributary.operators.running import blocked_running_sum
from tributary.sources.tables import read_events


def _sessions_direct(ev):
    return (ev.groupBy(F.session_window("ts", "1 hour").alias("w"), "user_id")
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))
            .select("user_id", F.col("w.start").alias("session_start"),
                    F.col("w.end").alias("session_end"), "n", "total"))


def test_two_level_sessions_equal_direct_on_scattered_input(spark):
    ev = read_events(spark, SF_MID)
    scattered = ev.repartition(16)        # every user's events spread over all splits
    got = sorted(map(tuple, windows.session(scattered, "ts", "1 hour", ["user_id"], "value").collect()))
    want = sorted(map(tuple, _sessions_direct(ev).collect()))
    assert got == want


def test_blocked_running_sum_equals_window(spark):
    ev = read_events(spark, SF_SMALL).repartition(7)
    for block in (F.lit(0), F.col("event_id") / 10, F.col("event_id") / 97):
        blocked = ev.withColumn("_b", F.floor(block).cast("long"))
        got = blocked_running_sum(blocked, ["user_id"], ["ts", "event_id"], "_b", "event_id", "run")
        w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
        want = ev.withColumn("run", F.sum("event_id").over(w))
        assert (sorted((r.event_id, r.run) for r in got.collect())
                == sorted((r.event_id, r.run) for r in want.collect()))


def test_range_blocked_running_sum_equals_window(spark):
    from tributary.operators.running import ordered_running_sum
    ev = read_events(spark, SF_SMALL)
    for blocks in (1, 3, 16):
        got = ordered_running_sum(ev, ["user_id"], ["ts", "event_id"], "event_id", "run",
                                  order_value=F.unix_micros("ts"), num_blocks=blocks)
        w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
        want = ev.withColumn("run", F.sum("event_id").over(w))
        assert (sorted((r.event_id, r.run) for r in got.collect())
                == sorted((r.event_id, r.run) for r in want.collect()))


def test_quantile_blocks_bound_a_hot_key(spark):
    """One key holds ~70% of all rows: no (key, block) group exceeds ~2N/P rows,
    and the blocked running sum still equals the plain window."""
    from tributary.operators.running import ordered_running_sum, quantile_blocks
    ev = read_events(spark, SF_MID).withColumn(
        "user_id", F.when(F.col("event_id") % 10 < 7, F.lit(0)).otherwise(F.col("user_id")))
    n, p = ev.count(), 16
    blocked = quantile_blocks(ev, F.unix_micros("ts"), p)
    biggest = blocked.groupBy("user_id", "_qblk").count().agg(F.max("count")).first()[0]
    hot = ev.where("user_id = 0").count()
    assert hot > 0.6 * n
    assert biggest <= 2 * n / p
    got = ordered_running_sum(ev, ["user_id"], ["ts", "event_id"], "event_id", "run",
                              order_value=F.unix_micros("ts"), num_blocks=p)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    want = ev.withColumn("run", F.sum("event_id").over(w))
    assert (sorted((r.event_id, r.run) for r in got.collect())
            == sorted((r.event_id, r.run) for r in want.collect()))


def test_one_instant_is_cut_by_the_second_order_column(spark):
    """A bulk load: most rows of one key have one instant."""
    from pyspark.sql import Window
    from tributary.operators.running import ordered_running_sum, quantile_blocks
    rows = spark.range(4000).select(
        F.when(F.col("id") % 10 == 0, F.lit("b")).otherwise(F.lit("a")).alias("k"),
        F.when(F.col("id") < 3000, F.lit(50)).otherwise(F.col("id") % 100).cast("long").alias("t"),
        (F.col("id") * 7919 % 4001).alias("seq"), (F.col("id") % 13).alias("v"))
    blocked = quantile_blocks(rows, F.col("t"), 16, tie_value=F.col("seq"))
    sizes = [r["count"] for r in blocked.groupBy("_qblk").count().collect()]
    assert max(sizes) < 4000 / 16 * 2.5
    order = Window.orderBy("t", "seq")
    assert blocked.withColumn("before", F.lag("_qblk").over(order)).where("before > _qblk").count() == 0
    got = ordered_running_sum(rows, ["k"], ["t", "seq"], "v", "s", num_blocks=16)
    want = rows.withColumn("s", F.sum("v").over(Window.partitionBy("k").orderBy("t", "seq").rowsBetween(
        Window.unboundedPreceding, 0)))
    assert sorted(map(tuple, got.select("k", "t", "seq", "s").collect())) == sorted(
        map(tuple, want.select("k", "t", "seq", "s").collect()))
