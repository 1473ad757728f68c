"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 8).  Every query is executed in full with the
``noop`` sink (no rows go to the driver), once cold and once warm; the warm
time is reported.  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import platform
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tributary.plans.registry import load_all  # noqa: E402
from tributary.session import build_session  # noqa: E402

HEADLINE = [
    "word_count", "word_count_running", "account_balance", "self_connect_balance",
    "debit_check", "debit_pending", "latest_tx_state", "broadcast_enrich",
    "session_window", "sliding_window", "join_streams", "cogroup_counts",
    "control_block", "debit_check_stream", "workflow_retry", "workflow_pending",
    "cogroup_user", "self_connect_stream", "two_stage_transfer_stream", "broadcast_enrich_stream",
]


def run(spark, query, sf_dir) -> float:
    t0 = time.perf_counter()
    query.build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    reg = load_all()
    warm, cold, failed = {}, {}, {}
    for name in names:
        try:
            cold[name] = round(run(spark, reg[name], sf_dir), 3)
            warm[name] = round(run(spark, reg[name], sf_dir), 3)
        except Exception as exc:  # noqa: BLE001 - report, keep benchmarking the rest
            failed[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_warm_query_seconds",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "failed": failed,
        "sf": sf,
        "cpus": cpus,
        "machine": platform.machine(),
        "spark_conf": {"master": f"local[{cpus}]", "spark.sql.shuffle.partitions": cpus,
                       "spark.sql.adaptive.enabled": True},
    }))


if __name__ == "__main__":
    main()
