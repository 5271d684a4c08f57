"""Time the headline queries end to end, from the given parquet tables to collected results.

Prints one JSON line. ``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores and
``BENCH_RUNS`` the timed runs per query, of which the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = (
    "agg_monthly_revenue", "agg_customer_ltv", "bv_customer_classification", "bv_order_lifecycle", "conformed_orders",
    "fct_order_items", "pit_customer", "pit_order", "load_satellite", "load_hub", "dp_customer_360", "dp_product_performance",
    "sv_revenue_analytics", "asof_join", "win_ntile", "change_feed", "cdc_apply", "dq_vault_ri", "product_search_topk",
)


def main() -> None:
    from loomvault.registry import QUERIES, base
    from loomvault.session import build_session

    spark = build_session(
        "bench", f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
           "spark.checkpoint.dir": tempfile.mkdtemp(prefix="loomvault-bench-")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    spark.read.parquet(f"{FOLDER}/orders.parquet").groupBy("o_orderstatus").count().collect()  # starts the executors
    seconds = {}
    for name in wanted:
        times = []
        for _ in range(RUNS):
            base.forget_warehouses()  # nothing computed by an earlier run is reused
            began = time.perf_counter()
            # writes every row and column to a sink that keeps nothing
            QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(times), 3)
        print(name, [round(t, 2) for t in times], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline queries, median seconds summed", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(CPUS), "runs": RUNS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
