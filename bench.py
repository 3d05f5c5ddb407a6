"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line with per-query wall seconds.

Each query is built (operators that pin an ordering checkpoint run that job
here) and fully executed into Spark's ``noop`` sink, which runs every stage
without pulling rows into Python: result transfer to the driver is harness
cost, not query cost.

Every query runs three times.  The first (cold) run pays one-off costs:
whole-stage code generation and JIT compilation of that query's operators,
which on a large job are a negligible share.  ``queries`` / ``value`` report
the faster of the two warm runs (this machine's timings swing by tens of
percent run to run); ``cold_queries`` / ``cold_total`` keep the first run.
"""

from __future__ import annotations

import json
import os
import random
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlens.plans.registry import QUERIES  # noqa: E402
from ledgerlens.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [a for a in sys.argv[1:]]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus),
                          app_name="ledgerlens-bench")
    # warm-up: JVM class loading, Parquet footers, code generation of every kind of operator
    for warm in ("q01_1_revenue_by_period", "q07_8_pareto_customers", "q01_7_top_quintile_revenue_share",
                 "q05_1_gross_profit_by_product_category_year", "q03_2_products_bought_together", "q07_5_rfm"):
        QUERIES[warm](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    cold: dict[str, float] = {}
    order = list(QUERIES.items())
    random.Random(int(os.environ.get("BENCH_SEED", "0"))).shuffle(order)    # no query always pays for being first
    for name, query in order:
        if only and not any(o in name for o in only):
            continue
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(round(time.perf_counter() - start, 3))
        cold[name], timings[name] = runs[0], min(runs[1:])
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_wall_time", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": dict(sorted(timings.items())), "sf": sf, "sink": "noop",
                      "cpus": cpus, "n_queries": len(timings), "spark": spark.version,
                      "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
                      "runs_per_query": 3,
                      "cold_total": round(sum(cold.values()), 3), "cold_queries": cold}))
    spark.stop()


if __name__ == "__main__":
    main()
