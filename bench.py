"""Benchmark: run the headline queries and print one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8).  Each query is executed in full with the ``noop`` sink (the
whole plan runs, nothing is collected to the driver).
"""
from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "g1_fact_orders", "a1_orders", "m1_v_orders", "a2_kpis", "a3_gmv_monthly",
    "a5_cohort_retention", "a7_rfm", "a17_category", "a21_biz_monthly_revenue",
    "a22_biz_sellers", "a31_revenue_by_purchase_type", "h6_scd2_from_log_reviews",
    "g4_dim_products", "x6_top_words", "x7_top_bigrams", "x12_terms_by_band",
    "c15_run_suite",
]


def main() -> None:
    from emporium.plans import catalog
    from emporium.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus),
                          app="emporium-bench")
    qs = catalog.all_queries()
    names = [n for n in HEADLINE if n in qs]
    # warm-up: JVM, parquet footers
    qs["a3_gmv_monthly"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
