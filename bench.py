"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is built with the registered query function and fully executed
with a ``noop`` write (no collect); ``daily_run`` is the whole delivery job
(insert, mark, export, finish) against a fresh scratch ledger.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = ["q_eligible_orders", "q_session_touches", "q_enhanced_touches", "q_order_touches",
            "q_touch_count", "q_linear_attribution", "q_channel_credit", "q_conversions_all_buyers",
            "q_conversions_new_buyers", "q_delivery_file"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from pyspark.sql import SparkSession

    from creditflow.plans import queries as Q
    from creditflow.plans.daily import run_delivery
    from creditflow.session import apply_job_conf, checkpoint_dir
    from creditflow.sources import standin
    from creditflow.sources.ledger import Ledger

    scratch = tempfile.mkdtemp(prefix="cf-bench-")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("creditflow-bench")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", str(cpus))
             .config("spark.driver.memory", "16g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    apply_job_conf(spark)
    checkpoint_dir(spark)

    # Warm the JVM (codegen, class loading) on the smallest data; not timed.
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        Q.q_channel_credit(spark, warm).write.format("noop").mode("overwrite").save()

    times = {}
    for name in HEADLINE:
        t0 = time.time()
        Q.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)

    t0 = time.time()
    tables = standin.load(spark, sf_dir)
    ledger_root = os.path.join(scratch, "ledger")
    Ledger(spark, ledger_root).create(tables["ledger"])
    report = run_delivery(spark, tables, ledger_root, os.path.join(scratch, "delivery"))
    times["daily_run"] = round(time.time() - t0, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "spark": spark.version,
        "daily_run_exported_rows": report.exported_rows,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
