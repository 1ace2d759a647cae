"""Task sizes of the orders shuffle when one customer holds a third of the rows.

    python tools/skew_report.py [sf_dir]

Orders are derived from the generated ``events`` table as in the fixtures,
except that every third order is moved to one customer. The one-pass
history runs twice: with salting off, and with the shuffle plan measured by
the sample (the target partition size is lowered so that the test data
counts as large). Spark's event log (written to a fresh scratch folder)
gives the rows read by each task of the aggregation stage; the report prints
the largest and median task per run and checks that both runs agree.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

from shuffle_report import read_events  # noqa: E402

HOT_CUSTOMER = 7


def task_reads(folder: str) -> dict[str, list[int]]:
    """Job group -> shuffle records read by every task of its stages."""
    stage_group, out = {}, {}
    for e in read_events(folder):
        ev = e["Event"]
        if ev == "SparkListenerJobStart":
            g = e.get("Properties", {}).get("spark.jobGroup.id")
            for s in e["Stage IDs"]:
                if g:
                    stage_group[s] = g
        elif ev == "SparkListenerTaskEnd":
            g = stage_group.get(e["Stage ID"])
            m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
            n = m.get("Total Records Read", 0)
            if g and n:
                out.setdefault(g, []).append(n)
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="ebbtide-skew-")
    logs = os.path.join(scratch, "events")
    os.makedirs(logs)
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from ebbtide.config import FIXTURE_AS_OF, SegmentConfig
    from ebbtide.operators import history, skew
    from ebbtide.session import tune
    from ebbtide.sources import fixtures

    spark = (SparkSession.builder.master("local[8]").appName("skew-report")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             .config("spark.local.dir", scratch)
             .config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", logs)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    orders = fixtures.orders(spark, sf_dir).withColumn(
        "customer_id",
        F.when(F.col("id") % 3 == 0, F.lit(HOT_CUSTOMER)).otherwise(F.col("customer_id")))
    delivered = history.delivered_orders(orders, SegmentConfig(as_of=FIXTURE_AS_OF))
    n_rows = delivered.count()
    # "Large" relative to the test data: a target partition of 1/16 of it.
    target = max(1, n_rows * 48 // 16)
    runs = {
        "unsalted": SegmentConfig(as_of=FIXTURE_AS_OF, skew_sample_fraction=0.0),
        "measured": SegmentConfig(as_of=FIXTURE_AS_OF, skew_sample_fraction=0.05,
                                  target_partition_bytes=target),
    }
    results, plans = {}, {}
    for name, cfg in runs.items():
        plan = skew.plan_shuffle(delivered, cfg)
        plans[name] = plan
        spark.sparkContext.setJobGroup(name, name)
        results[name] = sorted(
            tuple(r) for r in history.order_history(delivered, cfg, True, plan).collect())
        spark.sparkContext.setJobGroup("", "")
    spark.stop()
    reads = task_reads(logs)
    for name in runs:
        tasks = reads.get(name, [])
        print(json.dumps({
            "run": name, "delivered_rows": n_rows,
            "hot": plans[name].hot, "partitions": plans[name].partitions,
            "max_task_rows": max(tasks), "median_task_rows": statistics.median(tasks),
            "tasks": len(tasks)}))
    print(json.dumps({"same_result": results["unsalted"] == results["measured"]}))


if __name__ == "__main__":
    main()
