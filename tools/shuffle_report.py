"""Shuffle volume, jobs and stages per plan, read from Spark's event log.

    python tools/shuffle_report.py [sf_dir] [--real]

Writes the event log to a fresh scratch folder (no UI, no server) and
prints one JSON line per plan: the one-pass base and detail lists, the
literal two-scan base list kept in bench.py as a control, and the base list
when the eligible ids may not be broadcast -- with the bitmap prefilter and
with every delivered order aggregated.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

import zstandard

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def read_events(folder: str):
    for f in sorted(glob.glob(os.path.join(folder, "eventlog_v2_*", "events_*"))):
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            yield json.loads(line)


def summarize(folder: str) -> dict:
    groups: dict[str, dict] = {}
    job_group: dict[int, str] = {}
    stage_group: dict[int, str] = {}
    for e in read_events(folder):
        ev = e["Event"]
        if ev == "SparkListenerJobStart":
            g = e.get("Properties", {}).get("spark.jobGroup.id")
            if not g:
                continue
            job_group[e["Job ID"]] = g
            for s in e["Stage IDs"]:
                stage_group[s] = g
            groups.setdefault(g, {"jobs": 0, "stages": 0, "shuffle_bytes": 0,
                                  "shuffle_records": 0, "input_bytes": 0})["jobs"] += 1
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            g = stage_group.get(si["Stage ID"])
            if not g:
                continue
            acc = {a["Name"]: a.get("Value") or 0 for a in si.get("Accumulables", [])}
            d = groups[g]
            d["stages"] += 1
            d["shuffle_bytes"] += int(acc.get("internal.metrics.shuffle.write.bytesWritten", 0))
            d["shuffle_records"] += int(acc.get("internal.metrics.shuffle.write.recordsWritten", 0))
            d["input_bytes"] += int(acc.get("internal.metrics.input.bytesRead", 0))
    return groups


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf_dir = args[0] if args else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="ebbtide-report-")
    logs = os.path.join(scratch, "events")
    os.makedirs(logs)
    from pyspark.sql import SparkSession

    from bench import real_tables, two_scan, two_scan_base
    from ebbtide.config import FIXTURE_AS_OF, SegmentConfig
    from ebbtide.plans import lists
    from ebbtide.session import tune
    from ebbtide.sources import fixtures

    spark = (SparkSession.builder.master("local[8]").appName("shuffle-report")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.local.dir", scratch)
             .config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", logs)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    cfg = SegmentConfig(as_of=FIXTURE_AS_OF)
    t = fixtures.tables(spark, sf_dir)
    if "--real" in sys.argv:
        t = real_tables(spark, sf_dir, scratch)
    plan = lists.plan_orders(t, cfg)

    def no_broadcast(c):
        return lambda: lists.base_from(
            lists.declining_customers(t, c, broadcast=False, plan=plan), c).collect()

    plans = {
        "one_pass_base": lambda: lists.base_list(t, cfg, plan).collect(),
        "one_pass_details": lambda: lists.detail_list(t, cfg, plan).collect(),
        "two_scan_base": lambda: two_scan_base(t, cfg).collect(),
        "two_scan_details": lambda: lists.details_from(two_scan(t, cfg, True), cfg).collect(),
        "first_run_sample": lambda: lists.plan_orders(t, cfg),
        "no_broadcast_bitmap_base": no_broadcast(cfg),
        "no_broadcast_all_orders_base": no_broadcast(cfg.replace(prefilter=False)),
        "reduced_base": lambda: lists.base_list(t, cfg.replace(orders_by_created_at=True), plan).collect(),
    }
    for name, fn in plans.items():
        fn()  # warm-up, not counted
        spark.sparkContext.setJobGroup(name, name)
        fn()
        spark.sparkContext.setJobGroup("", "")
    spark.stop()
    for name, d in summarize(logs).items():
        if name in plans:
            print(json.dumps({"plan": name, **d}))


if __name__ == "__main__":
    main()
