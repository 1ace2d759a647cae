"""Run the segmentation as a batch job.

    spark-submit --py-files ebbtide.zip run_lists.py --customers <path> \\
        --orders ... --subscriptions ... --metros ... \\
        --as-of "2020-08-14 12:00:00" --out <folder>

(locally: python -m ebbtide.run <same arguments>)

Reads the four tables -- paths, or catalog names with ``--catalog`` --, computes
the wanted lists in one pass over orders and writes them under
``<out>/{base,metro,test,details}``, or into tables ``<out>_base`` etc. with
``--out-catalog``, partitioned by run date. Intermediate tables go to
``spark.checkpoint.dir`` (set it to a shared folder) and are deleted at the end.

With ``--publish`` the lists become visible all at once under ``--out``. With
``--state`` the history of earlier runs is kept in a folder, and a run reads only
the orders that arrived since.

The counts that size the orders shuffle are kept under ``--counts`` (default
``<out>/_counts``; with ``--out-catalog`` only if given): a run plans from those
of the run before and saves its own.
"""

from __future__ import annotations

import argparse
import datetime as dt
import zoneinfo

from pyspark.sql import SparkSession

from .config import SegmentConfig
from .operators import skew
from .plans import incremental, lists, strategy
from .session import tune
from .sources import sinks, tables


def _lists(text: str) -> tuple[str, ...]:
    names = tuple(dict.fromkeys(x.strip() for x in text.split(",") if x.strip()))
    bad = [x for x in names if x not in lists.LISTS]
    if bad or not names:
        raise argparse.ArgumentTypeError(f"choose from {','.join(lists.LISTS)}, not {text!r}")
    return names


def _zone(text: str) -> zoneinfo.ZoneInfo:
    try:
        return zoneinfo.ZoneInfo(text)
    except (ValueError, zoneinfo.ZoneInfoNotFoundError) as e:
        raise argparse.ArgumentTypeError(f"unknown time zone {text!r}") from e


def parse(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="ebbtide.run")
    for name in ("customers", "orders", "subscriptions", "metros"):
        p.add_argument(f"--{name}", required=True, help=f"path (or name) of the {name} table")
    p.add_argument("--catalog", action="store_true", help="the four inputs are catalog names")
    p.add_argument("--format", default="parquet", help="input format (default parquet)")
    p.add_argument("--as-of", required=True,
                   help="'YYYY-MM-DD HH:MM:SS' (wall clock, no zone) or 'now'")
    p.add_argument("--time-zone", type=_zone, default="UTC",
                   help="zone whose wall clock 'now' reads (default UTC)")
    p.add_argument("--out", required=True, help="output folder (or table name prefix)")
    p.add_argument("--out-catalog", action="store_true", help="write catalog tables")
    p.add_argument("--out-format", default="parquet")
    p.add_argument("--publish", action="store_true",
                   help="make the lists visible under --out all at once (read them by sinks.published)")
    p.add_argument("--state", help="folder of the history kept between runs: only orders that arrived "
                                   "since the last run are read (see plans.incremental)")
    p.add_argument("--arrived-until", help="with --state: read orders delivered before this time (default --as-of)")
    p.add_argument("--counts", help="folder of the counts that size the shuffle")
    p.add_argument("--lists", type=_lists, default=",".join(lists.LISTS),
                   help="comma-separated subset of base,metro,test,details")
    p.add_argument("--orders-by-created-at", action="store_true",
                   help="orders are laid out by created_at: read the recency range first")
    p.add_argument("--explain", action="store_true",
                   help="print the formatted physical plans instead of running")
    return p.parse_args(argv)


def resolve_as_of(text: str, zone: dt.tzinfo = dt.timezone.utc) -> str:
    if text == "now":
        return dt.datetime.now(zone).strftime("%Y-%m-%d %H:%M:%S")
    return dt.datetime.fromisoformat(text).strftime("%Y-%m-%d %H:%M:%S.%f")


def run(spark: SparkSession, args: argparse.Namespace) -> dict[str, str]:
    tune(spark)
    inputs = (args.customers, args.orders, args.subscriptions, args.metros)
    t = (tables.from_catalog(spark, *inputs) if args.catalog
         else tables.load(spark, *inputs, fmt=args.format))
    cfg = SegmentConfig(as_of=resolve_as_of(args.as_of, args.time_zone),
                        orders_by_created_at=args.orders_by_created_at)
    saved = args.counts or (None if args.out_catalog else f"{args.out.rstrip('/')}/_counts")
    plan = skew.saved_plan(spark, saved, cfg) if saved else None
    if args.publish and args.out_catalog:
        raise ValueError("--publish writes folders, not catalog tables")
    if args.explain:
        # Plans of the single lists (ids are still counted, and a first run
        # still samples: that decides the plan); nothing is written.
        single = {"base": lists.base_list, "metro": lists.metro_list,
                  "test": lists.test_list, "details": lists.detail_list}
        plan = plan or lists.plan_orders(t, cfg)
        for name in args.lists:
            print(f"== {name} ==")
            single[name](t, cfg, plan).explain(mode="formatted")
        return {}
    counts = None
    if args.state:
        until = resolve_as_of(args.arrived_until, args.time_zone) if args.arrived_until else cfg.as_of
        held = incremental.advance_until(spark, args.state, t.orders, until, cfg)
        out, stage = incremental.wanted_lists(t, held, cfg, args.lists)
    else:
        counts = skew.Counts(cfg)
        out, stage = lists.shared_pass(t, cfg, args.lists, plan, counts)
    written = {}
    try:
        if args.publish:
            written = sinks.publish(out, args.out, cfg.as_of[:10], args.out_format)
        for name, df in () if args.publish else out.items():
            if args.out_catalog:
                written[name] = f"{args.out}_{name}"
                sinks.write_table(df, written[name], args.out_format)
            else:
                written[name] = f"{args.out.rstrip('/')}/{name}"
                sinks.write_list(df, written[name], args.out_format)
        if saved and counts:
            counts.save(spark, saved)
    finally:
        strategy.discard(spark, stage)
    return written


def main(argv=None) -> None:
    args = parse(argv)
    spark = (SparkSession.builder.appName("ebbtide")
             # static: no per-Column Python call-site capture while planning
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .getOrCreate())
    for name, path in run(spark, args).items():
        print(f"{name}: {path}")


if __name__ == "__main__":
    main()
