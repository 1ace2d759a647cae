"""Write PLANS.md: the physical plans of the three orders-pass paths.

    python tools/plans_doc.py [sf_dir]

The mapped test tables are first written as real-schema Parquet in a
scratch folder (so push-down is what it would be on real tables); each
section keeps the plan tree and the scan details (pushed filters, read
schema) of Spark's formatted explain output.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def trim(text: str) -> str:
    """The tree, then only the scan/exchange detail lines worth reading."""
    tree, _, details = text.partition("\n\n(")
    keep = []
    for block in ("(" + details).split("\n\n"):
        head = block.split("\n", 1)[0]
        if re.match(r"\(\d+\) (Scan parquet|Exchange|BroadcastExchange)", head):
            lines = [ln for ln in block.split("\n")
                     if ln.startswith(("(", "PushedFilters", "ReadSchema", "Arguments"))]
            keep.append("\n".join(lines))
    return tree.rstrip() + "\n\n" + "\n\n".join(keep)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from ebbtide.config import FIXTURE_AS_OF, SegmentConfig
    from ebbtide.operators import skew
    from ebbtide.plans import incremental, lists
    from ebbtide.session import local_session
    from ebbtide.sources import buckets, fixtures, schemas
    from ebbtide.sources import tables as tables_mod

    scratch = tempfile.mkdtemp(prefix="ebbtide-plans-")
    spark = local_session(8, scratch=scratch)
    src = fixtures.tables(spark, sf_dir)
    paths = {}
    for name, df, schema in [("customers", src.customers, schemas.CUSTOMERS),
                             ("orders", src.orders, schemas.ORDERS),
                             ("subscriptions", src.subscriptions, schemas.SUBSCRIPTIONS),
                             ("metros", src.metros, schemas.METROS)]:
        paths[name] = os.path.join(scratch, "tables", name)
        tables_mod.conform(df, schema).write.parquet(paths[name])
    t = tables_mod.load(spark, paths["customers"], paths["orders"], paths["subscriptions"],
                        paths["metros"])
    cfg = SegmentConfig(as_of=FIXTURE_AS_OF)
    plan = lists.plan_orders(t, cfg)
    hot = skew.ShufflePlan(16, [(5, 3), (8, 2)])

    def via(c, broadcast):
        return lists.base_from(lists.declining_customers(t, c, broadcast=broadcast, plan=plan), c)

    buckets.store_orders(t.orders, "plan_orders", 8, path=os.path.join(scratch, "buckets"))
    stored = buckets.load(spark, "plan_orders", t)
    state = incremental.advance(spark, os.path.join(scratch, "state"), t.orders, "all", cfg)
    sections = [
        ("Base list, eligible ids broadcast (counted to fit the budget)", via(cfg, None)),
        ("Base list, eligible ids over the budget: bitmap prefilter, aggregate, exact join",
         via(cfg, False)),
        ("Base list, orders laid out by date: ids reduced by a pushed recency range first",
         via(cfg.replace(orders_by_created_at=True), None)),
        ("Base list, orders in buckets, eligible ids over the budget: joined and aggregated in place",
         lists.base_from(lists.declining_customers(stored, cfg, broadcast=False), cfg)),
        ("Base list from the history kept between runs",
         lists.base_from(incremental.declining_customers(t, state, cfg), cfg)),
        ("Detail list with two hot customers split", lists.detail_list(t, cfg, hot)),
        ("Metro list (join back to customers, counted broadcast of metros)",
         lists.metro_list(t, cfg, plan)),
    ]
    out = ["# Physical plans", "",
           f"Generated by `tools/plans_doc.py` from `{sf_dir}` written as real-schema "
           "Parquet; Spark's formatted explain, trimmed to the plan tree and the scan / "
           "exchange details. `AdaptiveSparkPlan isFinalPlan=false` is the plan before "
           "AQE re-optimizes at stage boundaries.", ""]
    for title, df in sections:
        out += [f"## {title}", "", "```", trim(formatted(df)), "```", ""]
    spark.stop()
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out).replace(scratch, "<scratch>"))


if __name__ == "__main__":
    main()
