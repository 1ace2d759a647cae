"""The base list of many run dates from one pass over the orders.

The windows of all dates are sums of the same day rows (``operators.rollup``), whose
edges slide with the date. So the orders are aggregated to day rows once; each day
row then counts for every run time whose windows may hold its day, and one
aggregate by customer and run time replaces a scan per date. First and last order
and the lifetime count have no upper bound in time, so they are the same for all
dates, as is eligibility, which reads the current customers and subscriptions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SegmentConfig
from ..functions.dates import ntz
from ..operators import history, rollup
from ..sources.tables import Tables
from . import incremental, lists, strategy

NOW = "now"


def _history(totals: DataFrame, days: DataFrame, cfg: SegmentConfig, times: list[str]) -> DataFrame:
    """The order history of every customer at each of ``times``."""
    sums = rollup.window_sums(rollup.at_each(days, cfg, times, NOW), cfg, now=NOW)
    totals = totals.withColumnsRenamed({"first": "_first", "last": "_last", "n": "_n"})
    if cfg.min_recent >= 1:  # who ordered in no window is never listed
        joined = sums.join(totals, "customer_id")
    else:
        each = totals.withColumn(NOW, F.explode(F.array(*[ntz(t) for t in times])))
        joined = each.join(sums, ["customer_id", NOW], "left")
    none = [c for c in sums.columns if c.startswith(("_rec", "_c"))]
    return history.finish(joined.fillna(0, none), cfg, False, F.col(NOW), NOW)


def base_lists(tables: Tables, cfg: SegmentConfig, times: list[str], held: incremental.State | None = None) -> tuple[DataFrame, str | None]:
    """date, customer_id, sub_group of every run time in ``times`` (``cfg.as_of`` is not used).

    From the stored state ``held``, or else from one pass over the orders, whose day
    rows are stored for the time being: the second value is their path, to be
    discarded after use. Two run times on one date give rows of their own.
    """
    ids = lists.eligible(tables, cfg)
    path = None
    if held is None:
        # one pass over the orders; what follows reads the small table
        parts, path = strategy.reliable(rollup.partials(lists.eligible_orders(tables, cfg)))
        days, words = rollup.day_rows(parts), rollup.id_words(parts)
        seen = parts.groupBy("customer_id").agg(F.min("first").alias("first"), F.max("last").alias("last"))
        totals = seen.join(rollup.totals(words), "customer_id", "left").fillna(0, ["n"])
    else:
        spans = [held.spark.range(1).select(*[c.cast("string") for c in rollup.days_needed(cfg.replace(as_of=t))]).first() for t in (min(times), max(times))]
        days, totals = held.days(spans[0][0], spans[1][1]), held.totals()
    per_time = _history(totals, days, cfg, times).join(ids, "cid", "left_semi")
    now = F.col(NOW)
    listed = lists.labelled(history.regular(per_time, cfg, now), cfg, now=now)
    return listed.select(F.to_date(now).alias("date"), F.col("cid").alias("customer_id"), "sub_group"), path
