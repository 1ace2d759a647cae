"""Per-customer order history: lifetime measures and six 30-day windows.

One pass over delivered orders computes everything (first/last order,
distinct lifetime count, recency count, per-window counts and, for the
detail list, per-window merchandise value sums and counts). The rule that
blanks a window whose older edge is before the first order depends only on
``first_order_date``, which is constant per customer, so it is applied after
the aggregate: ``SUM(CASE WHEN edge < first THEN NULL WHEN in THEN 1 ELSE 0)``
equals ``IF(edge < first, NULL, SUM(IF(in, 1, 0)))``. That removes the second
scan of orders and the join back to it.

Shuffle shape: rows are hash-partitioned once on the customer id (plus a
salt for hot customers, see ``skew``); the exact distinct count and every
other aggregate then run inside those partitions with no further exchange.
Only when hot customers were salted does a second, small exchange merge
their (customer, salt) partial rows -- one row per split, not per order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SegmentConfig
from ..functions.arith import ratio
from ..functions.dates import day_within, days_before, months_before, ntz
from . import skew


def delivered_orders(orders: DataFrame, cfg: SegmentConfig) -> DataFrame:
    """Delivered orders that have a delivery time (both tests push to Parquet)."""
    return orders.filter(
        (F.col("status") == cfg.delivered_status) & F.col("delivered_at").isNotNull()
    ).select("id", "customer_id", "created_at", "actual_subtotal", *[c for c in orders.columns if c == skew.SALT])


def recent_customers(orders: DataFrame, cfg: SegmentConfig) -> DataFrame:
    """Distinct ids of customers with a delivered order in the recency range
    (a range on the raw column, pushed to the scan)."""
    rows = delivered_orders(orders, cfg).filter(
        day_within(F.col("created_at"), *edges(cfg).recency) & F.col("customer_id").isNotNull())
    return rows.select(F.col("customer_id").alias("cid")).distinct()


@dataclass(frozen=True)
class Edges:
    now: Column
    recency: tuple[Column, Column]
    windows: tuple[tuple[Column, Column], ...]  # (older edge, newer edge), newest first
    tenure: Column


def edges(cfg: SegmentConfig, now: Column | None = None) -> Edges:
    """The edges at ``now`` (a column of times, for many run dates), by default ``cfg.as_of``."""
    now = ntz(cfg.as_of) if now is None else now
    d = cfg.window_days
    wins = tuple(
        (days_before(now, d * (k + 1)), now if k == 0 else days_before(now, d * k))
        for k in range(cfg.n_windows)
    )
    older, newer = cfg.recency_months
    return Edges(
        now=now,
        recency=(months_before(now, older), months_before(now, newer)),
        windows=wins,
        tenure=months_before(now, cfg.tenure_months),
    )


def count_col(cfg: SegmentConfig, k: int) -> str:
    return f"{cfg.window_names[k]}_order_count"


def aov_col(cfg: SegmentConfig, k: int) -> str:
    return f"{cfg.window_names[k]}_monthly_AOV"


def gmv_col(cfg: SegmentConfig, k: int) -> str:
    return f"{cfg.window_names[k]}_monthly_GMV"


def _partial_aggs(cfg: SegmentConfig, e: Edges, with_value: bool) -> list[Column]:
    at = F.col("created_at")
    aggs = [
        F.min("created_at").alias("_first"),
        F.max("created_at").alias("_last"),
        F.count_distinct("id").alias("_n"),
        F.count_if(day_within(at, *e.recency)).alias("_rec"),
    ]
    for k, (lo, hi) in enumerate(e.windows):
        inside = day_within(at, lo, hi)
        aggs.append(F.count_if(inside).alias(f"_c{k}"))
        if with_value:
            value = F.when(inside, F.col("actual_subtotal"))
            aggs.append(F.sum(value).alias(f"_v{k}"))
            aggs.append(F.count(value).alias(f"_m{k}"))
    return aggs


def _merge_aggs(cfg: SegmentConfig, with_value: bool) -> list[Column]:
    aggs = [
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
        F.sum("_n").alias("_n"),
        F.sum("_rec").alias("_rec"),
    ]
    for k in range(cfg.n_windows):
        aggs.append(F.sum(f"_c{k}").alias(f"_c{k}"))
        if with_value:
            aggs.append(F.sum(f"_v{k}").alias(f"_v{k}"))
            aggs.append(F.sum(f"_m{k}").alias(f"_m{k}"))
    return aggs


def finish(df: DataFrame, cfg: SegmentConfig, with_value: bool, now: Column | None = None, *more: str) -> DataFrame:
    """The history's columns (and ``more`` of ``df``) from per-customer aggregates, windows masked."""
    e = edges(cfg, now)
    first = F.col("_first")
    out = [
        F.col("customer_id").alias("cid"),
        first.alias("first_order_date"),
        F.col("_last").alias("last_order_date"),
        F.col("_n").cast("long").alias("total_orders_lifetime"),
        F.col("_rec").cast("long").alias("recency"),
    ]
    # A window reaching back before the first order is not observable: NULL.
    masks = [lo < first for lo, _ in e.windows]

    def masked(blank: Column, value: Column) -> Column:
        return F.when(blank, F.lit(None)).otherwise(value)

    for k, blank in enumerate(masks):
        out.append(masked(blank, F.col(f"_c{k}").cast("long")).alias(count_col(cfg, k)))
    if with_value:
        for k, blank in enumerate(masks):
            aov = ratio(F.col(f"_v{k}"), F.col(f"_m{k}"))
            out.append(masked(blank, aov).alias(aov_col(cfg, k)))
        for k, blank in enumerate(masks):
            gmv = F.col(f"_v{k}").cast("decimal(38,2)")
            out.append(masked(blank, gmv).alias(gmv_col(cfg, k)))
    return df.select(*out, *more)


def order_history(delivered: DataFrame, cfg: SegmentConfig, with_value: bool = False,
                  plan: skew.ShufflePlan | None = None) -> DataFrame:
    """One row per customer id found in ``delivered``.

    ``plan`` (see ``skew``) says which customers to salt and, when the volume
    needs it, gives an explicit partition count.
    """
    e = edges(cfg)
    plan = plan or skew.ShufflePlan()
    rows = delivered  # unused columns are pruned below the shuffle by Catalyst
    keys = ["customer_id"]
    if plan.salted:
        rows = skew.with_salt(rows, plan)
    salted = skew.SALT in rows.columns
    if salted:
        keys.append(skew.SALT)
    if plan.in_place:
        shuffled = rows
    else:
        # Without an explicit count AQE may coalesce the partitions further.
        shuffled = (rows.repartition(plan.partitions, *keys) if plan.partitions
                    else rows.repartition(*keys))
    per_key = shuffled.groupBy(*keys).agg(*_partial_aggs(cfg, e, with_value))
    if salted:
        per_key = per_key.groupBy("customer_id").agg(*_merge_aggs(cfg, with_value))
    return finish(per_key, cfg, with_value)


def regular(history: DataFrame, cfg: SegmentConfig, now: Column | None = None) -> DataFrame:
    """Regular customers: enough lifetime orders, a recent order, and a first
    order more than ``tenure_months`` calendar months ago (strict)."""
    e = edges(cfg, now)
    return history.filter(
        (F.col("total_orders_lifetime") >= cfg.min_orders)
        & (F.col("recency") >= cfg.min_recent)
        & (F.col("first_order_date") < e.tenure)
    )
