"""The four customer lists, composed from the operators.

Plan shape (orders is the only large input):

* eligibility: customers scan with pushed predicates, semi-joined with the
  map-side-distinct active subscribers -> one row per eligible id; where orders
  are laid out by date, further semi-joined with the customers that ordered in
  the recency range (a pushed range on orders);
* if the eligible ids fit the broadcast budget (counted, not estimated),
  delivered orders are semi-joined against a broadcast of them: a map-side
  filter, so only eligible customers' orders reach the shuffle;
  otherwise orders are filtered map-side by a blocked bitmap of the eligible
  ids (sized from their count, bounded by ``cfg.bitmap_max_bytes``, no false
  negatives), aggregated,
  and the
  per-customer result -- one row per customer -- is joined exactly with the
  eligible ids, a join of two unique-keyed sides that cannot skew;
* one hash shuffle on customer id (+ salt for hot customers, partition count
  from the counts that an earlier run saved, or from a sample on a first run) feeds the one-pass history aggregate; scores,
  labels and filters are narrow;
* orders that are stored in buckets by customer (``sources.buckets``) are
  aggregated and joined where they lie, without that shuffle;
* metro and arm attributes join the (small) result back to customers; the
  metro table is broadcast only after counting it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SegmentConfig
from ..functions.dates import ntz
from ..operators import eligibility, history, scoring, segments, semijoin, skew
from ..sources.tables import Tables
from . import strategy


def eligible(tables: Tables, cfg: SegmentConfig, *attrs: str) -> DataFrame:
    return eligibility.eligible_customers(tables.customers, tables.subscriptions, cfg, *attrs)


def candidates(tables: Tables, cfg: SegmentConfig) -> DataFrame:
    # Customers passing the row predicates bound the eligible ids from above
    # (the subscription semi-join only removes rows) and are cheaper to count.
    return tables.customers.filter(eligibility.customer_filter(cfg)).select("id")


def _delivered(tables: Tables, cfg: SegmentConfig) -> DataFrame:
    # An order without a customer id can never match a customer; dropping it
    # here keeps it out of the sample and out of a NULL-key group in one task.
    return history.delivered_orders(tables.orders, cfg).filter(F.col("customer_id").isNotNull())


def plan_orders(tables: Tables, cfg: SegmentConfig) -> skew.ShufflePlan:
    """The shuffle plan of a first run, from a sample of delivered orders."""
    return skew.plan_shuffle(_delivered(tables, cfg), cfg)


def reduced(delivered: DataFrame, ids: DataFrame, how: str, n: int) -> DataFrame:
    """Orders that may be those of ``ids``: exactly theirs if broadcast."""
    if how == "broadcast":
        keys = ids.select(F.col("cid").alias("customer_id"))
        return delivered.join(F.broadcast(keys), "customer_id", "left_semi")
    if how == "bitmap":
        return semijoin.keep_listed(delivered, semijoin.blocks(ids, "cid", n), "customer_id", n)
    return delivered


def eligible_orders(tables: Tables, cfg: SegmentConfig) -> DataFrame:
    """Delivered orders, reduced map-side to those that may be eligible customers'."""
    ids = eligible(tables, cfg)
    n_ids = strategy.bounded_count(tables, candidates(tables, cfg), cfg)
    how, bits = strategy.orders_join(tables.orders.sparkSession, cfg, n_ids)
    return reduced(_delivered(tables, cfg), ids, how, bits).select("id", "customer_id", "created_at", "actual_subtotal")


def customer_orders(tables: Tables, cfg: SegmentConfig, broadcast: bool | None = None) -> DataFrame:
    """Delivered orders of the eligible customers, one row per order."""
    ids = eligible(tables, cfg)
    n_ids = strategy.bounded_count(tables, candidates(tables, cfg), cfg)
    how, bits = strategy.orders_join(tables.orders.sparkSession, cfg, n_ids, broadcast)
    rows = reduced(_delivered(tables, cfg), ids, how, bits)
    if how == "broadcast":
        return rows
    return rows.join(ids.select(F.col("cid").alias("customer_id")), "customer_id", "left_semi")


def customer_history(tables: Tables, cfg: SegmentConfig, with_value: bool = False,
                     broadcast: bool | None = None, plan: skew.ShufflePlan | None = None,
                     counts: skew.Counts | None = None, attrs: tuple[str, ...] = (),
                     recent_only: bool = False) -> DataFrame:
    """Order history of every eligible customer (before the regularity test).

    ``broadcast`` forces (True) or forbids (False) broadcasting the eligible
    ids into the orders scan; None decides by counting. ``plan`` is the
    shuffle plan (None: sample one); ``counts`` observes the orders per
    customer for the next run. ``attrs`` are customer columns to carry.
    ``recent_only`` may leave out customers without an order in the recency
    range, which the regularity test would drop.
    """
    ids = eligible(tables, cfg, *attrs)
    if recent_only and cfg.orders_by_created_at and cfg.min_recent >= 1:
        ids = ids.join(history.recent_customers(tables.orders, cfg), "cid", "left_semi")
    if tables.in_buckets:
        return _bucket_history(tables, cfg, with_value, broadcast, counts, attrs, ids)
    delivered = _delivered(tables, cfg)
    n_ids, plan = strategy.probe_orders_pass(
        tables, candidates(tables, cfg), delivered, cfg, plan)
    how, bits = strategy.orders_join(tables.orders.sparkSession, cfg, n_ids, broadcast)
    per_customer = history.order_history(
        reduced(delivered, ids, how, bits), cfg, with_value, plan)
    if counts is not None:
        per_customer = counts.watch(per_customer)
    if how == "broadcast" and not attrs:
        return per_customer
    # Aggregated first: the exact join is between two unique-keyed,
    # customer-scale sides (and drops the bitmap's false positives).
    return per_customer.join(ids, "cid", "inner")


def _bucket_history(tables: Tables, cfg: SegmentConfig, with_value: bool, broadcast: bool | None,
                    counts: skew.Counts | None, attrs: tuple[str, ...], ids: DataFrame) -> DataFrame:
    """``customer_history`` of orders in buckets: aggregated where they lie. Where the
    ids are not broadcast, they are shuffled to the buckets and joined there."""
    n_ids = strategy.bounded_count(tables, candidates(tables, cfg), cfg)
    how, _ = strategy.orders_join(tables.orders.sparkSession, cfg, n_ids, broadcast)
    in_place = skew.ShufflePlan(in_place=True)

    def of(orders: DataFrame) -> DataFrame:
        rows = history.delivered_orders(orders, cfg)
        if how == "broadcast":
            rows = reduced(rows, ids, how, 0)
        return history.order_history(rows, cfg, with_value, in_place)

    def listed(per: DataFrame) -> DataFrame:
        return per if how == "broadcast" and not attrs else per.join(ids, "cid", "inner")

    per_customer = listed(of(tables.orders))
    if tables.hot_orders is not None:
        per_customer = per_customer.unionByName(listed(of(tables.hot_orders)))
    return counts.watch(per_customer) if counts is not None else per_customer


def regular_history(tables: Tables, cfg: SegmentConfig, with_value: bool = False,
                    broadcast: bool | None = None, **options) -> DataFrame:
    return history.regular(customer_history(
        tables, cfg, with_value, broadcast, recent_only=True, **options), cfg)


def labelled(regular: DataFrame, cfg: SegmentConfig, with_value: bool = False, now=None) -> DataFrame:
    """Scores, decline filter and sub-group of regular customers."""
    scored = scoring.score(regular, cfg, with_value, now)
    return segments.declining(scored, cfg).withColumn("sub_group", segments.sub_group(cfg))


def declining_customers(tables: Tables, cfg: SegmentConfig, with_value: bool = False,
                        broadcast: bool | None = None, **options) -> DataFrame:
    return labelled(regular_history(tables, cfg, with_value, broadcast, **options), cfg, with_value)


def _run_date(cfg: SegmentConfig):
    return F.to_date(ntz(cfg.as_of))


def base_from(declining: DataFrame, cfg: SegmentConfig) -> DataFrame:
    return declining.select(
        _run_date(cfg).alias("date"), F.col("cid").alias("customer_id"), "sub_group"
    )


def _with_attrs(declining: DataFrame, tables: Tables, *cols: str) -> DataFrame:
    """Attach customer attributes (inner join on the customer key: every
    listed id is a customer, so no row is lost) unless already carried."""
    if all(c in declining.columns for c in cols):
        return declining
    return declining.join(tables.customers.select(F.col("id").alias("cid"), *cols), "cid", "inner")


def metro_from(declining: DataFrame, tables: Tables, cfg: SegmentConfig) -> DataFrame:
    """Customers without a metro, or with an unknown one, are not listed."""
    metros = strategy.bounded_broadcast(
        tables.metros.select(F.col("id").alias("metro_id"), F.col("name").alias("metro")), cfg
    )
    return (
        _with_attrs(declining, tables, "metro_id")
        .join(metros, "metro_id", "inner")
        .select(_run_date(cfg).alias("date"), F.col("cid").alias("customer_id"), "metro",
                "sub_group")
    )


def test_from(declining: DataFrame, tables: Tables, cfg: SegmentConfig) -> DataFrame:
    """Every listed customer is kept; outside both bucket ranges the arm is NULL."""
    return _with_attrs(declining, tables, "bucket_number").select(
        _run_date(cfg).alias("date"),
        F.col("cid").alias("customer_id"),
        "sub_group",
        segments.test_arm(cfg, F.col("bucket_number")).alias("test_cohort"),
    )


def detail_columns(cfg: SegmentConfig) -> list[str]:
    n = cfg.n_windows
    return (
        ["cid", "first_order_date", "last_order_date", scoring.AVG, scoring.COHORT,
         scoring.MAGNITUDE, scoring.DAYS_SINCE, scoring.GAP, scoring.drop_col(cfg)]
        + [history.count_col(cfg, k) for k in range(n)]
        + [scoring.GMV_AVG, scoring.AOV_AVG]
        + [history.aov_col(cfg, k) for k in range(n)]
    )


def details_from(declining: DataFrame, cfg: SegmentConfig) -> DataFrame:
    return declining.select(
        _run_date(cfg).alias("run_date"), *detail_columns(cfg), "sub_group"
    )


def base_list(tables: Tables, cfg: SegmentConfig, plan: skew.ShufflePlan | None = None) -> DataFrame:
    """date, customer_id, sub_group."""
    return base_from(declining_customers(tables, cfg, plan=plan), cfg)


def metro_list(tables: Tables, cfg: SegmentConfig, plan: skew.ShufflePlan | None = None) -> DataFrame:
    """date, customer_id, metro, sub_group."""
    return metro_from(declining_customers(tables, cfg, plan=plan), tables, cfg)


def test_list(tables: Tables, cfg: SegmentConfig, plan: skew.ShufflePlan | None = None) -> DataFrame:
    """date, customer_id, sub_group, test_cohort."""
    return test_from(declining_customers(tables, cfg, plan=plan), tables, cfg)


def detail_list(tables: Tables, cfg: SegmentConfig, plan: skew.ShufflePlan | None = None) -> DataFrame:
    """run_date, 23 measures, sub_group (25 columns)."""
    return details_from(declining_customers(tables, cfg, with_value=True, plan=plan), cfg)


LISTS = ("base", "metro", "test", "details")


def shared_pass(tables: Tables, cfg: SegmentConfig, wanted: tuple[str, ...] = LISTS,
                plan: skew.ShufflePlan | None = None,
                counts: skew.Counts | None = None) -> tuple[dict[str, DataFrame], str]:
    """The wanted lists from a single pass over orders, and the path of the
    intermediate table that they read (``strategy.discard`` it after use).

    The declining customers, with just what the wanted lists need, are written
    to the shared folder; each list is a cheap projection of that small table
    (the metro list also joins the counted metros broadcast).
    """
    return from_declining(tables, cfg, wanted, lambda with_value, attrs: declining_customers(
        tables, cfg, with_value=with_value, plan=plan, counts=counts, attrs=attrs))


def from_declining(tables: Tables, cfg: SegmentConfig, wanted: tuple[str, ...],
                   make_declining) -> tuple[dict[str, DataFrame], str]:
    """The wanted lists from ``make_declining(with_value, attrs)``, stored once, and its path."""
    unknown = sorted(set(wanted) - set(LISTS))
    if unknown:
        raise ValueError(f"unknown lists: {', '.join(unknown)}")
    attrs = ("metro_id",) * ("metro" in wanted) + ("bucket_number",) * ("test" in wanted)
    declining, path = strategy.reliable(make_declining("details" in wanted, attrs))
    make = {
        "base": lambda: base_from(declining, cfg),
        "metro": lambda: metro_from(declining, tables, cfg),
        "test": lambda: test_from(declining, tables, cfg),
        "details": lambda: details_from(declining, cfg),
    }
    return {name: make[name]() for name in wanted}, path


def all_lists(tables: Tables, cfg: SegmentConfig,
              plan: skew.ShufflePlan | None = None) -> dict[str, DataFrame]:
    """All four lists from a single pass over orders."""
    return shared_pass(tables, cfg, plan=plan)[0]
