"""Registry of runnable queries: one per operator/stage and one per list.

Each entry takes ``(spark, sf_dir)``, maps the generated test tables of that
directory to the four inputs, and returns a lazy DataFrame whose column
names match the DuckDB oracle in ``ebbtide.oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import (BACKFILL, FIXTURE_AS_OF, FIXTURE_AS_OF_MIDNIGHT, FIXTURE_AS_OF_MONTH_END, FIXTURE_NO_ORDERS,
                     SegmentConfig)
from .operators import eligibility, history, scoring, segments, skew
from .operators.not_in import not_in
from .plans import backfill, incremental, lists, strategy
from .sources import buckets, fixtures
from .sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]

MIDDAY = SegmentConfig(as_of=FIXTURE_AS_OF)
MIDNIGHT = SegmentConfig(as_of=FIXTURE_AS_OF_MIDNIGHT)
MONTH_END = SegmentConfig(as_of=FIXTURE_AS_OF_MONTH_END)

# Shuffle plans by session and folder: orders are sampled once for all queries.
_PLANS: dict[tuple[str, str], skew.ShufflePlan] = {}


def _plan(spark: SparkSession, sf_dir: str) -> skew.ShufflePlan:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PLANS:
        _PLANS[key] = lists.plan_orders(_t(spark, sf_dir), MIDDAY)
    return _PLANS[key]


def _t(spark: SparkSession, sf_dir: str) -> Tables:
    return fixtures.tables(spark, sf_dir)


def _ids(pred) -> Query:
    def q(spark, sf_dir):
        return _t(spark, sf_dir).customers.filter(pred(MIDDAY)).select("id")
    return q


def _scored(spark, sf_dir, with_value=False) -> DataFrame:
    reg = lists.regular_history(_t(spark, sf_dir), MIDDAY, with_value, plan=_plan(spark, sf_dir))
    return scoring.score(reg, MIDDAY, with_value)


def _score_col(col: str, with_value=False) -> Query:
    def q(spark, sf_dir):
        return _scored(spark, sf_dir, with_value).select("cid", col)
    return q


def _window_cols(kind: str) -> Query:
    name = {"count": history.count_col, "aov": history.aov_col, "gmv": history.gmv_col}[kind]

    def q(spark, sf_dir):
        reg = lists.regular_history(_t(spark, sf_dir), MIDDAY, with_value=kind != "count",
                                    plan=_plan(spark, sf_dir))
        cols = [name(MIDDAY, k) for k in range(MIDDAY.n_windows)]
        if kind == "count":
            return reg.select("cid", "total_orders_lifetime", "first_order_date",
                              "last_order_date", *cols)
        return reg.select("cid", *cols)
    return q


def src_customers(spark, sf_dir):
    return _t(spark, sf_dir).customers


def src_orders(spark, sf_dir):
    return _t(spark, sf_dir).orders


def src_subscriptions(spark, sf_dir):
    return _t(spark, sf_dir).subscriptions


def src_metros(spark, sf_dir):
    return _t(spark, sf_dir).metros


def elig_active_subscription(spark, sf_dir):
    return eligibility.active_subscribers(_t(spark, sf_dir).subscriptions, MIDDAY)


def elig_delivered(spark, sf_dir):
    return history.delivered_orders(_t(spark, sf_dir).orders, MIDDAY)


def eligible_customers(spark, sf_dir):
    return lists.eligible(_t(spark, sf_dir), MIDDAY)


def join_active_subscription(spark, sf_dir):
    t = _t(spark, sf_dir)
    return t.customers.select(F.col("id").alias("cid")).join(
        eligibility.active_subscribers(t.subscriptions, MIDDAY), "cid", "left_semi"
    )


def join_customer_orders(spark, sf_dir):
    return lists.customer_orders(_t(spark, sf_dir), MIDDAY).select(
        F.col("customer_id").alias("cid"), F.col("id").alias("order_id"), "created_at")


def _history(spark, sf_dir) -> DataFrame:
    return lists.customer_history(_t(spark, sf_dir), MIDDAY, plan=_plan(spark, sf_dir))


def order_lifetime(spark, sf_dir):
    return _history(spark, sf_dir).select(
        "cid", "first_order_date", "last_order_date", "total_orders_lifetime"
    )


def recency_count(spark, sf_dir):
    return _history(spark, sf_dir).select("cid", "recency")


def regular_customers(spark, sf_dir):
    return lists.regular_history(_t(spark, sf_dir), MIDDAY, plan=_plan(spark, sf_dir)).select(
        "cid", "first_order_date", "last_order_date", "total_orders_lifetime"
    )


def sub_group_label(spark, sf_dir):
    return _scored(spark, sf_dir).select("cid", segments.sub_group(MIDDAY).alias("sub_group"))


def declining_filter(spark, sf_dir):
    return segments.declining(_scored(spark, sf_dir), MIDDAY).select(
        "cid", scoring.AVG, history.count_col(MIDDAY, 0)
    )


def test_arm(spark, sf_dir):
    return _t(spark, sf_dir).customers.select(
        "id", segments.test_arm(MIDDAY, F.col("bucket_number")).alias("test_cohort")
    )


def _list(fn, cfg) -> Query:
    def q(spark, sf_dir):
        return fn(_t(spark, sf_dir), cfg, _plan(spark, sf_dir))
    return q


def _of_all(name: str) -> Query:
    """One of the lists as the batch job makes it, from the shared pass."""
    def q(spark, sf_dir):
        return lists.shared_pass(_t(spark, sf_dir), MIDDAY, plan=_plan(spark, sf_dir))[0][name]
    return q


def _base(cfg: SegmentConfig, **options) -> Query:
    def q(spark, sf_dir):
        return lists.base_from(lists.declining_customers(
            _t(spark, sf_dir), cfg, plan=_plan(spark, sf_dir), **options), cfg)
    return q


def _state(spark, sf_dir) -> incremental.State:
    """The history state after three runs, each reading the orders of its own slice."""
    folder = f"{strategy.checkpoint_dir(spark)}/state-{uuid.uuid4().hex}"
    for until in fixtures.ARRIVAL_EDGES:
        state = incremental.advance_until(spark, folder, _t(spark, sf_dir).orders, until, MIDDAY)
    return state


def _incremental(name: str, cfg: SegmentConfig) -> Query:
    def q(spark, sf_dir):
        return incremental.wanted_lists(_t(spark, sf_dir), _state(spark, sf_dir), cfg, (name,))[0][name]
    return q


def order_lifetime_incremental(spark, sf_dir):
    return incremental.customer_history(_t(spark, sf_dir), _state(spark, sf_dir), MIDDAY).select(
        "cid", "first_order_date", "last_order_date", "total_orders_lifetime")


def _not_in_ids(spark, sf_dir):
    customers = _t(spark, sf_dir).customers
    return not_in(customers, "id", eligibility.excluded_ids(customers, MIDDAY)).select("id")


def list_base_backfill(spark, sf_dir):
    """The base list of 30 run dates from one pass over the orders."""
    return backfill.base_lists(_t(spark, sf_dir), MIDDAY, list(BACKFILL))[0]


def _bucketed(spark, sf_dir, plan: skew.ShufflePlan | None) -> Tables:
    """The fixture's orders stored in buckets, as a loading job would."""
    name = f"orders_{uuid.uuid4().hex}"
    t = _t(spark, sf_dir)
    buckets.store_orders(t.orders, name, skew.shuffle_partitions(spark), plan, f"{strategy.checkpoint_dir(spark)}/{name}")
    return buckets.load(spark, name, t)


def _bucket_list(fn, plan: skew.ShufflePlan | None = None, **options) -> Query:
    def q(spark, sf_dir):
        t = _bucketed(spark, sf_dir, plan)
        return fn(lists.declining_customers(t, MIDDAY, **options))
    return q


def list_details_salted(spark, sf_dir):
    """The detail list with every customer split, so the salted two-level
    aggregation is exercised on the whole table."""
    return lists.detail_list(_t(spark, sf_dir), MIDDAY, skew.ShufflePlan(partitions=16, every=4))


def scores_zero_average(spark, sf_dir):
    """Customers without an order in any window: the average is 0, what divides by it NULL."""
    cfg = SegmentConfig(as_of=FIXTURE_NO_ORDERS, min_recent=0)
    scored = scoring.score(lists.regular_history(
        _t(spark, sf_dir), cfg, plan=_plan(spark, sf_dir)), cfg)
    return scored.select("cid", scoring.AVG, scoring.MAGNITUDE, scoring.GAP, scoring.DAYS_SINCE,
                         segments.sub_group(cfg).alias("sub_group"))


def all_spark_queries() -> dict[str, Query]:
    return {
        "src_customers": src_customers,
        "src_orders": src_orders,
        "src_subscriptions": src_subscriptions,
        "src_metros": src_metros,
        "elig_signup_range": _ids(eligibility.signup_in_range),
        "elig_not_deleted": _ids(lambda cfg: eligibility.not_deleted()),
        "elig_payment_like": _ids(eligibility.payment_matches),
        "elig_not_excluded": _ids(eligibility.not_excluded),
        "elig_active_subscription": elig_active_subscription,
        "elig_delivered": elig_delivered,
        "eligible_customers": eligible_customers,
        "join_active_subscription": join_active_subscription,
        "join_customer_orders": join_customer_orders,
        "order_lifetime": order_lifetime,
        "recency_count": recency_count,
        "regular_customers": regular_customers,
        "windowed_counts": _window_cols("count"),
        "windowed_aov": _window_cols("aov"),
        "windowed_gmv": _window_cols("gmv"),
        "monthly_average": _score_col(scoring.AVG),
        "cohort_label": _score_col(scoring.COHORT),
        "magnitude_index": _score_col(scoring.MAGNITUDE),
        "days_since_last": _score_col(scoring.DAYS_SINCE),
        "days_between": _score_col(scoring.GAP),
        "drop_from_avg": _score_col(scoring.drop_col(MIDDAY)),
        "gmv_average": _score_col(scoring.GMV_AVG, True),
        "aov_average": _score_col(scoring.AOV_AVG, True),
        "sub_group_label": sub_group_label,
        "declining_filter": declining_filter,
        "test_arm": test_arm,
        "list_base": _list(lists.base_list, MIDDAY),
        "list_metro": _list(lists.metro_list, MIDDAY),
        "list_test": _list(lists.test_list, MIDDAY),
        "list_details": _list(lists.detail_list, MIDDAY),
        "list_base_midnight": _list(lists.base_list, MIDNIGHT),
        "list_metro_midnight": _list(lists.metro_list, MIDNIGHT),
        "list_test_midnight": _list(lists.test_list, MIDNIGHT),
        "list_details_midnight": _list(lists.detail_list, MIDNIGHT),
        "list_base_month_end": _list(lists.base_list, MONTH_END),
        "list_metro_month_end": _list(lists.metro_list, MONTH_END),
        "list_test_month_end": _list(lists.test_list, MONTH_END),
        "list_details_month_end": _list(lists.detail_list, MONTH_END),
        # the ids not broadcast: orders filtered by a bitmap, aggregated, joined exactly
        "list_base_shuffled": _base(MIDDAY, broadcast=False),
        # neither broadcast nor bitmap: all delivered orders aggregated, joined exactly
        "list_base_all_orders": _base(MIDDAY.replace(prefilter=False), broadcast=False),
        # ids first reduced to the customers with an order in the recency range
        "list_base_reduced": _base(MIDDAY.replace(orders_by_created_at=True)),
        "list_base_reduced_midnight": _base(MIDNIGHT.replace(orders_by_created_at=True)),
        "list_details_salted": list_details_salted,
        # from history kept between runs, which read one slice of the orders each
        "list_base_incremental": _incremental("base", MIDDAY),
        "list_base_midnight_incremental": _incremental("base", MIDNIGHT),
        "list_details_incremental": _incremental("details", MIDDAY),
        "order_lifetime_incremental": order_lifetime_incremental,
        "list_base_backfill": list_base_backfill,
        # NOT IN by a null-aware join, ids checked; ratios compared as whole numbers
        "elig_not_in": _not_in_ids,
        "list_base_checked": _base(MIDDAY.replace(customer_ids="checked")),
        "list_details_exact": _list(lists.detail_list, MIDDAY.replace(ratios="exact")),
        # orders stored in buckets by customer: aggregated without an exchange of orders
        "list_base_bucketed": _bucket_list(lambda d: lists.base_from(d, MIDDAY)),
        # the same with ids too many to broadcast, joined in the buckets
        "list_base_bucketed_join": _bucket_list(lambda d: lists.base_from(d, MIDDAY), broadcast=False),
        # three customers in the table of those with many orders
        "list_details_bucketed_hot": _bucket_list(
            lambda d: lists.details_from(d, MIDDAY), skew.ShufflePlan(hot=[(3, 4), (7, 2), (21, 3)]), with_value=True),
        "scores_zero_average": scores_zero_average,
        "all_lists_base": _of_all("base"),
        "all_lists_metro": _of_all("metro"),
        "all_lists_test": _of_all("test"),
        "all_lists_details": _of_all("details"),
    }
