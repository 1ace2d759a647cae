"""Which customers may be listed at all (one row per customer id).

All predicates are plain Column expressions on the customers scan, so
Catalyst pushes the null tests and the signup range into the Parquet reader.
The exclusion "id NOT IN (customers that look like businesses)" reads the same
table, so for a unique, non-NULL id it is a row predicate: no anti-join and
no second scan of customers. That is the default, for tables that declare their
key. With ``customer_ids="checked"`` nothing is assumed: NOT IN is a null-aware
anti-join (``not_in``), so that a NULL id among the excluded empties the result as
SQL demands, and an id that two eligible rows have stops the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SegmentConfig
from ..functions.dates import calendar_day_range
from .not_in import not_in, unique


def signup_in_range(cfg: SegmentConfig) -> Column:
    """Signup date within the closed date range (pushable form)."""
    return calendar_day_range(F.col("created_at"), cfg.signup_from, cfg.signup_to)


def not_deleted() -> Column:
    return F.col("deleted_at").isNull()


def payment_matches(cfg: SegmentConfig) -> Column:
    """SQL LIKE: '_' is a one-character wildcard, so '%cus_%' also takes 'cusX1'."""
    return F.col("stripe_customer_id").like(cfg.payment_pattern)


def looks_like_business(cfg: SegmentConfig) -> Column:
    """Case-folded name or type match; NULL when the inputs are NULL."""
    return F.lower(F.col("name")).isin(*cfg.excluded_names) | F.lower(
        F.col("customer_type")
    ).isin(*cfg.excluded_types)


def not_excluded(cfg: SegmentConfig) -> Column:
    """NOT IN over the same table: a NULL name/type keeps the customer."""
    return ~F.coalesce(looks_like_business(cfg), F.lit(False))


def excluded_ids(customers: DataFrame, cfg: SegmentConfig) -> DataFrame:
    """The subquery of NOT IN: ids, NULL ones too, of customers that look like businesses."""
    return customers.filter(looks_like_business(cfg)).select("id")


def customer_filter(cfg: SegmentConfig) -> Column:
    return signup_in_range(cfg) & not_deleted() & payment_matches(cfg) & not_excluded(cfg)


def passing(customers: DataFrame, cfg: SegmentConfig) -> DataFrame:
    """Customers that pass all tests of their own row and the exclusion."""
    if cfg.customer_ids == "unique":
        return customers.filter(customer_filter(cfg))
    rows = customers.filter(signup_in_range(cfg) & not_deleted() & payment_matches(cfg))
    return not_in(rows, "id", excluded_ids(customers, cfg))


def active_subscription() -> Column:
    return (
        F.col("deleted_at").isNull()
        & F.col("trial_abandon_time").isNull()
        & F.col("churn_payment_time").isNull()
    )


def active_subscribers(subscriptions: DataFrame, cfg: SegmentConfig) -> DataFrame:
    """Distinct customer ids with at least one active subscription row.

    The distinct is aggregated map-side first, so a customer holding a huge
    share of subscription rows reaches the shuffle as one row per task.
    """
    return (
        subscriptions.filter(F.col("origination").isin(*cfg.origins) & active_subscription())
        .select(F.col("customer_id").alias("cid"))
        .distinct()
    )


def eligible_customers(customers: DataFrame, subscriptions: DataFrame,
                       cfg: SegmentConfig, *attrs: str) -> DataFrame:
    """``cid`` (and ``attrs``) of every customer passing all eligibility tests.

    A customer with several active subscription rows appears once (semi-join);
    the joined variant would multiply only the recency count, which is only
    ever tested for >= 1, so every list is unchanged.
    """
    base = passing(customers, cfg).select(F.col("id").alias("cid"), *attrs)
    if cfg.customer_ids == "checked":
        # a NULL id matches no order and no subscription
        base = unique(base.filter("cid is not null"), "cid")
    return base.join(active_subscribers(subscriptions, cfg), "cid", "left_semi")
