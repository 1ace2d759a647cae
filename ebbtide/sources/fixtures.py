"""Derive the four input tables from the driver's generated test data.

The generated tables (``events``, ``customer``, ``nation``) carry no
customer/order/subscription columns, so they are mapped with plain column
expressions (the same mapping is written in SQL in ``ebbtide.oracle``).
Event time is stretched seven-fold so that 30-day windows hold enough
orders while every fixed value of the segmentation stays as it is.
Everything here is a lazy projection of the scans: it partitions, prunes and
grows exactly like the generated tables do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import ntz
from .tables import Tables

# Fixed values of the test-data mapping.
EVENT_EPOCH = "2024-01-01 00:00:00"
ORDER_EPOCH = "2020-01-17 00:00:00"
TIME_STRETCH = 7
SIGNUP_BASE = "2019-01-01"
CUSTOMER_DELETED = "2020-01-01 00:00:00"
SUBSCRIPTION_EVENT = "2020-02-01 00:00:00"
UNKNOWN_METRO = 100
#: Delivery times that part the orders into slices read one after the other.
ARRIVAL_EDGES = ("2024-01-11 00:00:00", "2024-01-21 06:30:00", "2024-02-01 00:00:00")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _mod(c: Column, m: int) -> Column:
    return c % F.lit(m)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _read(spark, sf_dir, "events")
    k = F.col("user_id") * 2 + _mod(F.col("event_id"), 2)
    kk = _mod(k, 3)
    delivered = (
        ((kk == 0) & F.col("event_type").isin("purchase", "click"))
        | ((kk == 1) & (F.col("event_type") != "error"))
        | (kk == 2)
    )
    micros = F.timestamp_diff("MICROSECOND", ntz(EVENT_EPOCH), F.col("ts"))
    return ev.select(
        F.col("event_id").alias("id"),
        k.alias("customer_id"),
        F.timestamp_add("MICROSECOND", micros * TIME_STRETCH, ntz(ORDER_EPOCH)).alias("created_at"),
        F.when(_mod(F.col("event_id"), 41) != 0, F.col("ts")).alias("delivered_at"),
        F.when(delivered, F.lit("delivered")).otherwise(F.lit("cancelled")).alias("status"),
        F.when(_mod(F.col("event_id"), 11) != 0, F.col("value").cast("decimal(18,2)")).alias(
            "actual_subtotal"
        ),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = _read(spark, sf_dir, "customer")
    c = F.col("c_custkey")
    key = c.cast("string")
    name = (
        F.when(_mod(c, 50) == 10, F.lit("Business Customer"))
        .when(_mod(c, 50) == 11, F.lit("ActionLink Vendor"))
        .when(_mod(c, 50) == 14, F.lit(None).cast("string"))
        .otherwise(F.col("c_name"))
    )
    ctype = (
        F.when(_mod(c, 20) == 2, F.lit("BUSINESS"))
        .when(_mod(c, 20) == 3, F.lit(None).cast("string"))
        .otherwise(F.lit("consumer"))
    )
    payment = (
        F.when(_mod(c, 29) == 5, F.concat(F.lit("tok_"), key))
        .when(_mod(c, 31) == 6, F.lit(None).cast("string"))
        .when(_mod(c, 37) == 7, F.concat(F.lit("cusX"), key))
        .otherwise(F.concat(F.lit("cus_"), key))
    )
    signup = F.date_add(F.lit(SIGNUP_BASE).cast("date"), _mod(c * 37, 450).cast("int"))
    return cu.select(
        c.alias("id"),
        signup.cast("timestamp_ntz").alias("created_at"),
        F.when(_mod(c, 23) == 1, ntz(CUSTOMER_DELETED)).alias("deleted_at"),
        payment.alias("stripe_customer_id"),
        name.alias("name"),
        ctype.alias("customer_type"),
        F.when(_mod(c, 19) == 4, F.lit(None))
        .when(_mod(c, 11) == 7, _mod(c, 5) + UNKNOWN_METRO)
        .otherwise(F.col("c_nationkey")).cast("long").alias("metro_id"),
        _mod(c, 104).cast("int").alias("bucket_number"),
    )


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = _read(spark, sf_dir, "customer")
    c = F.col("c_custkey")
    when_event = lambda m, r: F.when(_mod(c, m) == r, ntz(SUBSCRIPTION_EVENT))
    first = cu.select(
        c.alias("customer_id"),
        F.when(_mod(c, 13) == 8, F.lit("gift"))
        .when(_mod(c, 5) == 1, F.lit("whitelabel"))
        .otherwise(F.lit("platform")).alias("origination"),
        when_event(17, 3).alias("deleted_at"),
        when_event(43, 9).alias("trial_abandon_time"),
        when_event(47, 12).alias("churn_payment_time"),
    )
    none = F.lit(None).cast("timestamp_ntz")
    second = cu.filter(_mod(c, 3) == 0).select(
        c.alias("customer_id"),
        F.lit("marketplace").alias("origination"),
        none.alias("deleted_at"),
        none.alias("trial_abandon_time"),
        none.alias("churn_payment_time"),
    )
    return first.unionByName(second)


def metros(spark: SparkSession, sf_dir: str) -> DataFrame:
    na = _read(spark, sf_dir, "nation")
    return na.select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"))


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(
        customers=customers(spark, sf_dir),
        orders=orders(spark, sf_dir),
        subscriptions=subscriptions(spark, sf_dir),
        metros=metros(spark, sf_dir),
    )
