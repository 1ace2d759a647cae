"""Schemas of the four input tables (only the columns the segmentation uses)."""

from __future__ import annotations

from pyspark.sql import types as T

CUSTOMERS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("created_at", T.TimestampNTZType(), True),
        T.StructField("deleted_at", T.TimestampNTZType(), True),
        T.StructField("stripe_customer_id", T.StringType(), True),
        T.StructField("name", T.StringType(), True),
        T.StructField("customer_type", T.StringType(), True),
        T.StructField("metro_id", T.LongType(), True),
        # not an integer: a bucket between the arms' ranges must stay in none
        T.StructField("bucket_number", T.DoubleType(), True),
    ]
)

ORDERS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("customer_id", T.LongType(), True),
        T.StructField("created_at", T.TimestampNTZType(), True),
        T.StructField("delivered_at", T.TimestampNTZType(), True),
        T.StructField("status", T.StringType(), True),
        T.StructField("actual_subtotal", T.DecimalType(18, 2), True),
    ]
)

SUBSCRIPTIONS = T.StructType(
    [
        T.StructField("customer_id", T.LongType(), True),
        T.StructField("origination", T.StringType(), True),
        T.StructField("deleted_at", T.TimestampNTZType(), True),
        T.StructField("trial_abandon_time", T.TimestampNTZType(), True),
        T.StructField("churn_payment_time", T.TimestampNTZType(), True),
    ]
)

METROS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("name", T.StringType(), True),
    ]
)

BY_NAME = {
    "customers": CUSTOMERS,
    "orders": ORDERS,
    "subscription_base": SUBSCRIPTIONS,
    "metros": METROS,
}
