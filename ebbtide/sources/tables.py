"""The four input relations as one value, and a loader for real tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas


@dataclass(frozen=True)
class Tables:
    """Lazy DataFrames of the inputs; nothing is read until an action."""

    customers: DataFrame
    orders: DataFrame
    subscriptions: DataFrame
    metros: DataFrame
    #: Whether orders lie in buckets by customer, and the orders kept apart from
    #: them, in buckets by customer and salt (see ``sources.buckets``).
    in_buckets: bool = False
    hot_orders: DataFrame | None = None

    @cached_property
    def n_customers(self) -> int:
        """Rows of customers (for Parquet read off the footers), counted once for all lists of a run."""
        return self.customers.count()


def conform(df: DataFrame, schema) -> DataFrame:
    """Select exactly the schema's columns, cast to its types.

    Casts are no-ops when the stored type already matches, so Catalyst still
    prunes columns and pushes filters to the Parquet scan.
    """
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def read_table(spark: SparkSession, path: str, name: str, fmt: str = "parquet") -> DataFrame:
    return conform(spark.read.format(fmt).load(path), schemas.BY_NAME[name])


def load(
    spark: SparkSession,
    customers: str,
    orders: str,
    subscriptions: str,
    metros: str,
    fmt: str = "parquet",
) -> Tables:
    """Tables from four storage paths (any format Spark reads; Parquet by default)."""
    return Tables(
        customers=read_table(spark, customers, "customers", fmt),
        orders=read_table(spark, orders, "orders", fmt),
        subscriptions=read_table(spark, subscriptions, "subscription_base", fmt),
        metros=read_table(spark, metros, "metros", fmt),
    )


def from_catalog(spark: SparkSession, customers: str, orders: str,
                 subscriptions: str, metros: str) -> Tables:
    """Tables from catalog names (e.g. ``db.orders``)."""
    return Tables(
        customers=conform(spark.table(customers), schemas.CUSTOMERS),
        orders=conform(spark.table(orders), schemas.ORDERS),
        subscriptions=conform(spark.table(subscriptions), schemas.SUBSCRIPTIONS),
        metros=conform(spark.table(metros), schemas.METROS),
    )
