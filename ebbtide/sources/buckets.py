"""Orders stored in buckets by customer, so that no run has to shuffle them.

The rows of a customer lie in one bucket of a catalog table, and Spark knows it:
the aggregate by customer and the join with customer ids run where the rows are,
without an exchange of orders. The shuffle is paid once, when rows are stored, and
not by every run.

A customer with more rows than one task should hold would make one bucket large.
The orders of such customers (a ``ShufflePlan`` names them) go to a second table,
in buckets by customer and salt: their aggregate is in place too, and only its
few partial rows meet afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SegmentConfig
from ..operators import skew
from . import schemas
from .tables import Tables, conform

HOT = "_hot"


def _in_buckets(df: DataFrame, table: str, n: int, keys: list[str], path: str | None, mode: str) -> None:
    # dealt like the buckets: every task writes one file, of one bucket
    out = df.repartition(n, *keys).write.mode(mode).bucketBy(n, *keys).sortBy(*keys).format("parquet")
    (out.option("path", path) if path else out).saveAsTable(table)


def store_orders(orders: DataFrame, table: str, n_buckets: int, plan: skew.ShufflePlan | None = None,
                 path: str | None = None, append: bool = False) -> None:
    """Stores ``orders`` as ``table`` in ``n_buckets`` buckets, and those of the plan's hot customers as ``table`` + "_hot".

    ``append`` adds rows to both, with the buckets and the hot customers that they
    have: a plan is for the first call, and a customer never moves to the other table.
    Rows without a customer never match one; they are not stored.
    """
    spark = orders.sparkSession
    rows = conform(orders, schemas.ORDERS).filter(F.col("customer_id").isNotNull())
    mode = "append" if append else "errorifexists"
    if append:
        hot = spark.table(table + HOT).select("customer_id", "n_splits").distinct() if spark.catalog.tableExists(table + HOT) else None
    else:
        hot = spark.createDataFrame(plan.hot, skew.HOT_SCHEMA) if plan and plan.hot else None
    if hot is not None:
        # at most one customer for each target partition of rows: bounded, see skew
        marked = rows.join(F.broadcast(hot), "customer_id", "left")
        large = marked.filter("n_splits is not null").withColumn(skew.SALT, F.pmod(F.xxhash64("id"), F.col("n_splits")).cast("long"))
        _in_buckets(large, table + HOT, n_buckets, ["customer_id", skew.SALT], path and f"{path}{HOT}", mode)
        rows = marked.filter("n_splits is null").drop("n_splits")
    _in_buckets(rows, table, n_buckets, ["customer_id"], path, mode)


def load(spark: SparkSession, table: str, others: Tables) -> Tables:
    """``others`` with the stored orders in place of its own."""
    columns = [f.name for f in schemas.ORDERS.fields]
    hot = spark.table(table + HOT).select(*columns, skew.SALT) if spark.catalog.tableExists(table + HOT) else None
    return Tables(others.customers, spark.table(table).select(*columns), others.subscriptions, others.metros, in_buckets=True, hot_orders=hot)
