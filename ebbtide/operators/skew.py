"""Size the orders shuffle and split hot customers.

The orders aggregation is shuffled once by customer id. Two things can go
wrong at scale: the session's partition count may be far too small for the
volume, and one customer may hold a large share of all orders, landing in a
single task. Both follow from counts of orders per customer. A run observes
them on its own per-customer result (``Counts``) and saves the total and the
customers above one target partition beside its output, so that the next run
plans from them without reading orders twice; only a first run samples rows.
Hot keys are spread over several partitions by a hash of the order id; because
the split is a function of the order id, equal (customer, order id) pairs stay
together and the per-split distinct counts add up exactly. Results never depend
on the counts, only the task sizes do.

A hot key holds more than one target partition, so there are at most
(total bytes / target) of them, saved or sampled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import SegmentConfig

SALT = "salt"

HOT_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.LongType(), False),
        T.StructField("n_splits", T.IntegerType(), False),
    ]
)


@dataclass(frozen=True)
class ShufflePlan:
    """How to shuffle the rows: ``partitions`` is None to keep the session's
    (AQE-coalesced) count, else an explicit larger count."""

    partitions: int | None = None
    hot: list[tuple[int, int]] = field(default_factory=list)
    every: int = 1  # splits of every other key
    in_place: bool = False  # rows lie by key (and salt, if they have one) already

    @property
    def salted(self) -> bool:
        return bool(self.hot) or self.every > 1


def shuffle_partitions(spark: SparkSession) -> int:
    """Partitions a column repartition starts with in this session."""
    def number(key: str) -> int | None:
        raw = spark.conf.get(key, None)
        return int(raw) if raw and str(raw).strip().isdigit() else None

    adaptive = str(spark.conf.get("spark.sql.adaptive.enabled", "true")).lower() == "true"
    initial = number("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    return (initial if adaptive and initial else None) or number(
        "spark.sql.shuffle.partitions") or 200


def sample_counts(df: DataFrame, cfg: SegmentConfig, key: str = "customer_id") -> DataFrame:
    """(k, n): rows per key in a seeded sample of ``df`` (lazy)."""
    return (
        df.select(F.col(key).alias("k"))
        .sample(withReplacement=False, fraction=min(cfg.skew_sample_fraction, 1.0),
                seed=cfg.skew_seed)
        .groupBy("k")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def summary(counts: DataFrame, min_n: float = 0.0) -> DataFrame:
    """(total, k, n) rows: the sample total (total = true) and the keys with
    more than ``min_n`` sampled rows.

    Both parts read the same aggregation exchange, which Spark reuses; at most
    (sample total / min_n) keys leave the cluster.
    """
    top = counts.filter(F.col("n") > F.lit(min_n)).select(F.lit(False).alias("total"), "k", "n")
    total = counts.agg(F.sum("n").alias("n")).select(
        F.lit(True).alias("total"), F.lit(None).cast(counts.schema["k"].dataType).alias("k"),
        "n")
    return top.unionByName(total)


def plan_for(total: float, keys, cfg: SegmentConfig, session_partitions: int) -> ShufflePlan:
    """The plan for ``total`` rows of which ``keys`` gives (key, rows) of the large ones."""
    if not total:
        return ShufflePlan()
    target = cfg.target_partition_bytes
    parts = max(session_partitions, math.ceil(total * cfg.shuffle_row_bytes / target))
    sizes = [(int(k), n * cfg.shuffle_row_bytes) for k, n in keys if k is not None]
    hot = [(k, max(2, min(parts, math.ceil(b / target)))) for k, b in sizes if b > target]
    return ShufflePlan(parts if parts > session_partitions else None, hot)


def plan_from(rows, cfg: SegmentConfig, session_partitions: int) -> ShufflePlan:
    """Turn collected ``summary`` rows into a shuffle plan."""
    fraction = min(cfg.skew_sample_fraction, 1.0)
    total = sum(r["n"] or 0 for r in rows if r["total"]) / fraction
    keys = [(r["k"], r["n"] / fraction) for r in rows if not r["total"]]
    return plan_for(total, keys, cfg, session_partitions)


def plan_shuffle(df: DataFrame, cfg: SegmentConfig, key: str = "customer_id") -> ShufflePlan:
    """One small job over a sample of ``df``'s key column."""
    if cfg.skew_sample_fraction <= 0:
        return ShufflePlan()
    # A key can only be hot with more sampled rows than this (known up front).
    min_n = cfg.target_partition_bytes * min(cfg.skew_sample_fraction, 1.0) / cfg.shuffle_row_bytes
    rows = summary(sample_counts(df, cfg, key), min_n=min_n).collect()
    return plan_from(rows, cfg, shuffle_partitions(df.sparkSession))


class Counts:
    """Orders per customer as a run finds them: the total and the large customers.

    Observed on the run's own per-customer result, at no extra pass.
    """

    def __init__(self, cfg: SegmentConfig):
        self.cfg = cfg
        self.observation = Observation()

    def watch(self, history: DataFrame) -> DataFrame:
        n = F.col("total_orders_lifetime")
        large = n * F.lit(self.cfg.shuffle_row_bytes) > F.lit(self.cfg.target_partition_bytes)
        return history.observe(
            self.observation, F.sum(n).alias("total"),
            F.collect_list(F.when(large, F.struct(F.col("cid").alias("k"), n.alias("n")))).alias("large"))

    def save(self, spark: SparkSession, path: str) -> None:
        """After the action that computed the result: replaces what ``path`` holds."""
        got = self.observation.get
        rows = [(None, int(got["total"] or 0))] + [(int(r["k"]), int(r["n"])) for r in got["large"]]
        spark.createDataFrame(rows, "k bigint, n bigint").coalesce(1).write.mode("overwrite").parquet(path)


def saved_plan(spark: SparkSession, path: str, cfg: SegmentConfig) -> ShufflePlan | None:
    """The plan from counts saved under ``path``; None where no run has saved any."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    if not folder.getFileSystem(conf).exists(jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")):
        return None
    rows = spark.read.schema("k bigint, n bigint").parquet(path).collect()  # bounded, see above
    total = sum(r.n for r in rows if r.k is None)
    return plan_for(total, [(r.k, r.n) for r in rows], cfg, shuffle_partitions(spark))


def with_salt(df: DataFrame, plan: ShufflePlan, split_by: str = "id",
              key: str = "customer_id") -> DataFrame:
    """Add ``salt``: hash(split_by) mod the key's number of splits. The hot
    list is bounded (see the module), so it is broadcast."""
    bucket = lambda n: F.pmod(F.xxhash64(F.col(split_by)), n).cast("long")
    every = F.lit(plan.every).cast("int")
    if not plan.hot:
        return df.withColumn(SALT, bucket(every))
    hot_df = df.sparkSession.createDataFrame(plan.hot, HOT_SCHEMA).withColumnRenamed("customer_id", key)
    return (
        df.join(F.broadcast(hot_df), key, "left")
        .withColumn(SALT, bucket(F.coalesce(F.col("n_splits"), every)))
        .drop("n_splits")
    )
