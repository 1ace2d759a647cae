"""Physical choices that depend on measured sizes, not on estimates."""

from __future__ import annotations

import os
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SegmentConfig
from ..operators import semijoin, skew
from ..sources.tables import Tables

DEFAULT_BROADCAST_BYTES = 10 * 1024 * 1024


def broadcast_budget(spark: SparkSession, cfg: SegmentConfig) -> int:
    """Bytes a broadcast side may take: the config value, else the session's
    auto-broadcast threshold (<= 0 disables broadcasting)."""
    if cfg.broadcast_max_bytes is not None:
        return cfg.broadcast_max_bytes
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", str(DEFAULT_BROADCAST_BYTES))
    raw = raw.strip().lower()
    units = {"b": 1} | {u + b: 1024**n for n, u in enumerate("kmgtp", 1) for b in ("", "b")}
    for suffix in sorted(units, key=len, reverse=True):
        if raw.endswith(suffix):
            return int(float(raw[: -len(suffix)]) * units[suffix])
    return int(raw)


def fits_broadcast(df: DataFrame, cfg: SegmentConfig, row_bytes: int | None = None) -> bool:
    """Count ``df`` (an action) and compare rows x bytes/row with the budget."""
    budget = broadcast_budget(df.sparkSession, cfg)
    if budget <= 0:
        return False
    rows = df.count()
    return rows * (row_bytes or cfg.broadcast_row_bytes) <= budget


def bounded_count(tables: Tables, some: DataFrame, cfg: SegmentConfig) -> int:
    """A bound on the rows of ``some``, filtered customers: the plain count of
    customers where that settles the broadcast, else the count of ``some``."""
    n = tables.n_customers
    if n * cfg.broadcast_row_bytes <= broadcast_budget(some.sparkSession, cfg):
        return n
    return some.count()


def probe_orders_pass(tables: Tables, some: DataFrame, delivered: DataFrame, cfg: SegmentConfig,
                      plan: skew.ShufflePlan | None = None) -> tuple[int, skew.ShufflePlan]:
    """Measure what the orders-pass plan depends on: (id count, shuffle plan).

    ``some`` of the customers is a superset of the broadcast candidate. With a
    ``plan`` (from saved counts) only ids are counted. Without one, on a first
    run, a sample of delivered orders sizes the shuffle and finds hot customers
    in a second, concurrent job; it reads the key column of all orders.
    """
    if plan is not None:
        return bounded_count(tables, some, cfg), plan
    # Threads inherit the caller's job group / scheduler pool, so the probe
    # is cancelled and accounted together with the job that needs it.
    inherit = inheritable_thread_target(some.sparkSession)
    with ThreadPoolExecutor(max_workers=2) as pool:
        count = pool.submit(inherit(bounded_count), tables, some, cfg)
        shuffle = pool.submit(inherit(skew.plan_shuffle), delivered, cfg)
        return count.result(), shuffle.result()


def orders_join(spark: SparkSession, cfg: SegmentConfig, n_ids: int,
                broadcast: bool | None = None) -> tuple[str, int]:
    """How orders meet the eligible ids: ("broadcast", 0) when ``n_ids`` ids
    fit the budget; else ("bitmap", blocks) for a map-side prefilter sized by
    ``n_ids``, whose broadcast is bounded by ``cfg.bitmap_max_bytes``; else ("none", 0), also
    where the session forbids broadcasts. ``broadcast`` True/False forces or
    forbids the exact broadcast."""
    budget = broadcast_budget(spark, cfg)
    if broadcast is None:
        broadcast = budget > 0 and n_ids * cfg.broadcast_row_bytes <= budget
    if broadcast:
        return "broadcast", 0
    blocks = semijoin.n_blocks(n_ids, max(cfg.bitmap_max_bytes, 0))
    if cfg.prefilter and blocks > 0 and budget > 0:
        return "bitmap", blocks
    return "none", 0


def bounded_broadcast(df: DataFrame, cfg: SegmentConfig, row_bytes: int = 128) -> DataFrame:
    """``broadcast(df)`` if its counted size fits, else ``df`` unchanged so
    Spark plans a shuffled join."""
    return F.broadcast(df) if fits_broadcast(df, cfg, row_bytes) else df


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for what a run keeps between its jobs.

    Uses the SparkContext's directory or ``spark.checkpoint.dir``; only a
    local-mode session (tests, a laptop) without either gets a fresh
    temporary folder -- a cluster must name a shared one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        # local[...] runs its tasks in this process; local-cluster[...] does not
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on the cluster")
        conf = tempfile.mkdtemp(prefix="ebbtide-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf)
    return conf


def reliable(df: DataFrame) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder and read it again: cuts its lineage,
    so later jobs re-read it instead of recomputing the orders pass (and
    survive the loss of the executors that computed it). Returns the table
    and its path, for ``discard``."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a table that ``reliable`` wrote."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
