"""Session settings the plans are written for.

``tune`` sets runtime SQL options only (safe on an existing cluster session; its
time zone stays, timestamps are NTZ throughout);
``local_session`` is for tests, benchmarks and laptops.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

RUNTIME = {
    # Re-plan at stage boundaries: coalesce small shuffle partitions, split
    # skewed join partitions, switch to broadcast when a side turns out small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME.items():
        spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  scratch: str | None = None) -> SparkSession:
    """A local session with the UI off and a scratch checkpoint folder."""
    scratch = scratch or tempfile.mkdtemp(prefix="ebbtide-", dir=os.environ.get("TMPDIR", "/tmp"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ebbtide")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("EBBTIDE_DRIVER_MEMORY", "8g"))
        .config("spark.local.dir", scratch)
        .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoints"))
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        # Static: skip the per-Column Python call-site capture (several Py4J
        # round trips and a stack walk per expression node) that only serves
        # error messages; plan building is otherwise most of a small job.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for k, v in RUNTIME.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
