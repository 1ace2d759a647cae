"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


#: Folders made for local sessions that name none, by application.
_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Unset, a ``local[...]`` session gets a temporary folder of its own (tests,
    laptops); anywhere else that is an error, since executors would not share it.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    sc = spark.sparkContext
    if sc.master != "local" and not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _OWN:
        _OWN[sc.applicationId] = tempfile.mkdtemp(prefix="ebbtide-scratch-")
    return _OWN[sc.applicationId]


def new_path(spark: SparkSession, kind: str) -> str:
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def stored(df: DataFrame, kind: str = "table") -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again (cuts the lineage)."""
    spark = df.sparkSession
    path = new_path(spark, kind)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Deletes the files of a table made by ``stored`` that nothing reads any more."""
    jvm = df.sparkSession.sparkContext._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python workers, once a session."""
    sc = spark.sparkContext
    if getattr(sc, "_ebbtide_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(package)
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(package):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join(name, os.path.relpath(full, package)))
    path = os.path.join(tempfile.mkdtemp(prefix="ebbtide-code-"), f"{name}.zip")
    with open(path, "wb") as out:
        out.write(held.getvalue())
    sc.addPyFile(path)
    sc._ebbtide_shipped = True
