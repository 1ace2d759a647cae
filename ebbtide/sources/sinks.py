"""Writing the lists.

Each list carries its run date; writing partitions by it with dynamic
partition overwrite, so re-running a date replaces exactly that date and
leaves earlier runs alone (a retried or re-scheduled job is idempotent).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .versions import Versions, VersionTaken


def date_column(df: DataFrame) -> str:
    return "run_date" if "run_date" in df.columns else "date"


def write_list(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_column(df))
        .format(fmt)
        .save(path)
    )


def publish(out: dict[str, DataFrame], folder: str, run_date: str, fmt: str = "parquet") -> dict[str, str]:
    """Writes the lists of one run date and makes them visible all at once.

    Every list goes to a data folder that nothing points to; then one manifest
    (``sources.versions``) names them all. A run that dies before leaves every
    date's lists as they were; one that publishes a date again replaces the lists
    it made and no others. Two runs may publish at the same time.
    """
    spark = next(iter(out.values())).sparkSession
    versions = Versions(spark, folder)
    data = versions.new_data()
    written = {}
    for name, df in out.items():
        written[name] = f"{data}/{name}"
        df.write.format(fmt).save(written[name])
    while True:
        number, held = versions.current()
        dates = held.get("dates", {})
        try:
            versions.commit(number + 1, {"format": fmt, "dates": dates | {run_date: dates.get(run_date, {}) | written}})
            return written
        except VersionTaken:
            continue  # another run published meanwhile: add to what it left


def published(spark: SparkSession, folder: str, name: str, run_date: str | None = None) -> DataFrame:
    """A list as it was last published, of one run date or of all."""
    held = Versions(spark, folder).current()[1]
    paths = [p[name] for d, p in sorted(held.get("dates", {}).items()) if name in p and run_date in (None, d)]
    if not paths:
        raise LookupError(f"no list {name!r} is published in {folder}" + (f" for {run_date}" if run_date else ""))
    return spark.read.format(held["format"]).load(paths)


def write_table(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """Into a catalog table (created on first use): replaces the dates written, and only these."""
    spark = df.sparkSession
    by = date_column(df)
    ordered = df.select(*[c for c in df.columns if c != by], by)  # insertInto goes by position, partitions last
    if not spark.catalog.tableExists(table):
        ordered.limit(0).write.format(fmt).partitionBy(by).saveAsTable(table)
    known = spark.table(table).columns
    if known != ordered.columns:
        raise ValueError(f"{table} has columns {known}, not {ordered.columns}")
    # insertInto takes the mode from the session only, not from write options
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "dynamic")
    try:
        ordered.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)
