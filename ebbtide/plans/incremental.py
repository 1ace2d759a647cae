"""History kept between runs: a run reads only orders that it has not read.

The state under one folder (``sources.versions``) holds the mergeable results of
``operators.rollup`` for all delivered orders read so far, of every customer:

* ``days``: day rows, one data folder per calendar week;
* ``words``: seen order ids, in at most ``ID_FOLDERS`` folders by id range, so that
  orders with ids near each other meet few of them;
* ``totals``: one row per customer.

``advance`` aggregates the new rows once and merges them into what they touch: the
weeks in which they were created (late orders reach older ones), the id ranges of
their ids (an id seen before is not counted again, on whatever day or in whatever
slice it came) and the totals. Other folders are carried over by name. All of it
becomes visible in one commit; a run that dies before leaves the state as it was,
and a slice that is in already is not read a second time.

A list then reads the totals and the weeks of its windows (27 with the default
configuration), not the orders. Results equal a full pass over all rows
that were added. A row that leaves the delivered orders later (a cancellation after
delivery) is not taken back: build the state anew for that.
"""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SegmentConfig
from ..functions.dates import ntz
from ..operators import history, rollup, skew
from ..sources.tables import Tables
from ..sources.versions import Versions
from . import lists, strategy

ID_FOLDERS = 1024
#: Of these, as many as the first build's ids are spread over.
FIRST_ID_FOLDERS = 256
#: A folder's range is 2^14 words, a million ids, at least.
LEAST_ID_SHIFT = 14

DAYS = "customer_id bigint, day date, n bigint, n_valued bigint, value decimal(38,2)"
WORDS = "customer_id bigint, word bigint, mask bigint"
TOTALS = "customer_id bigint, first timestamp_ntz, last timestamp_ntz, n bigint"

#: Bytes of a stored row of any of the three, for the number of files.
ROW_BYTES = 24


@dataclass(frozen=True)
class State:
    """What one version of the state holds."""

    spark: SparkSession
    manifest: dict

    @property
    def slices(self) -> list[str]:
        return self.manifest.get("slices", [])

    def _read(self, schema: str, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def days(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """Day rows of the weeks that hold the days from ``first`` to ``last`` (ISO dates)."""
        held = self.manifest.get("days", {})
        first = _monday(first) if first else ""
        return self._read(DAYS, [p for d, p in sorted(held.items()) if first <= d and (last is None or d <= last)])

    def words(self, folders=None) -> DataFrame:
        """Seen order ids, of some id folders or all."""
        held = self.manifest.get("words", {})
        return self._read(WORDS, [p for k, p in sorted(held.items()) if folders is None or int(k) in folders])

    def totals(self) -> DataFrame:
        return self._read(TOTALS, [p for p in [self.manifest.get("totals")] if p])


def state(spark: SparkSession, folder: str) -> State:
    return State(spark, Versions(spark, folder).current()[1])


def _monday(day: str) -> str:
    date = dt.date.fromisoformat(day)
    return str(date - dt.timedelta(days=date.weekday()))


def _week() -> Column:
    return F.to_date(F.date_trunc("week", F.col("day")))


def _id_folder(shift: int) -> Column:
    return F.pmod(F.shiftright("word", shift), F.lit(ID_FOLDERS)).cast("int")


def _write(df: DataFrame, by: str, counts: dict, path: str, target: int) -> dict[str, str]:
    """Writes one folder per value of ``by`` and returns their paths; ``counts`` are rows
    of every value, which set the files of a folder."""
    files = max(1, math.ceil(max(counts.values()) * ROW_BYTES / target))
    total = max(1, math.ceil(sum(counts.values()) * ROW_BYTES / target))
    part = F.pmod(F.xxhash64("customer_id"), F.lit(files))
    # each value goes to at most ``files`` tasks, so files stay few and large
    held = df.withColumn("_by", F.col(by)).repartition(max(total, skew.shuffle_partitions(df.sparkSession)), "_by", part)
    held.write.partitionBy("_by").parquet(path)
    return {str(v): f"{path}/_by={v}" for v in counts}


def advance(spark: SparkSession, folder: str, rows: DataFrame, slice_name: str, cfg: SegmentConfig) -> State:
    """The state after adding ``rows`` (orders; undelivered ones and those without a customer are left out).

    ``slice_name`` names the rows: a slice that the state has is not added again.
    """
    versions = Versions(spark, folder)
    number, manifest = versions.current()
    held = State(spark, manifest)
    if slice_name in held.slices:
        return held
    new = history.delivered_orders(rows, cfg).filter(F.col("customer_id").isNotNull())
    # the one pass over the new orders
    parts, path = strategy.reliable(rollup.partials(new))
    data = versions.new_data()
    after = dict(manifest) | {"slices": [*held.slices, slice_name]}
    try:
        span = parts.agg(F.min("word").alias("a"), F.max("word").alias("b")).first()
        if "id_shift" not in after and span.a is not None:
            after["id_shift"] = max(LEAST_ID_SHIFT, ((span.b - span.a) // FIRST_ID_FOLDERS).bit_length())
        # weeks and id folders: bounded by the calendar and by ID_FOLDERS
        weeks = {str(r.k): r["count"] for r in parts.filter("day is not null").groupBy(_week().alias("k")).count().collect()}
        if weeks:
            touched = State(spark, {"days": {d: p for d, p in manifest.get("days", {}).items() if d in weeks}}).days()
            merged = rollup.day_rows(rollup.day_rows(parts).unionByName(touched)).withColumn("week", _week())
            sizes = _sum_counts(weeks, {str(r.k): r["count"] for r in touched.groupBy(_week().alias("k")).count().collect()})
            after["days"] = manifest.get("days", {}) | _write(merged, "week", sizes, f"{data}/days", cfg.target_partition_bytes)
        gains = []
        if span.a is not None:
            at = _id_folder(after["id_shift"])
            counts = {r.k: r["count"] for r in parts.filter("word is not null").groupBy(at.alias("k")).count().collect()}
            touched = held.words(counts)
            merged = rollup.merged_words(touched, rollup.id_words(parts)).withColumn("folder", at)
            sizes = _sum_counts(counts, {r.k: r["count"] for r in touched.groupBy(at.alias("k")).count().collect()})
            written = _write(merged, "folder", sizes, f"{data}/words", cfg.target_partition_bytes)
            after["words"] = manifest.get("words", {}) | written
            gained = spark.read.schema(WORDS + ", gained bigint").parquet(*written.values()).filter("gained > 0")
            gains = [rollup.totals(gained, "gained").selectExpr("customer_id", "cast(null as timestamp_ntz) as first", "cast(null as timestamp_ntz) as last", "n")]
        seen = parts.groupBy("customer_id").agg(F.min("first").alias("first"), F.max("last").alias("last")).withColumn("n", F.lit(0).cast("bigint"))
        rollup.merged_totals(held.totals(), seen, *gains).write.parquet(f"{data}/totals")
        after["totals"] = f"{data}/totals"
        versions.commit(number + 1, after)
    finally:
        strategy.discard(spark, path)
    return State(spark, after)


def _sum_counts(a: dict, b: dict) -> dict:
    return {k: n + b.get(k, 0) for k, n in a.items()}


def arrived(orders: DataFrame, since: str | None, until: str, by: str = "delivered_at") -> DataFrame:
    """Orders whose ``by`` lies in [since, until): a range pushed to the scan.

    ``by`` must never fall behind: a row that is added later has a later value. That
    holds for a load time, and for the delivery time where orders are loaded as they
    are delivered."""
    upto = orders.filter(F.col(by) < ntz(until))
    return upto if since is None else upto.filter(F.col(by) >= ntz(since))


def advance_until(spark: SparkSession, folder: str, orders: DataFrame, until: str, cfg: SegmentConfig, by: str = "delivered_at") -> State:
    """The state after adding the orders that arrived since it was last advanced, up to ``until``."""
    now = state(spark, folder)
    since = max((s.removeprefix("until ") for s in now.slices if s.startswith("until ")), default=None)
    until = str(dt.datetime.fromisoformat(until).isoformat(" ", "microseconds"))
    if since is not None and until <= since:
        return now
    return advance(spark, folder, arrived(orders, since, until, by), f"until {until}", cfg)


def customer_history(tables: Tables, held: State, cfg: SegmentConfig, with_value: bool = False, attrs: tuple[str, ...] = ()) -> DataFrame:
    """Order history of every eligible customer, from the state alone."""
    ids = lists.eligible(tables, cfg, *attrs)
    span = held.spark.range(1).select(*[c.cast("string") for c in rollup.days_needed(cfg)]).first()
    days = held.days(span[0], span[1])
    totals = held.totals()
    n_ids = strategy.bounded_count(tables, lists.candidates(tables, cfg), cfg)
    how, bits = strategy.orders_join(held.spark, cfg, n_ids)
    days, totals = (lists.reduced(x, ids, how, bits) for x in (days, totals))
    per_customer = rollup.history_of(totals, days, cfg, with_value)
    if how == "broadcast" and not attrs:
        return per_customer
    return per_customer.join(ids, "cid", "inner")


def declining_customers(tables: Tables, held: State, cfg: SegmentConfig, with_value: bool = False, attrs: tuple[str, ...] = ()) -> DataFrame:
    regular = history.regular(customer_history(tables, held, cfg, with_value, attrs), cfg)
    return lists.labelled(regular, cfg, with_value)


def wanted_lists(tables: Tables, held: State, cfg: SegmentConfig, wanted: tuple[str, ...] = lists.LISTS) -> tuple[dict[str, DataFrame], str]:
    """``lists.shared_pass`` from the state instead of the orders."""
    return lists.from_declining(tables, cfg, wanted, lambda with_value, attrs: declining_customers(tables, held, cfg, with_value, attrs))
