"""Mergeable partial results of the order history.

A full pass aggregates raw order rows, because the exact distinct count of order
ids cannot be merged from counts. These partial results can be merged, in any
order and any number of steps, so history that was read once need not be read
again:

* day rows, per customer and calendar day of ``created_at``: rows, rows with a
  value, and the value. All windows go by calendar days, so they are sums of day
  rows for every ``as_of``.
* id words, per customer and 64 consecutive order ids: a bitmap of the ids seen.
  Bitmaps merge with ``bit_or``; the distinct count is the number of set bits. A
  word takes 16 bytes whether it holds one id or 64, against 4 KB of Spark's
  ``bitmap_construct_agg`` per 32,768 ids, which a customer's few orders never fill.
* totals, per customer: first and last order time and the distinct count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SegmentConfig
from ..functions.dates import ntz
from . import history

WORD_BITS = 6


def _word(order_id: Column) -> Column:
    return F.shiftright(order_id, WORD_BITS)


def _bit(order_id: Column) -> Column:
    place = order_id.bitwiseAND((1 << WORD_BITS) - 1).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def partials(delivered: DataFrame) -> DataFrame:
    """(customer_id, day, word, mask, n, n_valued, value, first, last): delivered
    orders at the grain from which the three partial results follow."""
    rows = delivered.select("customer_id", F.to_date("created_at").alias("day"), _word(F.col("id")).alias("word"),
                            _bit(F.col("id")).alias("bit"), "created_at", "actual_subtotal")
    return rows.groupBy("customer_id", "day", "word").agg(
        F.bit_or("bit").alias("mask"),
        F.count(F.lit(1)).alias("n"),
        F.count("actual_subtotal").alias("n_valued"),
        F.sum("actual_subtotal").cast("decimal(38,2)").alias("value"),
        F.min("created_at").alias("first"),
        F.max("created_at").alias("last"),
    )


def day_rows(parts: DataFrame) -> DataFrame:
    """(customer_id, day, n, n_valued, value) from partials or from day rows."""
    return parts.filter("day is not null").groupBy("customer_id", "day").agg(
        F.sum("n").alias("n"), F.sum("n_valued").alias("n_valued"), F.sum("value").cast("decimal(38,2)").alias("value"))


def id_words(parts: DataFrame) -> DataFrame:
    """(customer_id, word, mask) from partials or from id words."""
    return parts.filter("word is not null").groupBy("customer_id", "word").agg(F.bit_or("mask").alias("mask"))


def merged_words(old: DataFrame, new: DataFrame) -> DataFrame:
    """Id words of both, with ``gained``: how many ids of a word only ``new`` has."""
    both = old.select("customer_id", "word", "mask", F.col("mask").alias("before")).unionByName(
        new.select("customer_id", "word", "mask", F.lit(None).cast("bigint").alias("before")))
    merged = both.groupBy("customer_id", "word").agg(F.bit_or("mask").alias("mask"), F.bit_or("before").alias("before"))
    gained = F.bit_count("mask") - F.coalesce(F.bit_count("before"), F.lit(0))
    return merged.select("customer_id", "word", "mask", gained.cast("long").alias("gained"))


def totals(words: DataFrame, count: str | None = None) -> DataFrame:
    """(customer_id, n): distinct order ids per customer; ``count`` names a column to add up instead of the set bits."""
    n = F.col(count) if count else F.bit_count("mask").cast("long")
    return words.groupBy("customer_id").agg(F.sum(n).alias("n"))


def merged_totals(*parts: DataFrame) -> DataFrame:
    """(customer_id, first, last, n) of totals over disjoint sets of ids."""
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both.groupBy("customer_id").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"))


def days_needed(cfg: SegmentConfig, now: Column | None = None) -> tuple[Column, Column]:
    """The first and the last calendar day that a window or the recency range may hold."""
    e = history.edges(cfg, now)
    return (F.to_date(F.least(e.recency[0], *[lo for lo, _ in e.windows])),
            F.to_date(F.greatest(e.recency[1], *[hi for _, hi in e.windows])))


def window_sums(days: DataFrame, cfg: SegmentConfig, with_value: bool = False, now: str | None = None) -> DataFrame:
    """(customer_id, _rec, _c0.., [_v0.., _m0..]) from day rows, combined map-side.

    ``now`` names a column of run times to group by as well."""
    clock = F.col(now) if now else None
    e = history.edges(cfg, clock)
    at = F.col("day").cast("timestamp_ntz")
    aggs = [F.sum(F.when(at.between(*e.recency), F.col("n"))).alias("_rec")]
    for k, (lo, hi) in enumerate(e.windows):
        inside = at.between(lo, hi)
        aggs.append(F.sum(F.when(inside, F.col("n"))).alias(f"_c{k}"))
        if with_value:
            aggs.append(F.sum(F.when(inside, F.col("value"))).alias(f"_v{k}"))
            aggs.append(F.sum(F.when(inside, F.col("n_valued"))).alias(f"_m{k}"))
    keys = ["customer_id"] + ([now] if now else [])
    return days.filter(F.col("day").between(*days_needed(cfg, clock))).groupBy(*keys).agg(*aggs)


def at_each(days: DataFrame, cfg: SegmentConfig, times: list[str], name: str = "now") -> DataFrame:
    """Each row of ``days`` once for every run time whose windows may hold its day."""
    known = F.array(*[ntz(t) for t in times])
    held = F.filter(known, lambda t: F.col("day").between(*days_needed(cfg, t)))
    return days.withColumn(name, F.explode(held))


def history_of(totals_: DataFrame, days: DataFrame, cfg: SegmentConfig, with_value: bool = False) -> DataFrame:
    """The order history (as ``history.order_history`` gives it) of every customer in ``totals_``."""
    sums = window_sums(days, cfg, with_value)
    none = [c for c in sums.columns if c.startswith(("_rec", "_c"))]
    joined = totals_.withColumnsRenamed({"first": "_first", "last": "_last", "n": "_n"}).join(sums, "customer_id", "left")
    return history.finish(joined.fillna(0, none), cfg, with_value)
