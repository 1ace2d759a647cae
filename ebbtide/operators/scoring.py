"""Row-wise scores of each regular customer (no shuffle: narrow projections).

Ratios are doubles computed with ``try_divide``: the monthly average can be 0
(the only recent order may sit in the newest window when a month is shorter
than the 30-day window), and Spark's ANSI mode would raise before the later
filter drops such rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SegmentConfig
from ..functions.arith import adjacent_change, mean_of_present, ratio
from ..functions.dates import days_between, ntz
from .history import aov_col, count_col, gmv_col

AVG = "monthly_order_count_average"
COHORT = "cohort"
MAGNITUDE = "magnitude_index"
DAYS_SINCE = "days_since_last_transaction"
GAP = "avg_days_between_orders"
GMV_AVG = "monthly_GMV_average"
AOV_AVG = "monthly_AOV_average"


def drop_col(cfg: SegmentConfig) -> str:
    return f"{cfg.window_names[0]}_drop_from_avg"


def cohort(cfg: SegmentConfig, avg: Column | None = None) -> Column:
    lo, mid, hi = cfg.cohort_edges
    casual, core, power = cfg.cohort_names
    avg = F.col(AVG) if avg is None else avg
    # Averages under the lowest edge (and NULL) fall to the last cohort.
    return (
        F.when((avg >= lo) & (avg < mid), F.lit(casual))
        .when((avg >= mid) & (avg < hi), F.lit(core))
        .otherwise(F.lit(power))
    )


def score(history: DataFrame, cfg: SegmentConfig, with_value: bool = False, now: Column | None = None) -> DataFrame:
    """Add the average, cohort, magnitude, recency-gap and drop columns.

    The newest window is the observation; the others form the baseline, and
    the average divides by the number of observable (non-NULL) baseline
    windows. One projection: the average expression is reused and Catalyst
    evaluates it once per row (common subexpression elimination).
    """
    counts = [F.col(count_col(cfg, k)) for k in range(cfg.n_windows)]
    newest, baseline = counts[0], counts[1:]
    avg = mean_of_present(baseline)
    cols = [
        avg.alias(AVG),
        cohort(cfg, avg).alias(COHORT),
        ratio(adjacent_change(counts), avg).alias(MAGNITUDE),
        days_between(F.col("last_order_date"), ntz(cfg.as_of) if now is None else now).alias(DAYS_SINCE),
        ratio(F.lit(cfg.window_days), avg).alias(GAP),
        (avg - newest).alias(drop_col(cfg)),
    ]
    if with_value:
        # GMV and AOV are NULL (not 0) in a window without valued orders, so
        # they divide by the windows that have a value.
        gmv = [F.col(gmv_col(cfg, k)) for k in range(1, cfg.n_windows)]
        aov = [F.col(aov_col(cfg, k)) for k in range(1, cfg.n_windows)]
        cols += [mean_of_present(gmv).alias(GMV_AVG), mean_of_present(aov).alias(AOV_AVG)]
    return history.select("*", *cols)
