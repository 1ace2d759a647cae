"""Every threshold, label and name of the segmentation in one frozen object.

The defaults are the fixed values of the segmentation we reproduce; change
them only through ``SegmentConfig(...)`` / ``dataclasses.replace``.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must equal the original segmentation for identical results)
# ---------------------------------------------------------------------------
SIGNUP_FROM = "2019-01-01"
SIGNUP_TO = "2020-03-01"
PAYMENT_PATTERN = "%cus_%"
DELIVERED_STATUS = "delivered"
ORIGINS = ("marketplace", "platform", "whitelabel")
EXCLUDED_NAMES = ("business customer", "actionlink vendor")
EXCLUDED_TYPES = ("business",)
RECENCY_MONTHS = (3, 1)  # orders dated between now-3 months and now-1 month
MIN_ORDERS = 5
MIN_RECENT = 1
TENURE_MONTHS = 4
WINDOW_DAYS = 30
WINDOW_NAMES = (
    "past_30days",
    "past_31_60days",
    "past_61_90days",
    "past_91_120days",
    "past_121_150days",
    "past_151_180days",
)
COHORT_EDGES = (1.0, 2.5, 4.5)  # casual from 1, core from 2.5, power from 4.5
COHORT_NAMES = ("casual", "core", "power")
STOPPER_FACTORS = (1.5, 2.25, 2.5)  # casual, core, power
MAGNITUDE_CUTS = (None, 3.0, 2.0)  # casual has no regular/erratic split
MIN_AVERAGE = 1.0
DROP_RATIO = 0.75
LABEL_CASUAL_STOPPER = "Casual Stopper"
LABEL_CORE_STOPPER = "Core Stopper"
LABEL_POWER_STOPPER = "Power Stopper"
LABEL_CASUAL_DECREASER = "Casual Decreaser"
LABEL_REGULAR_CORE_DECREASER = "Regular Core Decreaser"
LABEL_ERRATIC_CORE_DECREASER = "Erratic Core Decreaser"
LABEL_REGULAR_POWER_DECREASER = "Regular Power Decreaser"
LABEL_ERRATIC_POWER_DECREASER = "Erratic Power Decreaser"
LABEL_OTHER = "Other"
ARM_CONTROL = (1, 50, "20200814_20200914_ReEngagementIncentiveTest1_CohortB_Control")
ARM_INCENTIVE = (51, 100, "20200814_20200914_ReEngagementIncentiveTest1_CohortA_Incentive10off3orders")
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Arm:
    lo: int
    hi: int
    label: str


@dataclass(frozen=True)
class SegmentConfig:
    """Parameters of one run. ``as_of`` replaces the warehouse clock."""

    as_of: str  # 'YYYY-MM-DD HH:MM:SS[.ffffff]', read as TIMESTAMP_NTZ
    signup_from: str = SIGNUP_FROM
    signup_to: str = SIGNUP_TO
    payment_pattern: str = PAYMENT_PATTERN
    delivered_status: str = DELIVERED_STATUS
    origins: tuple[str, ...] = ORIGINS
    excluded_names: tuple[str, ...] = EXCLUDED_NAMES
    excluded_types: tuple[str, ...] = EXCLUDED_TYPES
    recency_months: tuple[int, int] = RECENCY_MONTHS
    min_orders: int = MIN_ORDERS
    min_recent: int = MIN_RECENT
    tenure_months: int = TENURE_MONTHS
    window_days: int = WINDOW_DAYS
    window_names: tuple[str, ...] = WINDOW_NAMES
    cohort_edges: tuple[float, float, float] = COHORT_EDGES
    cohort_names: tuple[str, str, str] = COHORT_NAMES
    stopper_factors: tuple[float, float, float] = STOPPER_FACTORS
    magnitude_cuts: tuple[float | None, float | None, float | None] = MAGNITUDE_CUTS
    min_average: float = MIN_AVERAGE
    drop_ratio: float = DROP_RATIO
    stopper_labels: tuple[str, str, str] = (
        LABEL_CASUAL_STOPPER, LABEL_CORE_STOPPER, LABEL_POWER_STOPPER)
    # Per cohort: one decreaser label, or (regular, erratic) split by magnitude.
    decreaser_labels: tuple[tuple[str, ...], ...] = (
        (LABEL_CASUAL_DECREASER,),
        (LABEL_REGULAR_CORE_DECREASER, LABEL_ERRATIC_CORE_DECREASER),
        (LABEL_REGULAR_POWER_DECREASER, LABEL_ERRATIC_POWER_DECREASER),
    )
    other_label: str = LABEL_OTHER
    arms: tuple[Arm, ...] = field(
        default_factory=lambda: (Arm(*ARM_CONTROL), Arm(*ARM_INCENTIVE))
    )

    # Customer ids: "unique" states that the table's id is a non-NULL key;
    # "checked" evaluates NOT IN by a null-aware join and raises on an id that
    # two eligible customers have.
    customer_ids: str = "unique"
    # Comparisons of ratios: "double" divides first, as written; "exact" compares
    # the cross-multiplied whole numbers, so that ties are ties.
    ratios: str = "double"

    # --- execution knobs (do not change results) ---------------------------
    # Broadcast the eligible-customer side of the orders join only when its
    # counted size stays under this many bytes; None = the session's
    # spark.sql.autoBroadcastJoinThreshold.
    broadcast_max_bytes: int | None = None
    # Bytes per broadcast row of a long-keyed hash relation (measured dataSize: 83.9).
    broadcast_row_bytes: int = 84
    # Beyond the budget, filter orders map-side with a blocked bitmap of the
    # eligible ids, sized from their count (12 bits an id: under 1% of other ids
    # pass) up to bitmap_max_bytes, enough for 21M ids; beyond, more pass.
    prefilter: bool = True
    bitmap_max_bytes: int = 64 * 1024 * 1024
    # Measured bytes a row of the plain bitmap (semijoin.bitmap).
    bitmap_row_bytes: int = 40
    # Layout of orders: True where files are laid out by created_at. Then the
    # customers with an order in the recency range, read through a pushed
    # range that prunes files, reduce the ids that the orders pass keeps.
    # Off when min_recent < 1, where lapsed customers may be listed too.
    orders_by_created_at: bool = False
    # Fraction of delivered orders that a first run samples to size the orders
    # shuffle and to find hot customer ids; 0 turns both off (session
    # partitions, no salt). Later runs use the counts that a run saved.
    # A key matters once it fills a target partition (~2.8M rows of 48 B), so
    # 0.1% still samples ~2,800 of its rows.
    skew_sample_fraction: float = 0.001
    skew_seed: int = 17
    # Shuffled bytes one task should hold; a customer whose orders exceed it
    # is split over several partitions by order id, and the shuffle gets
    # more partitions than the session's when the volume needs them.
    target_partition_bytes: int = 128 * 1024 * 1024
    # Estimated bytes of one shuffled order row (ids, timestamp, value).
    shuffle_row_bytes: int = 48

    def __post_init__(self):
        # Fail fast on a malformed clock instead of a NULL/ANSI cast error later.
        dt.datetime.fromisoformat(self.as_of)
        if self.customer_ids not in ("unique", "checked"):
            raise ValueError("customer_ids is 'unique' or 'checked'")
        if self.ratios not in ("double", "exact"):
            raise ValueError("ratios is 'double' or 'exact'")
        if self.target_partition_bytes <= 0:
            raise ValueError("target_partition_bytes must be positive")
        if len(self.window_names) < 2:
            raise ValueError("need the newest window and at least one baseline window")
        if list(self.cohort_edges) != sorted(self.cohort_edges):
            raise ValueError("cohort_edges must be ascending")
        for name in ("cohort_names", "stopper_factors", "magnitude_cuts", "stopper_labels",
                     "decreaser_labels"):
            if len(getattr(self, name)) != 3:
                raise ValueError(f"{name} needs one entry per cohort (3)")
        for arm in self.arms:
            if arm.lo > arm.hi:
                raise ValueError(f"arm {arm.label!r} has an empty bucket range")

    @property
    def n_windows(self) -> int:
        return len(self.window_names)

    def replace(self, **changes) -> "SegmentConfig":
        return dataclasses.replace(self, **changes)


# as_of values used by the test fixtures (event time there is stretched so
# that all fixed values above stay as they are).
FIXTURE_AS_OF = "2020-08-14 12:00:00"
FIXTURE_AS_OF_MIDNIGHT = "2020-08-14 00:00:00"
FIXTURE_AS_OF_MONTH_END = "2020-07-31 18:30:00"
# 30 run times, day by day up to the fixture's; every sixth at midnight
BACKFILL = tuple(str(_day.replace(hour=0 if _day.day % 6 == 0 else 12)) for _day in (
    dt.datetime(2020, 8, 14, 12) - dt.timedelta(days=_k) for _k in range(29, -1, -1)))
FIXTURE_NO_ORDERS = "2021-03-01 09:00:00"  # long after the last order of the fixtures
