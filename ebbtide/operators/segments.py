"""Decline filter, sub-group label and experiment arm.

With average = S / k (orders in the k observable baseline windows), gap = days / average
and magnitude = C / average, every test compares two products of whole numbers and
configured factors. ``ratios="exact"`` evaluates these as decimals, which never
round; ``"double"`` divides first, so a tie is decided by how the quotient rounds.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SegmentConfig
from ..functions.arith import adjacent_change, present, total
from .history import count_col
from .scoring import AVG, DAYS_SINCE, GAP, MAGNITUDE


def _whole(c: Column) -> Column:
    return c.cast("decimal(18,0)")


def _factor(x: float) -> Column:
    """A configured factor as the decimal that it is written as."""
    return F.lit(Decimal(str(x)))


@dataclass(frozen=True)
class _Tests:
    """The comparisons that filter and labels are made of; NULL like the quotient it stands for."""

    cfg: SegmentConfig

    def _parts(self) -> tuple[Column, Column, Column]:
        counts = [F.col(count_col(self.cfg, k)) for k in range(self.cfg.n_windows)]
        k = F.nullif(present(counts[1:]), F.lit(0))  # no average without a window
        return _whole(total(counts[1:])), _whole(k), _whole(adjacent_change(counts))

    def avg_at_least(self, edge: float) -> Column:
        if self.cfg.ratios == "double":
            return F.col(AVG) >= edge
        s, k, _ = self._parts()
        return s >= k * _factor(edge)

    def newest_below(self, share: float) -> Column:
        """share * average > the newest window's count"""
        newest = F.col(count_col(self.cfg, 0))
        if self.cfg.ratios == "double":
            return F.col(AVG) * F.lit(share) > newest
        s, k, _ = self._parts()
        return s * _factor(share) > k * _whole(newest)

    def silent_for(self, factor: float) -> Column:
        """days since the last order >= factor * gap"""
        if self.cfg.ratios == "double":
            return F.col(DAYS_SINCE) >= F.col(GAP) * F.lit(factor)
        s, k, _ = self._parts()
        s = F.nullif(s, _whole(F.lit(0)))  # no gap without an order
        return _whole(F.col(DAYS_SINCE)) * s >= k * _factor(factor) * _whole(F.lit(self.cfg.window_days))

    def steady(self, cut: float) -> Column:
        """magnitude <= cut"""
        if self.cfg.ratios == "double":
            return F.col(MAGNITUDE) <= F.lit(cut)
        s, k, c = self._parts()
        return c * k <= F.nullif(s, _whole(F.lit(0))) * _factor(cut)


def declining(scored: DataFrame, cfg: SegmentConfig) -> DataFrame:
    """Average at least ``min_average`` and the newest window strictly below
    ``drop_ratio`` times the average."""
    tests = _Tests(cfg)
    return scored.filter(tests.avg_at_least(cfg.min_average) & tests.newest_below(cfg.drop_ratio))


def _bands(cfg: SegmentConfig) -> list[Column]:
    """Label bands by average: below core, core, power (no lower bound)."""
    _, mid, hi = cfg.cohort_edges
    tests = _Tests(cfg)
    core, power = tests.avg_at_least(mid), tests.avg_at_least(hi)
    return [~core, core & ~power, power]


def sub_group(cfg: SegmentConfig) -> Column:
    """First matching rule wins: stoppers (long silence relative to the usual
    gap between orders) first, then decreasers, split by order-rate
    volatility where the cohort has a magnitude cut."""
    tests = _Tests(cfg)
    bands = _bands(cfg)
    rules: list[tuple[Column, str]] = []
    for band, factor, label in zip(bands, cfg.stopper_factors, cfg.stopper_labels):
        rules.append((band & tests.silent_for(factor), label))
    for band, factor, cut, labels in zip(
        bands, cfg.stopper_factors, cfg.magnitude_cuts, cfg.decreaser_labels
    ):
        recent = ~tests.silent_for(factor)
        if cut is None:
            rules.append((band & recent, labels[0]))
        else:
            rules.append((band & tests.steady(cut) & recent, labels[0]))
            rules.append((band & ~tests.steady(cut) & recent, labels[1]))
    cond, label = rules[0]
    expr = F.when(cond, F.lit(label))
    for cond, label in rules[1:]:
        expr = expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(cfg.other_label))


def test_arm(cfg: SegmentConfig, bucket: Column) -> Column:
    """Arm by bucket range; outside every range (or NULL) gives NULL and the
    row is kept."""
    arms = list(cfg.arms)
    expr = F.when(bucket.between(arms[0].lo, arms[0].hi), F.lit(arms[0].label))
    for arm in arms[1:]:
        expr = expr.when(bucket.between(arm.lo, arm.hi), F.lit(arm.label))
    return expr
