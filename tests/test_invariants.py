"""Invariants of the lists and the published counts of the test-data mapping."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from conftest import SF001, SF01, SF1
from ebbtide.config import FIXTURE_AS_OF, FIXTURE_AS_OF_MIDNIGHT, SegmentConfig
from ebbtide.operators import history, scoring
from ebbtide.plans import lists
from ebbtide.sources import fixtures

MIDDAY = SegmentConfig(as_of=FIXTURE_AS_OF)
MIDNIGHT = SegmentConfig(as_of=FIXTURE_AS_OF_MIDNIGHT)

# (sf dir, cfg) -> (lifetime, regular, w5 NULL, w6 NULL, listed, with metro,
#                   control, incentive, no arm)
COUNTS = {
    (SF001, "midday"): (19, 19, 0, 3, 7, 6, 6, 0, 1),
    (SF01, "midday"): (204, 203, 1, 4, 83, 72, 38, 42, 3),
    (SF01, "midnight"): (204, 203, 1, 6, 83, 72, 39, 41, 3),
    (SF1, "midday"): (2042, 2023, 17, 138, 740, 649, 359, 348, 33),
    (SF1, "midnight"): (2042, 2024, 19, 143, 724, 633, 349, 343, 32),
}
LABELS = ["Casual Stopper", "Core Stopper", "Power Stopper", "Casual Decreaser",
          "Regular Core Decreaser", "Erratic Core Decreaser", "Regular Power Decreaser",
          "Erratic Power Decreaser", "Other"]
LABEL_COUNTS = {
    (SF001, "midday"): [2, 0, 0, 1, 2, 0, 2, 0, 0],
    (SF01, "midday"): [13, 10, 7, 14, 12, 10, 9, 8, 0],
    (SF01, "midnight"): [12, 11, 8, 13, 14, 9, 9, 7, 0],
    (SF1, "midday"): [115, 99, 60, 120, 116, 68, 59, 103, 0],
    (SF1, "midnight"): [110, 100, 67, 106, 99, 72, 65, 105, 0],
}


@pytest.mark.parametrize("key", sorted(COUNTS))
def test_published_counts(spark, key):
    sf_dir, which = key
    cfg = MIDDAY if which == "midday" else MIDNIGHT
    t = fixtures.tables(spark, sf_dir)
    all_hist = lists.customer_history(t, cfg)
    regular = history.regular(all_hist, cfg)
    w5, w6 = history.count_col(cfg, 4), history.count_col(cfg, 5)
    reg = regular.agg(
        F.count("*").alias("n"),
        F.count_if(F.col(w5).isNull()).alias("w5"),
        F.count_if(F.col(w6).isNull()).alias("w6"),
    ).first()
    out = lists.all_lists(t, cfg)
    arms = {r["test_cohort"]: r["count"] for r in
            out["test"].groupBy("test_cohort").count().collect()}
    control_label, incentive_label = (a.label for a in cfg.arms)
    control, incentive = arms.get(control_label, 0), arms.get(incentive_label, 0)
    got = (all_hist.count(), reg["n"], reg["w5"], reg["w6"], out["base"].count(),
           out["metro"].count(), control, incentive, arms.get(None, 0))
    assert got == COUNTS[key]
    labels = {r["sub_group"]: r["count"] for r in
              out["base"].groupBy("sub_group").count().collect()}
    assert [labels.get(label, 0) for label in LABELS] == LABEL_COUNTS[key]


def test_list_invariants(spark):
    t = fixtures.tables(spark, SF01)
    cfg = MIDDAY
    base = lists.base_list(t, cfg)
    metro = lists.metro_list(t, cfg)
    test = lists.test_list(t, cfg)
    details = lists.detail_list(t, cfg)
    ids = lambda df, c="customer_id": sorted(r[0] for r in df.select(c).collect())
    b = ids(base)
    assert len(b) == len(set(b))  # every listed id once
    assert ids(details, "cid") == b
    assert ids(test) == b
    m = ids(metro)
    assert set(m) <= set(b) and len(m) == len(set(m))
    d = details.collect()
    for r in d:
        # the newest four windows are always observable
        assert all(r[history.count_col(cfg, k)] is not None for k in range(4))
        n = sum(r[history.count_col(cfg, k)] is not None for k in range(1, 6))
        assert n in (3, 4, 5)
        assert r["sub_group"] != "Other"
        assert r[scoring.COHORT] in r["sub_group"].lower()
    assert len(details.columns) == 25


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["date", "customer_id", "sub_group"]
    assert df.count() == 7
