"""The fixed values as literals, so that a change of one shows."""

from __future__ import annotations

from ebbtide.config import Arm, SegmentConfig


def test_fixed_values():
    c = SegmentConfig(as_of="2020-08-14 12:00:00")
    assert (c.signup_from, c.signup_to) == ("2019-01-01", "2020-03-01")
    assert (c.payment_pattern, c.delivered_status) == ("%cus_%", "delivered")
    assert c.origins == ("marketplace", "platform", "whitelabel")
    assert c.excluded_names == ("business customer", "actionlink vendor") and c.excluded_types == ("business",)
    assert (c.recency_months, c.min_orders, c.min_recent, c.tenure_months, c.window_days) == ((3, 1), 5, 1, 4, 30)
    assert c.window_names == ("past_30days", "past_31_60days", "past_61_90days", "past_91_120days", "past_121_150days", "past_151_180days")
    assert c.cohort_edges == (1.0, 2.5, 4.5) and c.cohort_names == ("casual", "core", "power")
    assert c.stopper_factors == (1.5, 2.25, 2.5) and c.magnitude_cuts == (None, 3.0, 2.0)
    assert (c.min_average, c.drop_ratio) == (1.0, 0.75)
    assert c.stopper_labels == ("Casual Stopper", "Core Stopper", "Power Stopper")
    assert c.decreaser_labels == (("Casual Decreaser",), ("Regular Core Decreaser", "Erratic Core Decreaser"),
                                  ("Regular Power Decreaser", "Erratic Power Decreaser"))
    assert c.other_label == "Other"
    assert c.arms == (Arm(1, 50, "20200814_20200914_ReEngagementIncentiveTest1_CohortB_Control"),
                      Arm(51, 100, "20200814_20200914_ReEngagementIncentiveTest1_CohortA_Incentive10off3orders"))
