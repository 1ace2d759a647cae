"""Hand-made golden rows for the semantic traps and the label edges."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.config import FIXTURE_AS_OF, FIXTURE_AS_OF_MIDNIGHT, SegmentConfig
from ebbtide.operators import eligibility, scoring, segments
from ebbtide.plans import lists
from golden_util import STOPPER_HISTORY, Orders, customer, sub, tables

MIDDAY = SegmentConfig(as_of=FIXTURE_AS_OF)
MIDNIGHT = SegmentConfig(as_of=FIXTURE_AS_OF_MIDNIGHT)
W = [f"{n}_order_count" for n in MIDDAY.window_names]
AOV = [f"{n}_monthly_AOV" for n in MIDDAY.window_names]
GMV = [f"{n}_monthly_GMV" for n in MIDDAY.window_names]

LATER = ("2020-04-20 10:00:00", "2020-05-20 10:00:00", "2020-06-20 10:00:00",
         "2020-07-01 10:00:00", "2020-07-20 10:00:00")


@pytest.fixture(scope="module")
def golden(spark):
    o = Orders()
    o.add(101, *STOPPER_HISTORY)                                  # G7
    o.add(102, *STOPPER_HISTORY, "2020-07-15 23:00:00")           # G1
    o.add(103, *STOPPER_HISTORY[:-1], "2020-08-13 23:00:00")      # G2
    # G9: window 4 empty, window 3 has only NULL subtotals
    o.add(104, "2020-02-10 10:00:00", subtotal="5.00")
    o.add(104, "2020-03-01 10:00:00", subtotal="10.00")
    o.add(104, "2020-03-20 10:00:00", subtotal="20.00")
    o.add(104, "2020-04-01 10:00:00", subtotal="30.00")
    o.add(104, "2020-05-20 10:00:00", "2020-06-01 10:00:00", subtotal=None)
    o.add(104, "2020-06-20 10:00:00", subtotal="40.00")
    o.add(104, "2020-07-01 10:00:00", subtotal="50.00")
    o.add(104, "2020-07-20 10:00:00", subtotal="60.00")
    o.add(105, "2020-04-14 12:00:00", *LATER)                     # G10 dropped
    o.add(106, "2020-04-14 11:59:59.999999", *LATER)              # G10 kept
    o.add(107, "2020-03-17 12:00:00", *LATER)                     # G11
    o.add(108, "2020-03-17 12:00:00.000001", *LATER)              # G11, G16
    o.add(109, *STOPPER_HISTORY, "2020-08-20 10:00:00")           # G12
    o.add(110, "2019-05-01 10:00:00", *STOPPER_HISTORY[1:])       # G13
    o.add(111, "2020-02-10 10:00:00", "2020-03-01 10:00:00", "2020-03-20 10:00:00",
          "2020-04-20 10:00:00", "2020-05-20 10:00:00")           # G14
    o.add(112, *STOPPER_HISTORY)                                  # G21
    o.add(112, "2020-07-25 10:00:00", status="cancelled")
    o.add(112, "2020-07-26 10:00:00", delivered=False)
    o.add(113, *STOPPER_HISTORY)                                  # G22 no metro
    o.add(114, *STOPPER_HISTORY)                                  # G22 unknown metro
    o.add(115, "2020-02-10 10:00:00", "2020-04-20 10:00:00", "2020-05-20 10:00:00",
          "2020-07-20 10:00:00")                                  # G23: 4 orders
    o.add(116, "2020-02-10 10:00:00", "2020-04-20 10:00:00", "2020-05-20 10:00:00",
          "2020-06-20 10:00:00", "2020-07-20 10:00:00")           # G23: 5 orders
    ids = sorted({r[1] for r in o.rows})
    custs = [customer(i, metro={113: None, 114: 99}.get(i, 1)) for i in ids]
    t = tables(spark, custs, o.rows)
    hist = {r["cid"]: r for r in lists.customer_history(t, MIDDAY, with_value=True).collect()}
    details = {r["cid"]: r for r in lists.detail_list(t, MIDDAY).collect()}
    base = {r["customer_id"]: r for r in lists.base_list(t, MIDDAY).collect()}
    metro = {r["customer_id"]: r for r in lists.metro_list(t, MIDDAY).collect()}
    return dict(t=t, hist=hist, details=details, base=base, metro=metro)


def counts(row):
    return [row[c] for c in W]


def test_g7_tie_on_double_is_stopper(golden):
    d = golden["details"][101]
    assert counts(d) == [1, 2, 2, 2, 2, 1]
    assert d["monthly_order_count_average"] == 1.8
    assert d["days_since_last_transaction"] == 25
    assert d["sub_group"] == "Casual Stopper"
    assert d["cohort"] == "casual"


def test_g1_date_boundary_midday_and_midnight(golden, spark):
    assert counts(golden["hist"][102])[:2] == [1, 3]
    night = lists.customer_history(golden["t"], MIDNIGHT).filter("cid = 102").first()
    assert counts(night)[:2] == [2, 3]


def test_g2_days_count_calendar_boundaries(golden):
    assert golden["details"][103]["days_since_last_transaction"] == 1


def test_g9_value_windows(golden):
    h = golden["hist"][104]
    assert counts(h) == [1, 2, 2, 0, 2, 1]
    assert [h[c] for c in AOV] == [60.0, 45.0, None, None, 25.0, 10.0]
    assert [None if h[c] is None else float(h[c]) for c in GMV] == [60.0, 90.0, None, None, 50.0, 10.0]
    d = golden["details"][104]
    assert d["monthly_order_count_average"] == 7 / 5
    assert d["monthly_AOV_average"] == (45.0 + 25.0 + 10.0) / 3
    assert d["monthly_GMV_average"] == 150.0 / 3


def test_g10_tenure_is_strict(golden):
    assert 105 not in golden["details"] and 105 in golden["hist"]
    assert 106 in golden["details"] or golden["hist"][106]["first_order_date"] is not None
    reg = {r["cid"] for r in lists.regular_history(golden["t"], MIDDAY).collect()}
    assert 105 not in reg and 106 in reg


def test_g11_g16_window_mask_uses_the_first_order_timestamp(golden):
    assert counts(golden["hist"][107])[4:] == [0, None]
    assert counts(golden["hist"][108])[4:] == [None, None]
    d = {r["cid"]: r for r in scoring.score(
        lists.regular_history(golden["t"], MIDDAY), MIDDAY).collect()}[108]
    assert d["monthly_order_count_average"] == 4 / 3  # (2 + 1 + 1) / 3
    assert d["magnitude_index"] == 2 / (4 / 3)  # NULL pairs add 0


def test_g12_order_after_as_of(golden):
    h = golden["hist"][109]
    assert h["total_orders_lifetime"] == len(STOPPER_HISTORY) + 1
    assert str(h["last_order_date"]) == "2020-08-20 10:00:00"
    assert counts(h) == [1, 2, 2, 2, 2, 1]


def test_g13_order_before_signup_counts(golden):
    h = golden["hist"][110]
    assert str(h["first_order_date"]) == "2019-05-01 10:00:00"
    assert h["total_orders_lifetime"] == len(STOPPER_HISTORY)


def test_g14_low_average_is_power_cohort_but_not_listed(golden):
    s = {r["cid"]: r for r in scoring.score(
        lists.regular_history(golden["t"], MIDDAY), MIDDAY).collect()}[111]
    assert s["monthly_order_count_average"] == 0.8
    assert s["cohort"] == "power"
    assert 111 not in golden["base"]


def test_g21_ignored_orders(golden):
    h = golden["hist"][112]
    assert h["total_orders_lifetime"] == len(STOPPER_HISTORY)
    assert counts(h)[0] == 1


def test_g22_metro_join_drops_missing_and_unknown(golden):
    assert {113, 114, 101} <= set(golden["base"])
    assert 113 not in golden["metro"] and 114 not in golden["metro"]
    assert golden["metro"][101]["metro"] == "Metro One"


def test_g23_min_lifetime_orders(golden):
    reg = {r["cid"] for r in lists.regular_history(golden["t"], MIDDAY).collect()}
    assert 115 not in reg and 116 in reg


def test_lists_agree(golden):
    assert set(golden["base"]) == set(golden["details"])
    for cid, r in golden["base"].items():
        assert r["sub_group"] == golden["details"][cid]["sub_group"]


def test_g3_g6_g20_eligibility(spark):
    custs = [
        customer(1, name=None, ctype=None),                      # G3 kept
        customer(2, name="BUSINESS CUSTOMER"),                   # G4 dropped
        customer(3, ctype="Business"),                           # G4 dropped
        customer(4),                                             # kept
        customer(5, payment="cusX5"),                            # G5 kept
        customer(6, payment="xcus"),                             # G5 dropped
        customer(7, payment=None),                               # G5 dropped
        customer(8),                                             # G6 two subs, once
        customer(9),                                             # G6 active + deleted
        customer(10),                                            # G6 whitelabel
        customer(11),                                            # G6 gift only
        customer(12, created="2019-01-01 00:00:00"),             # G20 kept
        customer(13, created="2020-03-01 23:59:00"),             # G20 kept
        customer(14, created="2020-03-02 00:00:00"),             # G20 dropped
        customer(15, deleted="2020-01-01 00:00:00"),             # deleted
        customer(16, name="actionlink vendor"),                  # dropped
        customer(17, created="2018-12-31 23:59:59"),             # too early
    ]
    subs = [sub(c[0]) for c in custs if c[0] not in (8, 9, 10, 11)]
    subs += [sub(8), sub(8, "marketplace"), sub(9), sub(9, deleted="2020-02-01 00:00:00"),
             sub(10, "whitelabel"), sub(11, "gift")]
    t = tables(spark, custs, [], subs)
    got = sorted(r["cid"] for r in lists.eligible(t, MIDDAY).collect())
    assert got == [1, 4, 5, 8, 9, 10, 12, 13]


def test_g8_zero_average_no_error(spark):
    o = Orders().add(1, "2020-01-05 10:00:00", "2020-01-10 10:00:00", "2020-01-15 10:00:00",
                     "2020-01-20 10:00:00", "2021-02-27 10:00:00")
    t = tables(spark, [customer(1)], o.rows)
    cfg = SegmentConfig(as_of="2021-03-28 12:00:00")
    scored = scoring.score(lists.regular_history(t, cfg), cfg)
    r = scored.withColumn("sub_group", segments.sub_group(cfg)).first()
    assert r["monthly_order_count_average"] == 0.0
    assert r["avg_days_between_orders"] is None and r["magnitude_index"] is None
    assert r["sub_group"] == "Other"
    assert lists.detail_list(t, cfg).count() == 0


def test_g15_test_arm(spark):
    df = spark.createDataFrame([(b,) for b in (0, 1, 50, 51, 100, 101, None)],
                               T.StructType([T.StructField("b", T.IntegerType())]))
    got = [r[0] for r in df.select(segments.test_arm(MIDDAY, F.col("b"))).collect()]
    control, incentive = (a.label for a in MIDDAY.arms)
    assert got == [None, control, control, incentive, incentive, None, None]


def test_g17_cohort_edges(spark):
    vals = [0.8, 1.0, 2.4999, 2.5, 4.4999, 4.5, None]
    df = spark.createDataFrame([(v,) for v in vals], T.StructType(
        [T.StructField(scoring.AVG, T.DoubleType())]))
    got = [r[0] for r in df.select(scoring.cohort(MIDDAY)).collect()]
    assert got == ["power", "casual", "casual", "core", "core", "power", "power"]


def test_g18_decline_is_strict(spark):
    schema = T.StructType([T.StructField(scoring.AVG, T.DoubleType()),
                           T.StructField(W[0], T.LongType())])
    df = spark.createDataFrame([(4.0, 3), (4.0, 2), (1.0, 0), (0.9, 0)], schema)
    got = [(r[0], r[1]) for r in segments.declining(df, MIDDAY).collect()]
    assert got == [(4.0, 2), (1.0, 0)]


def test_g19_magnitude_edges_and_all_labels(spark):
    schema = T.StructType([T.StructField(scoring.AVG, T.DoubleType()),
                           T.StructField(scoring.DAYS_SINCE, T.IntegerType()),
                           T.StructField(scoring.MAGNITUDE, T.DoubleType())])
    rows = [
        (2.0, 30, 1.0),   # gap 15, 1.5 x 15 = 22.5 <= 30
        (3.0, 30, 1.0),   # gap 10, 2.25 x 10 = 22.5
        (5.0, 20, 1.0),   # gap 6, 2.5 x 6 = 15
        (2.0, 10, 9.0),
        (3.0, 10, 3.0),   # exactly 3: regular
        (3.0, 10, 3.5),
        (5.0, 5, 2.0),    # exactly 2: regular
        (5.0, 5, 2.5),
    ]
    df = spark.createDataFrame(rows, schema).withColumn(
        scoring.GAP, F.lit(30.0) / F.col(scoring.AVG))
    got = [r[0] for r in df.select(segments.sub_group(MIDDAY)).collect()]
    assert got == ["Casual Stopper", "Core Stopper", "Power Stopper", "Casual Decreaser",
                   "Regular Core Decreaser", "Erratic Core Decreaser",
                   "Regular Power Decreaser", "Erratic Power Decreaser"]


def test_x4_like_wildcard_and_x3_null_exclusion(spark):
    custs = [customer(1, payment="cusX1"), customer(2, payment="xcus"),
             customer(3, name=None, ctype=None)]
    t = tables(spark, custs, [])
    like = sorted(r[0] for r in t.customers.filter(eligibility.payment_matches(MIDDAY))
                  .select("id").collect())
    assert like == [1, 3]
    kept = sorted(r[0] for r in t.customers.filter(eligibility.not_excluded(MIDDAY))
                  .select("id").collect())
    assert kept == [1, 2, 3]
