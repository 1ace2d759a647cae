"""NOT IN by a join, exact ratios, the blocked filter and many run dates."""

from __future__ import annotations

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from ebbtide.config import BACKFILL, FIXTURE_AS_OF, SegmentConfig
from ebbtide.operators import eligibility, history, scoring, segments, semijoin
from ebbtide.operators.not_in import not_in, unique
from ebbtide.plans import backfill, incremental, lists, strategy
from ebbtide.sources import fixtures
from golden_util import STOPPER_HISTORY, Orders, customer, tables
from test_plans import plan, same_rows

CFG = SegmentConfig(as_of=FIXTURE_AS_OF)
CHECKED = CFG.replace(customer_ids="checked")


# NOT IN ------------------------------------------------------------------------


@pytest.mark.parametrize("banned", [[], [2], [2, 2, 5], [None], [2, None], [7]])
@pytest.mark.parametrize("shuffled", [False, True])
def test_not_in_equals_sql(spark, banned, shuffled):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d"), (5, "e")], "id bigint, x string")
    out = spark.createDataFrame([(b,) for b in banned], "b bigint")
    rows.createOrReplaceTempView("not_in_rows")
    out.createOrReplaceTempView("not_in_banned")
    expected = spark.sql("SELECT * FROM not_in_rows WHERE id NOT IN (SELECT b FROM not_in_banned)").collect()
    if shuffled:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = not_in(rows, "id", out)
        got = df.collect()
        text = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, expected), key=str)
    if shuffled:
        assert "Broadcast" not in text


def _lapsed(*customers):
    o = Orders()
    for c in {c[0] for c in customers if c[0] is not None}:
        o.add(c, *STOPPER_HISTORY)
    return customers, o.rows


def test_a_null_id_among_the_excluded_empties_the_list(spark):
    base = [customer(1), customer(2, name="ACTIONLINK vendor"), customer(3, name=None, ctype=None)]
    schema = "id bigint, created_at timestamp_ntz, deleted_at timestamp_ntz, stripe_customer_id string, name string, customer_type string, metro_id bigint, bucket_number double"

    def listed(customers, cfg=CHECKED):
        people, orders = _lapsed(*customers)
        t = tables(spark, [c for c in people if c[0] is not None], orders)
        t = type(t)(spark.createDataFrame(list(people), schema), t.orders, t.subscriptions, t.metros)
        return {r.customer_id for r in lists.base_list(t, cfg).collect()}

    assert listed(base) == {1, 3} == listed(base, CFG)
    nobody = customer(None, payment="x", ctype="business")  # a NULL id among the excluded
    assert listed([*base, nobody]) == set()
    assert listed([*base, customer(None, payment="cus_x")]) == {1, 3}  # a NULL id elsewhere
    # excluded by id: another row of the customer looks like a business
    assert listed([*base, customer(1, created="2017-01-01 00:00:00", ctype="Business")]) == {3}


def test_a_duplicate_id_stops_the_job(spark):
    people, orders = _lapsed(customer(1), customer(2), customer(2, name="Other"))
    t = tables(spark, list(people), orders)
    with pytest.raises(Exception, match="cid 2 is there more than once"):
        lists.base_list(t, CHECKED).collect()
    with pytest.raises(Exception, match="more than once"):
        lists.metro_list(t, CHECKED).collect()
    with pytest.raises(Exception, match="id NULL is there"):
        unique(spark.createDataFrame([(None,), (None,)], "id bigint"), "id").collect()
    with pytest.raises(ValueError, match="customer_ids"):
        CFG.replace(customer_ids="maybe")


def test_checked_lists_equal_the_others(spark):
    t = fixtures.tables(spark, SF01)
    for make in (lists.base_list, lists.metro_list, lists.detail_list):
        assert same_rows(make(t, CHECKED), make(t, CFG))
    for broadcast in (True, False):
        assert same_rows(lists.customer_history(t, CHECKED, broadcast=broadcast), lists.customer_history(t, CFG))
    assert same_rows(eligibility.passing(t.customers, CHECKED), eligibility.passing(t.customers, CFG))


# exact ratios -------------------------------------------------------------------


def _labels(spark, rows, cfg):
    """(label, declining) for rows of (w1..w6, days since the last order)."""
    import datetime as dt

    at = dt.datetime.fromisoformat(cfg.as_of)
    data = [(i, at - dt.timedelta(days=days), *w) for i, (w, days) in enumerate(rows)]
    schema = "cid int, last_order_date timestamp_ntz, " + ", ".join(f"{history.count_col(cfg, k)} bigint" for k in range(6))
    scored = scoring.score(spark.createDataFrame(data, schema), cfg)
    kept = {r.cid for r in segments.declining(scored, cfg).collect()}
    return [(r.sub_group, r.cid in kept) for r in scored.select("cid", segments.sub_group(cfg).alias("sub_group")).orderBy("cid").collect()]


def _rule(w, days, cfg):
    """The label and the decline filter in fractions."""
    seen = [x for x in w[1:] if x is not None]
    if not seen or not sum(seen):
        return cfg.other_label, False
    avg = Fraction(sum(seen), len(seen))
    mag = Fraction(sum(abs(a - b) for a, b in zip(w, w[1:]) if a is not None and b is not None)) / avg
    band = 0 if avg < Fraction(str(cfg.cohort_edges[1])) else 1 if avg < Fraction(str(cfg.cohort_edges[2])) else 2
    down = avg >= Fraction(str(cfg.min_average)) and w[0] is not None and avg * Fraction(str(cfg.drop_ratio)) > w[0]
    if days >= cfg.window_days / avg * Fraction(str(cfg.stopper_factors[band])):
        return cfg.stopper_labels[band], down
    cut = cfg.magnitude_cuts[band]
    return cfg.decreaser_labels[band][0 if cut is None or mag <= Fraction(str(cut)) else 1], down


def test_the_tie_of_25_days(spark):
    """Average 1.8 and 25 days: 30 / 1.8 * 1.5 is 25 exactly, so a stopper either way."""
    row = [((0, 3, 2, 2, 1, 1), 25), ((0, 3, 2, 2, 1, 1), 24)]
    for ratios in ("double", "exact"):
        assert [x for x, _ in _labels(spark, row, CFG.replace(ratios=ratios))] == ["Casual Stopper", "Casual Decreaser"]


def test_exact_ratios_are_those_of_fractions(spark):
    rng = random.Random(8)
    rows = [((rng.randrange(4), *(rng.randrange(7) for _ in range(3)), *(rng.choice((None, 0, 2, 5)) for _ in range(2))), rng.randrange(90)) for _ in range(1500)]
    rows += [((0, 0, 0, 0, None, None), 5), ((None,) * 6, 5), ((1, 2, 2, 0, None, None), 20)]
    # ties: days on the edge of every average
    rows += [((0, a, b, c, None, None), d) for a in range(5) for b in range(5) for c in range(5) for d in (9, 18, 25, 27, 45)]
    exact = CFG.replace(ratios="exact")
    expected = [_rule(w, days, CFG) for w, days in rows]
    assert _labels(spark, rows, exact) == expected
    assert _labels(spark, rows, CFG) == expected  # doubles round no tie of these factors apart


def test_where_doubles_round_a_tie_apart(spark):
    """With a factor of 1.1 they do: 49 days are 1.1 * 30 / (average 2/3) = 49.5, and 66 are 1.1 * 30 / 0.5."""
    cfg = CFG.replace(stopper_factors=(1.1, 2.25, 2.5))
    rows = [((0, a, b, c, None, None), d) for a in range(7) for b in range(7) for c in range(7) for d in range(1, 100)]
    expected = [_rule(w, days, cfg) for w, days in rows]
    assert _labels(spark, rows, cfg.replace(ratios="exact")) == expected
    assert _labels(spark, rows, cfg) != expected


def test_exact_lists_equal_the_others(spark):
    t = fixtures.tables(spark, SF01)
    assert same_rows(lists.detail_list(t, CFG.replace(ratios="exact")), lists.detail_list(t, CFG))
    with pytest.raises(ValueError, match="ratios"):
        CFG.replace(ratios="6 decimals")


# the blocked filter ---------------------------------------------------------------


def test_blocked_filter_keeps_members_and_few_others(spark):
    n_ids = 40_000
    members = spark.range(0, 3 * n_ids, 3).withColumnRenamed("id", "cid")
    probe = spark.range(0, 3 * n_ids).withColumnRenamed("id", "customer_id")
    n = semijoin.n_blocks(n_ids, 64 << 20)
    filter_ = semijoin.blocks(members, "cid", n)
    assert filter_.count() <= n == -(-n_ids * 12 // 512)
    kept = semijoin.keep_listed(probe, filter_, "customer_id", n)
    assert kept.columns == ["customer_id"]
    assert kept.filter("customer_id % 3 = 0").count() == n_ids  # no false negatives
    assert kept.count() - n_ids < 0.01 * 2 * n_ids  # under 1% of the others
    # of a given size, the plain bitmap passes several times as many
    bits = 64 * (n * semijoin.BLOCK_ROW_BYTES // CFG.bitmap_row_bytes)
    plain = semijoin.keep_members(probe, semijoin.bitmap(members, "cid", bits), "customer_id", bits)
    assert plain.count() - n_ids > 10 * (kept.count() - n_ids)
    # bounded: with a tenth of the bytes it filters less and loses nobody
    few = n // 10
    assert semijoin.n_blocks(n_ids, few * semijoin.BLOCK_ROW_BYTES) == few
    small = semijoin.keep_listed(probe, semijoin.blocks(members, "cid", few), "customer_id", few)
    assert small.filter("customer_id % 3 = 0").count() == n_ids
    assert semijoin.n_blocks(0, 64 << 20) == 1 and semijoin.n_blocks(5, 10) == 0


def test_a_blocks_bytes_are_covered(spark):
    from test_plans import _find

    n = 1 << 14
    members = spark.range(50 * n).withColumnRenamed("id", "cid")
    df = semijoin.keep_listed(spark.range(10).withColumnRenamed("id", "customer_id"), semijoin.blocks(members, "cid", n), "customer_id", n)
    df.collect()
    node = _find(df._jdf.queryExecution().executedPlan(), "BroadcastExchangeExec")
    assert node.metrics().apply("dataSize").value() <= 1.05 * semijoin.BLOCK_ROW_BYTES * n


def test_orders_that_pass_the_filter_are_the_eligible_ones(spark):
    """On the fixture: under 1% of the other orders reach the shuffle."""
    t = fixtures.tables(spark, SF01)
    ids = lists.eligible(t, CFG)
    how, n = strategy.orders_join(spark, CFG, ids.count(), broadcast=False)
    assert how == "bitmap"
    delivered = history.delivered_orders(t.orders, CFG)
    passed = lists.reduced(delivered, ids, how, n)
    own = lists.reduced(delivered, ids, "broadcast", 0).select(passed.columns)
    assert own.exceptAll(passed).count() == 0
    assert passed.count() - own.count() < 0.01 * (delivered.count() - own.count())


# many run dates --------------------------------------------------------------------


def test_thirty_dates_from_one_pass(spark):
    t = fixtures.tables(spark, SF001)
    got, path = backfill.base_lists(t, CFG, list(BACKFILL))
    by = {}
    for r in got.collect():
        by.setdefault(str(r.date), set()).add((r.customer_id, r.sub_group))
    for as_of in BACKFILL:
        one = {(r.customer_id, r.sub_group) for r in lists.base_list(t, CFG.replace(as_of=as_of)).collect()}
        assert by.get(as_of[:10], set()) == one
    assert sum(map(len, by.values())) > 60
    strategy.discard(spark, path)


def test_backfill_reads_orders_once_and_a_state_not_at_all(spark, tmp_path):
    t = fixtures.tables(spark, SF001)
    got, path = backfill.base_lists(t, CFG, list(BACKFILL))
    assert "events.parquet" not in plan(got)  # it reads the stored day rows
    held = incremental.advance(spark, str(tmp_path / "state"), t.orders, "all", CFG)
    kept, none = backfill.base_lists(t, CFG, list(BACKFILL), held)
    assert none is None and "events.parquet" not in plan(kept) and same_rows(kept, got)
    never = CFG.replace(min_recent=0, min_average=0.0)
    times = ["2020-08-14 12:00:00", "2021-03-01 09:00:00"]  # the second long after the last order
    both, other = backfill.base_lists(t, never, times, held)
    for as_of in times:
        assert same_rows(both.filter(F.col("date") == as_of[:10]), lists.base_list(t, never.replace(as_of=as_of)))
    strategy.discard(spark, path)
    assert other is None
