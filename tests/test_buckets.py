"""Orders in buckets: no exchange of orders, and the same lists."""

from __future__ import annotations

import re

import pytest

from conftest import SF01
from ebbtide.config import FIXTURE_AS_OF, SegmentConfig
from ebbtide.operators import history, skew
from ebbtide.plans import lists
from ebbtide.sources import buckets, fixtures
from test_plans import plan, same_rows

CFG = SegmentConfig(as_of=FIXTURE_AS_OF)
PLAN = skew.ShufflePlan(hot=[(3, 4), (7, 2), (21, 3)])


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    t = fixtures.tables(spark, SF01)
    where = tmp_path_factory.mktemp("buckets")
    buckets.store_orders(t.orders, "plain_orders", 6, path=str(where / "plain"))
    buckets.store_orders(t.orders, "split_orders", 6, PLAN, str(where / "split"))
    yield t, buckets.load(spark, "plain_orders", t), buckets.load(spark, "split_orders", t)
    for name in ("plain_orders", "split_orders", "split_orders_hot"):
        spark.sql(f"DROP TABLE {name}")


def _above_orders(text: str) -> list[str]:
    """Nodes that the rows of the orders scans pass, up to the root, from the printed tree."""
    tree = text.split("\n\n")[0].split("\n")[1:]
    depth = lambda line: len(re.match(r"[\s:+\-|]*", line)[0])
    found = []
    for at, line in enumerate(tree):
        if "Scan parquet" in line and "orders" in line:
            own = depth(line)
            for upper in reversed(tree[:at]):
                if depth(upper) < own:
                    own = depth(upper)
                    found.append(upper.strip(" :+-*"))
    return found


def test_no_exchange_above_the_orders_scan(spark, stored):
    t, plain, split = stored
    for broadcast in (True, False):
        text = plan(lists.base_from(lists.declining_customers(plain, CFG, broadcast=broadcast), CFG))
        above = _above_orders(text)
        assert any("HashAggregate" in x or "SortAggregate" in x or "ObjectHash" in x for x in above)
        assert not any(x.startswith("Exchange") or " Exchange" in x for x in above), text
        assert "Bucketed: true" in text
    # the customers with many orders: partial rows of (customer, salt) meet once
    text = plan(lists.customer_history(split, CFG))
    args = [x for x in text.split("\n") if x.startswith("Arguments: hashpartitioning(customer_id")]
    assert len(args) == 1 and "ENSURE_REQUIREMENTS" in args[0]


@pytest.mark.parametrize("broadcast", [True, False])
def test_results_equal_the_shuffled_pass(spark, stored, broadcast):
    t, plain, split = stored
    expected = lists.customer_history(t, CFG, with_value=True).collect()
    for own in (plain, split):
        got = lists.customer_history(own, CFG, with_value=True, broadcast=broadcast).collect()
        assert sorted(map(tuple, got), key=str) == sorted(map(tuple, expected), key=str)
    assert {r.customer_id for r in split.hot_orders.select("customer_id").distinct().collect()} == {3, 7, 21}
    assert split.orders.filter("customer_id in (3, 7, 21)").count() == 0
    assert split.hot_orders.select("customer_id", "salt").distinct().count() == 9
    carried = lists.all_lists(split, CFG)
    for name, df in lists.all_lists(t, CFG).items():
        assert same_rows(carried[name], df)


def test_appended_orders_go_where_their_customer_is(spark, stored, tmp_path):
    t, *_ = stored
    early, late = t.orders.filter("id % 3 <> 0"), t.orders.filter("id % 3 = 0")
    buckets.store_orders(early, "grown_orders", 4, PLAN, str(tmp_path / "grown"))
    buckets.store_orders(late, "grown_orders", 4, path=str(tmp_path / "grown"), append=True)
    own = buckets.load(spark, "grown_orders", t)
    try:
        assert same_rows(lists.customer_history(own, CFG), lists.customer_history(t, CFG))
        assert {r[0] for r in own.hot_orders.select("customer_id").distinct().collect()} == {3, 7, 21}
        assert "Exchange hash" not in plan(history.order_history(history.delivered_orders(own.orders, CFG), CFG, plan=skew.ShufflePlan(in_place=True)))
    finally:
        spark.sql("DROP TABLE grown_orders")
        spark.sql("DROP TABLE grown_orders_hot")
