"""Physical-plan properties and equivalence of the execution paths."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

from conftest import SF001, SF01
from ebbtide.config import FIXTURE_AS_OF, SegmentConfig
from ebbtide.operators import history, skew
from ebbtide.plans import lists
from ebbtide.sources import fixtures, schemas
from ebbtide.sources import tables as tables_mod

CFG = SegmentConfig(as_of=FIXTURE_AS_OF)
PYTHON_NODES = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                "MapInPandas")


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def nodes(text: str, name: str) -> list[str]:
    return re.findall(rf"^\(\d+\) {name}\b.*$", text, flags=re.M)


def same_rows(a, b) -> bool:
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def fx01(spark):
    return fixtures.tables(spark, SF01)


def test_one_orders_scan_one_shuffle_no_python(fx01):
    text = plan(lists.detail_list(fx01, CFG))
    scans = [s for s in text.split("\n(") if "Scan parquet" in s.split("\n")[0]]
    event_scans = [s for s in scans if "events.parquet" in s]
    assert len(event_scans) == 1, "orders must be read once"
    exchanges = nodes(text, "Exchange")
    repart = [e for e in exchanges]
    assert sum("REPARTITION_BY_COL" in x for x in text.split("\n") if "Arguments" in x) == 1
    # the only other hash exchange is the map-side-combined distinct of subscribers
    assert len(repart) == 2
    for bad in PYTHON_NODES:
        assert bad not in text


def test_pushdown_and_pruning_on_real_tables(spark, tmp_path):
    src = fixtures.tables(spark, SF001)
    paths = {}
    for name, df, schema in [("customers", src.customers, schemas.CUSTOMERS),
                             ("orders", src.orders, schemas.ORDERS),
                             ("subscription_base", src.subscriptions, schemas.SUBSCRIPTIONS),
                             ("metros", src.metros, schemas.METROS)]:
        p = str(tmp_path / name)
        tables_mod.conform(df, schema).write.parquet(p)
        paths[name] = p
    t = tables_mod.load(spark, paths["customers"], paths["orders"], paths["subscription_base"],
                        paths["metros"])
    text = plan(lists.base_list(t, CFG))
    orders_scan = [s for s in text.split("\n(") if "/orders" in s and "Scan parquet" in s][0]
    assert "EqualTo(status,delivered)" in orders_scan
    assert "IsNotNull(delivered_at)" in orders_scan
    # base list needs neither the subtotal nor anything else from orders
    assert "actual_subtotal" not in orders_scan.split("ReadSchema")[1]
    cust_scan = [s for s in text.split("\n(") if "/customers" in s and "Scan parquet" in s][0]
    assert "GreaterThanOrEqual(created_at" in cust_scan and "LessThan(created_at" in cust_scan
    assert "IsNull(deleted_at)" in cust_scan
    assert lists.base_list(t, CFG).count() == 7
    # Eligible ids not broadcast: orders meet a broadcast bitmap before the
    # shuffle, then the exact join after the aggregate; same answer.
    nb = lists.base_from(lists.labelled(lists.regular_history(t, CFG, broadcast=False), CFG), CFG)
    text = plan(nb)
    assert "_word" in text and "BroadcastHashJoin" in text
    assert same_rows(nb, lists.base_list(t, CFG))


def test_salted_and_shuffled_paths_equal_broadcast_path(spark, fx01):
    plain = lists.customer_history(fx01, CFG, with_value=True, broadcast=True)
    shuffled = lists.customer_history(fx01, CFG, with_value=True, broadcast=False)
    split = skew.ShufflePlan(partitions=16, every=4)
    salted = lists.customer_history(fx01, CFG, with_value=True, broadcast=True, plan=split)
    salted_shuffled = lists.customer_history(fx01, CFG, with_value=True, broadcast=False, plan=split)
    hot_cfg = CFG.replace(skew_sample_fraction=1.0, target_partition_bytes=2000)
    hot = lists.plan_orders(fx01, hot_cfg)
    assert hot.hot and hot.partitions
    listed = lists.customer_history(fx01, CFG, with_value=True, broadcast=False, plan=hot)
    all_orders = lists.customer_history(fx01, CFG.replace(prefilter=False), with_value=True,
                                        broadcast=False)
    assert plain.count() > 150
    assert same_rows(plain, shuffled)
    assert same_rows(plain, all_orders)
    assert same_rows(plain, salted)
    assert same_rows(plain, salted_shuffled)
    assert same_rows(plain, listed)


def test_hot_key_detection_finds_a_dominant_customer(spark):
    # one customer holds a third of the rows
    rows = [(i, 7 if i % 3 == 0 else i) for i in range(30000)]
    df = spark.createDataFrame(rows, "id long, customer_id long")
    cfg = CFG.replace(skew_sample_fraction=0.2, target_partition_bytes=100_000)
    plan = skew.plan_shuffle(df, cfg)
    hot = plan.hot
    assert [k for k, _ in hot] == [7]
    # ~10,000 rows x 48 bytes over 100 kB targets: about five splits
    assert 3 <= hot[0][1] <= 8
    salted = skew.with_salt(df, plan)
    per_salt = salted.filter("customer_id = 7").groupBy("salt").count().collect()
    assert len(per_salt) == hot[0][1]


def test_salted_aggregate_is_exact_with_duplicate_order_ids(spark):
    # duplicated order ids of a hot customer must still count once
    rows = [(i % 500, 1, f"2020-07-{1 + i % 28:02d} 10:00:00", "delivered", "2020-07-30 00:00:00",
             None) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, customer_id long, created_at string, status string,"
                                     " delivered_at string, actual_subtotal decimal(18,2)")
    df = df.selectExpr("id", "customer_id", "cast(created_at as timestamp_ntz) created_at",
                       "status", "cast(delivered_at as timestamp_ntz) delivered_at",
                       "actual_subtotal")
    plain = history.order_history(df, CFG).first()
    salted = history.order_history(df, CFG, plan=skew.ShufflePlan(None, [(1, 8)])).first()
    assert plain["total_orders_lifetime"] == 500 == salted["total_orders_lifetime"]
    assert plain == salted


def test_all_lists_one_pass_matches_single_lists(fx01):
    out = lists.all_lists(fx01, CFG)
    assert same_rows(out["details"], lists.detail_list(fx01, CFG))
    assert same_rows(out["metro"], lists.metro_list(fx01, CFG))
    assert same_rows(out["test"], lists.test_list(fx01, CFG))
    assert same_rows(out["base"], lists.base_list(fx01, CFG))


def test_shuffle_plan_sizes_from_volume_and_splits_hot_keys():
    cfg = CFG.replace(skew_sample_fraction=0.01)  # 48-byte rows, 128 MB targets
    rows = [{"total": True, "k": None, "n": 1_000_000}, {"total": False, "k": 5, "n": 400_000},
            {"total": False, "k": 6, "n": 10}]
    # 1e8 rows x 48 B = 4.8 GB -> 36 partitions: the session's 200 suffice
    p = skew.plan_from(rows, cfg, session_partitions=200)
    assert p.partitions is None
    # key 5: 4e7 rows x 48 B = 1.9 GB -> 15 splits of ~128 MB; key 6 is ordinary
    assert p.hot == [(5, 15)]
    # a session with 8 partitions would make 600 MB partitions: ask for 36
    assert skew.plan_from(rows, cfg, session_partitions=8).partitions == 36
    # nothing sampled: keep everything as it is
    assert skew.plan_from([{"total": True, "k": None, "n": None}], cfg, 8) == skew.ShufflePlan()
    # nothing bounds the partitions or the keys but the volume
    big = [{"total": True, "k": None, "n": 10**10}] + [{"total": False, "k": k, "n": 10**5} for k in range(10)]
    far = skew.plan_from(big, cfg, 8)
    assert far.partitions == 357628 and len(far.hot) == 10
    # a NULL-key group is neither the total nor a hot key
    flagged = [{"total": True, "k": None, "n": 1_000_000},
               {"total": False, "k": None, "n": 900_000}, {"total": False, "k": 5, "n": 400_000}]
    assert skew.plan_from(flagged, cfg, 200) == p


def test_bitmap_prefilter_keeps_every_member_and_is_bounded(spark):
    from ebbtide.operators import semijoin

    members = spark.range(0, 3000, 3).withColumnRenamed("id", "cid")  # 1,000 ids
    bits = 1 << 13
    bm = semijoin.bitmap(members, "cid", bits)
    assert bm.count() <= bits // 64
    probe = spark.range(0, 6000).withColumnRenamed("id", "customer_id")
    kept = {r[0] for r in semijoin.keep_members(probe, bm, "customer_id", bits).collect()}
    assert set(range(0, 3000, 3)) <= kept  # no false negatives
    outsiders = len(kept) - 1000
    assert outsiders < 0.25 * 5000  # ~1 - exp(-1000/8192) = 11.5% expected


def test_salted_plan_shape(fx01):
    text = plan(lists.customer_history(fx01, CFG, broadcast=True,
                                       plan=skew.ShufflePlan(16, [(5, 3)])))
    args = [x for x in text.split("\n") if x.startswith("Arguments: hashpartitioning")]
    orders_side = [a for a in args if "customer_id" in a]
    # one big exchange on (customer, salt) with the sized count, then one
    # small exchange on the customer to merge the salted partial rows
    assert len(orders_side) == 2
    assert "salt" in orders_side[0] and "REPARTITION_BY_NUM" in orders_side[0]
    assert "salt" not in orders_side[1] and "ENSURE_REQUIREMENTS" in orders_side[1]


def test_broadcast_estimates_cover_what_spark_measures(spark):
    """Bytes a row of a long-keyed relation and of a bitmap row, by Spark's own dataSize metric."""
    from ebbtide.operators import semijoin

    n, words = 200_000, 1 << 17
    ids = spark.range(n).withColumnRenamed("id", "customer_id")
    bm = semijoin.bitmap(ids.withColumnRenamed("customer_id", "cid"), "cid", 64 * words)
    probe = spark.range(0, 10).withColumnRenamed("id", "customer_id")
    from pyspark.sql import functions as F

    joins = [(probe.join(F.broadcast(ids), "customer_id", "left_semi"), n, CFG.broadcast_row_bytes),
             (semijoin.keep_members(probe, bm, "customer_id", 64 * words), words, CFG.bitmap_row_bytes)]
    for df, rows, assumed in joins:
        df.collect()
        node = _find(df._jdf.queryExecution().executedPlan(), "BroadcastExchangeExec")
        size = node.metrics().apply("dataSize").value()
        assert size <= 1.05 * assumed * rows, (size / rows, assumed)


def _find(node, name):
    """The first plan node of this class, through adaptive and stage wrappers."""
    todo = [node]
    while todo:
        n = todo.pop()
        kind = n.getClass().getSimpleName()
        if kind == name:
            return n
        if kind == "AdaptiveSparkPlanExec":
            todo.append(n.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(n.plan())
        kids = n.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    raise AssertionError(f"no {name}")


def test_recency_range_is_pushed_and_keeps_results(spark, tmp_path):
    src = fixtures.tables(spark, SF01)
    # lapsed customers: nobody of every other id ordered in the recency range
    cut = history.edges(CFG).recency[0]
    from pyspark.sql import functions as F

    orders = src.orders.filter((F.col("customer_id") % 4 != 0) | (F.col("created_at") < cut))
    paths = {}
    for name, df, schema in [("customers", src.customers, schemas.CUSTOMERS), ("orders", orders, schemas.ORDERS),
                             ("subscription_base", src.subscriptions, schemas.SUBSCRIPTIONS), ("metros", src.metros, schemas.METROS)]:
        paths[name] = str(tmp_path / name)
        tables_mod.conform(df, schema).write.parquet(paths[name])
    t = tables_mod.load(spark, paths["customers"], paths["orders"], paths["subscription_base"], paths["metros"])
    reduced = CFG.replace(orders_by_created_at=True)
    text = plan(lists.base_list(t, reduced))
    scans = [x for x in text.split("\n(") if "/orders" in x and "Scan parquet" in x]
    assert any("GreaterThanOrEqual(created_at" in x and "LessThan(created_at" in x for x in scans)
    assert same_rows(lists.base_list(t, reduced), lists.base_list(t, CFG))
    kept = lists.customer_history(t, reduced, recent_only=True)
    assert kept.count() < lists.customer_history(t, CFG).count()
    off = reduced.replace(min_recent=0)
    assert same_rows(lists.customer_history(t, off, recent_only=True), lists.customer_history(t, off))


def test_no_broadcast_at_all_where_the_session_forbids_it(spark, fx01):
    from ebbtide.plans import strategy

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert strategy.orders_join(spark, CFG, 10) == ("none", 0)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert strategy.orders_join(spark, CFG, 10**12)[0] == "bitmap"  # however many ids
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1t")
    try:
        assert strategy.broadcast_budget(spark, CFG) == 1024**4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
