"""The batch job: real-schema Parquet in, partitioned lists out, idempotent per date."""

from __future__ import annotations

import pytest

from conftest import SF001
from ebbtide import run
from ebbtide.config import FIXTURE_AS_OF, SegmentConfig
from ebbtide.operators import skew
from ebbtide.plans import lists, strategy, views
from ebbtide.sources import fixtures, schemas, sinks
from ebbtide.sources import tables as tables_mod


def _write_inputs(spark, folder):
    src = fixtures.tables(spark, SF001)
    paths = {}
    for name, df, schema in [("customers", src.customers, schemas.CUSTOMERS),
                             ("orders", src.orders, schemas.ORDERS),
                             ("subscriptions", src.subscriptions, schemas.SUBSCRIPTIONS),
                             ("metros", src.metros, schemas.METROS)]:
        paths[name] = str(folder / name)
        tables_mod.conform(df, schema).write.parquet(paths[name])
    return paths


def _argv(p, out, *more):
    return ["--customers", p["customers"], "--orders", p["orders"], "--subscriptions",
            p["subscriptions"], "--metros", p["metros"], "--as-of", FIXTURE_AS_OF, "--out", str(out), *more]


def _rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def test_job_writes_partitioned_lists_idempotently(spark, tmp_path):
    p = _write_inputs(spark, tmp_path / "in")
    out = str(tmp_path / "out")
    before = _stages(spark)
    run.run(spark, run.parse(_argv(p, out)))
    run.run(spark, run.parse(_argv(p, out)))  # same date again: replaced, not appended
    t = fixtures.tables(spark, SF001)
    cfg = SegmentConfig(as_of=FIXTURE_AS_OF)
    for name, df in lists.all_lists(t, cfg).items():
        assert _rows(spark.read.parquet(f"{out}/{name}")) == _rows(df) != []
    run.run(spark, run.parse(_argv(p, out, "--lists", "base", "--as-of", "2020-08-15 12:00:00")))
    dates = {str(r[0]) for r in spark.read.parquet(f"{out}/base").select("date").distinct().collect()}
    assert dates == {"2020-08-14", "2020-08-15"}
    assert len(_stages(spark)) == len(before) + 1  # only all_lists above left its stage


def _stages(spark):
    import os

    folder = strategy.checkpoint_dir(spark).removeprefix("file:")
    return [f for f in os.listdir(folder) if f.startswith("stage-")]


def test_only_the_first_run_samples_orders(spark, tmp_path, monkeypatch):
    p = _write_inputs(spark, tmp_path / "in")
    out = tmp_path / "out"
    assert skew.saved_plan(spark, f"{out}/_counts", SegmentConfig(as_of=FIXTURE_AS_OF)) is None
    first = _order_scans(spark, lambda: run.run(spark, run.parse(_argv(p, out))), p["orders"])
    sampled = []
    monkeypatch.setattr(skew, "plan_shuffle", lambda *a, **k: sampled.append(1))
    second = _order_scans(spark, lambda: run.run(spark, run.parse(_argv(p, out))), p["orders"])
    assert not sampled and first > 1 and second == 1  # over all jobs of a run
    # counts of one run plan the next: the largest customers are split
    small = SegmentConfig(as_of=FIXTURE_AS_OF, target_partition_bytes=1000)
    counts = skew.Counts(small)
    t = tables_mod.load(spark, p["customers"], p["orders"], p["subscriptions"], p["metros"])
    got, path = lists.shared_pass(t, small, plan=skew.ShufflePlan(), counts=counts)
    counts.save(spark, f"{out}/other")
    plan = skew.saved_plan(spark, f"{out}/other", small)
    history_rows = {r.cid: r.total_orders_lifetime for r in lists.customer_history(t, small, plan=skew.ShufflePlan()).collect()}
    assert {k for k, _ in plan.hot} == {k for k, n in history_rows.items() if n * small.shuffle_row_bytes > 1000} != set()
    assert plan.partitions == -(-sum(history_rows.values()) * small.shuffle_row_bytes // 1000)
    again = lists.shared_pass(t, small, plan=plan)[0]
    assert all(_rows(again[k]) == _rows(got[k]) for k in got)
    strategy.discard(spark, path)


def _order_scans(spark, action, path) -> int:
    """Scans of this path in all SQL executions that ``action`` starts."""
    store = spark._jsparkSession.sharedState().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    old = {e.executionId() for e in _each(store.executionsList())}
    action()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    texts = [e.physicalPlanDescription() for e in _each(store.executionsList()) if e.executionId() not in old]
    found = {(i, n.split("\n", 1)[1]) for i, t in enumerate(texts) for n in t.split("\n\n")
             if "Scan parquet" in n.split("\n")[0] and path in n}
    return len(found)  # adaptive plans print a scan in the final and in the initial plan


def _each(seq):
    return [seq.apply(i) for i in range(seq.size())]


def test_lists_are_checked_before_any_job(spark, tmp_path, capsys):
    p = {k: "nowhere" for k in ("customers", "orders", "subscriptions", "metros")}
    for bad in ("base,detail", "", "all"):
        with pytest.raises(SystemExit):
            run.parse(_argv(p, tmp_path, "--lists", bad))
    assert run.parse(_argv(p, tmp_path, "--lists", "test, base")).lists == ("test", "base")
    with pytest.raises(SystemExit):
        run.parse(_argv(p, tmp_path, "--time-zone", "Mars/Olympus"))
    with pytest.raises(ValueError, match="unknown lists: detail"):
        lists.shared_pass(fixtures.tables(spark, SF001), SegmentConfig(as_of=FIXTURE_AS_OF), ("detail",))
    capsys.readouterr()


def test_only_what_the_lists_need_is_computed(spark, monkeypatch):
    seen = []
    real = strategy.reliable
    monkeypatch.setattr(strategy, "reliable", lambda df: seen.append(df.columns) or real(df))
    t, cfg = fixtures.tables(spark, SF001), SegmentConfig(as_of=FIXTURE_AS_OF)
    for wanted in (("base",), ("metro",), ("test",), ("details",)):
        _, path = lists.shared_pass(t, cfg, wanted, skew.ShufflePlan())
        strategy.discard(spark, path)
    base, metro, test, details = seen
    assert not any("monthly_AOV" in c or c in ("metro_id", "bucket_number") for c in base)
    assert "metro_id" in metro and "bucket_number" in test and "monthly_AOV_average" in details


def test_now_reads_the_clock_of_a_zone():
    import datetime as dt
    import zoneinfo

    zone = zoneinfo.ZoneInfo("Pacific/Kiritimati")
    got = dt.datetime.fromisoformat(run.resolve_as_of("now", zone))
    assert abs(got - dt.datetime.now(zone).replace(tzinfo=None)) < dt.timedelta(seconds=5)


def test_tuning_leaves_the_sessions_zone(spark):
    from ebbtide.session import tune

    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert tune(spark).conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_catalog_tables_in_and_out(spark, tmp_path):
    p = _write_inputs(spark, tmp_path / "in")
    spark.sql("CREATE DATABASE IF NOT EXISTS lapse_in")
    names = {}
    for k, path in p.items():
        names[k] = f"lapse_in.{k}"
        spark.read.parquet(path).write.mode("overwrite").saveAsTable(names[k])
    out = ["--catalog", "--out-catalog", "--lists", "base,details"]
    run.run(spark, run.parse(_argv(names, "lapse_in.out", *out)))
    one = _rows(spark.table("lapse_in.out_base"))
    run.run(spark, run.parse(_argv(names, "lapse_in.out", *out, "--as-of", "2020-08-15 12:00:00")))
    both = _rows(spark.table("lapse_in.out_base"))
    assert set(one) < set(both) and {str(r[1]) for r in both} == {"2020-08-14", "2020-08-15"}
    run.run(spark, run.parse(_argv(names, "lapse_in.out", *out)))  # a re-run replaces its date only
    assert _rows(spark.table("lapse_in.out_base")) == both
    t = tables_mod.load(spark, p["customers"], p["orders"], p["subscriptions"], p["metros"])
    cfg = SegmentConfig(as_of=FIXTURE_AS_OF)
    details = spark.table("lapse_in.out_details").filter("run_date = date'2020-08-14'")
    assert _rows(details) == _rows(lists.detail_list(t, cfg))
    with pytest.raises(ValueError, match="has columns"):
        sinks.write_table(lists.base_list(t, cfg).drop("sub_group"), "lapse_in.out_base")
    spark.sql("DROP DATABASE lapse_in CASCADE")


def test_loader_keeps_fractional_buckets_and_wide_metro_ids(spark, tmp_path):
    p = _write_inputs(spark, tmp_path / "in")
    listed = [r.customer_id for r in lists.base_list(fixtures.tables(spark, SF001), SegmentConfig(as_of=FIXTURE_AS_OF)).collect()]
    a, b = sorted(listed)[:2]
    own = spark.read.parquet(p["customers"]).selectExpr(
        "* except (metro_id, bucket_number)",
        f"case when id = {a} then 3000000000 else metro_id end as metro_id",
        f"cast(case when id = {a} then 50.5 when id = {b} then 51 else bucket_number end as decimal(6,2)) as bucket_number")
    own.write.parquet(str(tmp_path / "own"))
    spark.createDataFrame([(3000000000, "Far")], "id bigint, name string").write.parquet(str(tmp_path / "far"))
    t = tables_mod.load(spark, str(tmp_path / "own"), p["orders"], p["subscriptions"], str(tmp_path / "far"))
    cfg = SegmentConfig(as_of=FIXTURE_AS_OF)
    arms = {r.customer_id: r.test_cohort for r in lists.test_list(t, cfg).collect()}
    assert a in arms and arms[a] is None and arms[b].endswith("CohortA_Incentive10off3orders")
    assert [(r.customer_id, r.metro) for r in lists.metro_list(t, cfg).collect()] == [(a, "Far")]


def test_views(spark):
    t = fixtures.tables(spark, SF001)
    cfg = SegmentConfig(as_of=FIXTURE_AS_OF)
    views.register(t, cfg)
    assert _rows(spark.sql("SELECT * FROM lapse_list")) == _rows(lists.base_list(t, cfg))
    assert _rows(spark.sql("SELECT * FROM lapse_list_metro")) == _rows(lists.metro_list(t, cfg))


def test_checkpoints_go_to_the_configured_folder(spark):
    # the test session names spark.checkpoint.dir (see session.local_session)
    configured = spark.conf.get("spark.checkpoint.dir")
    folder = strategy.checkpoint_dir(spark)
    # Spark adds one folder per application under the configured one
    assert configured.rstrip("/") in folder
    df, path = strategy.reliable(spark.range(10))
    assert df.count() == 10 and path.startswith(folder)
    strategy.discard(spark, path)


def test_job_explain_prints_plans_and_writes_nothing(spark, tmp_path, capsys):
    p = _write_inputs(spark, tmp_path / "in")
    out = tmp_path / "out"
    argv = ["--customers", p["customers"], "--orders", p["orders"], "--subscriptions",
            p["subscriptions"], "--metros", p["metros"], "--as-of", FIXTURE_AS_OF,
            "--out", str(out), "--lists", "base,metro", "--explain"]
    assert run.run(spark, run.parse(argv)) == {}
    text = capsys.readouterr().out
    assert "== base ==" in text and "== metro ==" in text and "PushedFilters" in text
    assert not out.exists()
