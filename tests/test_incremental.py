"""History kept between runs equals a full pass over all orders added so far."""

from __future__ import annotations

import random

import pytest

from ebbtide.config import SegmentConfig
from ebbtide.operators import rollup
from ebbtide.plans import incremental, lists, strategy
from ebbtide.sources import schemas
from ebbtide.sources.versions import VersionTaken, Versions
from golden_util import customer, order, tables
from test_plans import plan

DATES = ("2020-08-13 12:00:00", "2020-08-14 12:00:00", "2020-08-15 00:00:00")


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _day_orders(rng: random.Random, ids, n: int, newest: str, oldest: int = 230) -> list[tuple]:
    """Orders of some customers on days up to ``newest``; many in the last weeks before it."""
    import datetime as dt

    upto = dt.datetime.fromisoformat(newest)
    out = []
    for _ in range(n):
        at = upto - dt.timedelta(days=rng.randrange(oldest), seconds=rng.randrange(86400), microseconds=rng.choice((0, 1, 999999)))
        cid = rng.choice(range(1, 21)) if rng.random() < 0.9 else rng.choice((None, 99))
        status = "delivered" if rng.random() < 0.9 else "cancelled"
        out.append(order(rng.choice(ids), cid, at.isoformat(" "), status, rng.random() < 0.95, rng.choice(("10.00", "0.05", None))))
    return out


@pytest.fixture(scope="module")
def slices():
    """Three slices: the second repeats ids and rows of the first, the third brings orders created long before."""
    rng = random.Random(11)
    first = _day_orders(rng, range(1, 900), 700, "2020-08-13 00:00:00")
    second = _day_orders(rng, range(800, 1000), 60, "2020-08-14 00:00:00", 3) + rng.sample(first, 40)
    third = _day_orders(rng, range(1, 1100), 80, "2020-08-15 00:00:00", 700) + second[:20]
    # a customer's time without a value, and one with an order at the last microsecond of a day
    third += [order(5000, 7, "2020-07-01 23:59:59.999999", subtotal=None), order(2**40 + 5, 8, "2020-06-30 00:00:00"), order(-3, 8, "2020-06-01 00:00:00")]
    return [first, second, third]


@pytest.fixture(scope="module")
def people():
    return [customer(i, metro=1 + i % 3, bucket=5 * i) for i in range(1, 19)] + [customer(19, name="Business Customer")]


def test_three_dates_equal_the_full_pass(spark, tmp_path, slices, people):
    folder = str(tmp_path / "state")
    so_far: list[tuple] = []
    for k, as_of in enumerate(DATES):
        cfg = SegmentConfig(as_of=as_of)
        so_far = so_far + slices[k]
        held = incremental.advance(spark, folder, spark.createDataFrame(slices[k], schemas.ORDERS).repartition(3), f"slice {k}", cfg)
        t = tables(spark, people, so_far)
        got, path = incremental.wanted_lists(t, held, cfg)
        full = lists.all_lists(t, cfg)
        for name in lists.LISTS:
            assert _rows(got[name]) == _rows(full[name])
        assert _rows(full["base"])
        columns = ["cid", "first_order_date", "last_order_date", "total_orders_lifetime", "recency"]
        every = lists.customer_history(t, cfg, with_value=True)
        assert _rows(incremental.customer_history(t, held, cfg, True).select(every.columns)) == _rows(every)
        assert set(columns) <= set(every.columns)
        strategy.discard(spark, path)
    assert held.slices == ["slice 0", "slice 1", "slice 2"]
    # an earlier date from the newest state
    cfg = SegmentConfig(as_of="2020-05-05 18:00:00")
    t = tables(spark, people, so_far)
    assert _rows(incremental.customer_history(t, held, cfg)) == _rows(lists.customer_history(t, cfg))


def test_distinct_counts_merge_in_any_order(spark, slices):
    rows = [spark.createDataFrame(s, schemas.ORDERS).filter("customer_id is not null") for s in slices]
    words = [rollup.id_words(rollup.partials(r)) for r in rows]
    expected = {}
    for s in slices:
        for oid, cid, *_ in s:
            if cid is not None:
                expected.setdefault(cid, set()).add(oid)
    for a, b, c in ((0, 1, 2), (2, 0, 1)):
        one = rollup.merged_words(words[a], words[b]).drop("gained")
        both = rollup.merged_words(one, words[c])
        assert {r.customer_id: r.n for r in rollup.totals(both).collect()} == {k: len(v) for k, v in expected.items()}
        before = {r.customer_id: r.n for r in rollup.totals(one).collect()}
        gained = {r.customer_id: r.n for r in rollup.totals(both, "gained").collect()}
        assert {k: before.get(k, 0) + n for k, n in gained.items()} == {k: len(v) for k, v in expected.items()}


def test_a_slice_is_added_once_and_a_dead_run_changes_nothing(spark, tmp_path, slices, monkeypatch):
    folder, cfg = str(tmp_path / "state"), SegmentConfig(as_of=DATES[0])
    rows = [spark.createDataFrame(s, schemas.ORDERS) for s in slices]
    incremental.advance(spark, folder, rows[0], "a", cfg)
    before = {k: _rows(getattr(incremental.state(spark, folder), k)()) for k in ("days", "words", "totals")}
    monkeypatch.setattr(incremental.strategy, "reliable", lambda df: pytest.fail("read again"))
    incremental.advance(spark, folder, rows[0], "a", cfg)
    monkeypatch.undo()

    def dies(self, *_):
        raise RuntimeError("killed")

    monkeypatch.setattr(Versions, "commit", dies)
    with pytest.raises(RuntimeError, match="killed"):
        incremental.advance(spark, folder, rows[1], "b", cfg)
    monkeypatch.undo()
    held = incremental.state(spark, folder)
    assert held.slices == ["a"] and {k: _rows(getattr(held, k)()) for k in before} == before
    incremental.advance(spark, folder, rows[1], "b", cfg)
    Versions(spark, folder).prune(1)
    held = incremental.state(spark, folder)
    assert held.slices == ["a", "b"] and held.totals().count() > 0 and held.days().count() > 0 and held.words().count() > 0


def test_a_second_run_reads_new_orders_only(spark, tmp_path, slices):
    """Orders are a Parquet table by arrival; the second run's scan is pushed to the new range, and old weeks and ids stay as files."""
    folder, cfg = str(tmp_path / "state"), SegmentConfig(as_of=DATES[1])
    rows = spark.createDataFrame(slices[0] + slices[1], schemas.ORDERS)
    rows.write.parquet(str(tmp_path / "orders"))
    orders = spark.read.parquet(str(tmp_path / "orders"))
    first = incremental.advance_until(spark, folder, orders, "2020-08-10 00:00:00", cfg)
    text = plan(incremental.arrived(orders, "2020-08-10 00:00:00", "2020-08-14 00:00:00"))
    assert "GreaterThanOrEqual(delivered_at" in text and "LessThan(delivered_at" in text
    second = incremental.advance_until(spark, folder, orders, "2020-08-14 00:00:00", cfg)
    assert second.slices == ["until 2020-08-10 00:00:00.000000", "until 2020-08-14 00:00:00.000000"]
    a, b = first.manifest["days"], second.manifest["days"]
    assert set(a) <= set(b) and {d for d in a if a[d] == b[d]} == {d for d in a if d < "2020-08-10"}
    assert incremental.advance_until(spark, folder, orders, "2020-08-11 00:00:00", cfg).slices == second.slices
    delivered = [o for o in slices[0] + slices[1] if o[3] is not None and o[4] == "delivered" and str(o[3]) < "2020-08-14" and o[1] is not None]
    assert {r.customer_id: r.n for r in second.totals().collect()} == {c: len({o[0] for o in delivered if o[1] == c}) for c in {o[1] for o in delivered}}


def test_empty_slices_and_an_empty_state(spark, tmp_path, people):
    cfg = SegmentConfig(as_of=DATES[0])
    folder = str(tmp_path / "state")
    t = tables(spark, people, [])
    assert incremental.customer_history(t, incremental.state(spark, folder), cfg).collect() == []
    held = incremental.advance(spark, folder, spark.createDataFrame([], schemas.ORDERS), "none", cfg)
    assert held.slices == ["none"] and incremental.customer_history(t, held, cfg).collect() == []
    held = incremental.advance(spark, folder, spark.createDataFrame([order(1, 3, "2020-07-20 10:00:00")], schemas.ORDERS), "one", cfg)
    got = incremental.customer_history(t, held, cfg).collect()
    assert [(r.cid, r.total_orders_lifetime, r.recency) for r in got] == [(3, 1, 0)]


def test_one_writer_gets_a_version(spark, tmp_path):
    one, other = Versions(spark, str(tmp_path / "v")), Versions(spark, str(tmp_path / "v"))
    assert one.current() == (0, {})
    one.commit(1, {"a": [1, "x"]})
    with pytest.raises(VersionTaken):
        other.commit(1, {"a": [2]})
    assert other.current() == (1, {"a": [1, "x"]})
    other.commit(2, {"b": "é"})
    one.prune(1)
    assert one.numbers() == [2] and one.current() == (2, {"b": "é"})
