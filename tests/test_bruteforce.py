"""The Spark pipeline against a brute-force Python evaluation of the same rules.

Orders are generated around every window edge (exact edge, one microsecond
either side, midnight and last microsecond of the edge's day), with duplicate
order ids, cancelled and undelivered orders, and orders after ``as_of``; the
clock is taken at midday, midnight, the last microsecond of a day and on
month ends (so calendar-month shifts clamp).
"""

from __future__ import annotations

import calendar
import datetime as dt
import random
import zlib

import pytest

from ebbtide.config import SegmentConfig
from ebbtide.operators import scoring, segments
from ebbtide.plans import lists
from golden_util import customer, order, tables

D = dt.timedelta


def shift_months(ts: dt.datetime, n: int) -> dt.datetime:
    y, m = divmod(ts.month - 1 + n, 12)
    y, m = ts.year + y, m + 1
    return ts.replace(year=y, month=m, day=min(ts.day, calendar.monthrange(y, m)[1]))


def midnight(ts: dt.datetime) -> dt.datetime:
    return dt.datetime(ts.year, ts.month, ts.day)


def brute(orders, now: dt.datetime, cfg: SegmentConfig):
    """cid -> measures, for regular customers, straight from the rules."""
    by = {}
    for oid, cid, created, delivered_at, status, _ in orders:
        if status == cfg.delivered_status and delivered_at is not None:
            by.setdefault(cid, []).append((oid, created))
    out = {}
    for cid, rows in by.items():
        first = min(c for _, c in rows)
        last = max(c for _, c in rows)
        n = len({oid for oid, _ in rows})
        rec_lo, rec_hi = shift_months(now, -3), shift_months(now, -1)
        rec = sum(rec_lo <= midnight(c) <= rec_hi for _, c in rows)
        if not (n >= cfg.min_orders and rec >= cfg.min_recent
                and first < shift_months(now, -cfg.tenure_months)):
            continue
        w = []
        for k in range(6):
            lo, hi = now - D(days=30 * (k + 1)), now - D(days=30 * k)
            w.append(None if lo < first else sum(lo <= midnight(c) <= hi for _, c in rows))
        base = [x for x in w[1:] if x is not None]
        avg = sum(base) / len(base)
        change = sum(abs(a - b) for a, b in zip(w, w[1:]) if a is not None and b is not None)
        mag = None if avg == 0 else change / avg
        gap = None if avg == 0 else 30 / avg
        days = (now.date() - last.date()).days
        out[cid] = dict(w=w, avg=avg, mag=mag, gap=gap, days=days, first=first, last=last, n=n,
                        label=label(avg, days, gap, mag),
                        listed=avg >= 1 and avg * 0.75 > w[0])
    return out


def label(avg, days, gap, mag):
    if gap is None:
        return "Other"
    casual, core, power = avg < 2.5, 2.5 <= avg < 4.5, avg >= 4.5
    if casual and days >= gap * 1.5:
        return "Casual Stopper"
    if core and days >= gap * 2.25:
        return "Core Stopper"
    if power and days >= gap * 2.5:
        return "Power Stopper"
    if casual and days < gap * 1.5:
        return "Casual Decreaser"
    if core and mag <= 3 and days < gap * 2.25:
        return "Regular Core Decreaser"
    if core and mag > 3 and days < gap * 2.25:
        return "Erratic Core Decreaser"
    if power and mag <= 2 and days < gap * 2.5:
        return "Regular Power Decreaser"
    if power and mag > 2 and days < gap * 2.5:
        return "Erratic Power Decreaser"
    return "Other"


def generate(now: dt.datetime, seed: int, n_customers: int = 160):
    rnd = random.Random(seed)
    edges = [now - D(days=30 * k) for k in range(7)]
    edges += [shift_months(now, -m) for m in (1, 3, 4)]
    tiny = D(microseconds=1)
    orders, oid = [], 1
    for cid in range(1, n_customers + 1):
        rate = rnd.choice([0.5, 1, 2, 3, 4, 6])  # orders per 30 days
        start = now - D(days=rnd.choice([100, 125, 150, 175, 200, 260]))
        times = []
        t = start
        while t < now + D(days=3):
            times.append(t)
            t += D(seconds=rnd.expovariate(rate / (30 * 86400)))
        for _ in range(rnd.randint(0, 4)):  # pile orders on the edges
            e = rnd.choice(edges)
            times.append(rnd.choice([e, e - tiny, e + tiny, midnight(e),
                                     midnight(e) + D(days=1) - tiny]))
        if rnd.random() < 0.2:  # first order exactly on an edge
            times.append(rnd.choice(edges[4:7]))
        for t in times:
            status = "cancelled" if rnd.random() < 0.05 else "delivered"
            delivered = rnd.random() > 0.03
            orders.append(order(oid, cid, t.isoformat(sep=" "), status=status,
                                delivered=delivered))
            if rnd.random() < 0.03:  # duplicated order id
                orders.append(order(oid, cid, t.isoformat(sep=" ")))
            oid += 1
    return orders


@pytest.mark.parametrize("as_of", [
    "2020-08-14 12:00:00",
    "2020-08-14 00:00:00",
    "2020-08-14 23:59:59.999999",
    "2020-03-31 12:00:00",
    "2021-05-31 06:30:00",
])
def test_pipeline_equals_brute_force(spark, as_of):
    now = dt.datetime.fromisoformat(as_of)
    cfg = SegmentConfig(as_of=as_of)
    orders = generate(now, seed=zlib.crc32(as_of.encode()))
    ids = sorted({o[1] for o in orders})
    t = tables(spark, [customer(i) for i in ids], orders)
    expect = brute(orders, now, cfg)
    scored = scoring.score(lists.regular_history(t, cfg), cfg).withColumn(
        "sub_group", segments.sub_group(cfg)).collect()
    got = {r["cid"]: r for r in scored}
    assert set(got) == set(expect)
    assert len(expect) > 20
    for cid, e in expect.items():
        r = got[cid]
        w = [r[f"{n}_order_count"] for n in cfg.window_names]
        assert w == e["w"], cid
        assert r["total_orders_lifetime"] == e["n"]
        assert r["first_order_date"] == e["first"] and r["last_order_date"] == e["last"]
        assert r[scoring.AVG] == e["avg"]
        assert r[scoring.MAGNITUDE] == e["mag"]
        assert r[scoring.GAP] == e["gap"]
        assert r[scoring.DAYS_SINCE] == e["days"]
        assert r["sub_group"] == e["label"], cid
    listed = {r["customer_id"] for r in lists.base_list(t, cfg).collect()}
    assert listed == {c for c, e in expect.items() if e["listed"]}
