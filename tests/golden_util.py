"""Build tiny input tables by hand for golden-row tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from ebbtide.sources import schemas
from ebbtide.sources.tables import Tables


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


DEFAULT = object()


def customer(id, created="2019-06-01 10:00:00", deleted=None, payment=DEFAULT, name="Jo",
             ctype="consumer", metro=1, bucket=10):
    pay = f"cus_{id}" if payment is DEFAULT else payment
    return (id, ts(created), deleted and ts(deleted), pay, name, ctype, metro,
            None if bucket is None else float(bucket))


def order(id, cid, created, status="delivered", delivered=True, subtotal="10.00"):
    at = ts(created)
    return (id, cid, at, at if delivered else None, status,
            None if subtotal is None else Decimal(subtotal))


def sub(cid, origination="platform", deleted=None, abandoned=None, churned=None):
    return (cid, origination, deleted and ts(deleted), abandoned and ts(abandoned),
            churned and ts(churned))


def tables(spark, customers, orders, subs=None, metros=None) -> Tables:
    subs = subs if subs is not None else [sub(c[0]) for c in customers]
    metros = metros if metros is not None else [(1, "Metro One"), (2, "Metro Two")]
    return Tables(
        customers=spark.createDataFrame(customers, schemas.CUSTOMERS),
        orders=spark.createDataFrame(orders, schemas.ORDERS),
        subscriptions=spark.createDataFrame(subs, schemas.SUBSCRIPTIONS),
        metros=spark.createDataFrame(metros, schemas.METROS),
    )


class Orders:
    """Allocates order ids."""

    def __init__(self):
        self.next = 1
        self.rows = []

    def add(self, cid, *created, **kw):
        for c in created:
            self.rows.append(order(self.next, cid, c, **kw))
            self.next += 1
        return self


# A regular, declining customer at as_of 2020-08-14 12:00: first order before
# every window edge, 9 orders in windows 2-6 (average 1.8), some in the recency
# range, and one order 25 days ago as the only order of window 1.
STOPPER_HISTORY = (
    "2020-02-10 10:00:00",  # first order, before window 6
    "2020-03-01 10:00:00",  # w6
    "2020-03-20 10:00:00", "2020-04-01 10:00:00",  # w5
    "2020-04-20 10:00:00", "2020-05-01 10:00:00",  # w4
    "2020-05-20 10:00:00", "2020-06-01 10:00:00",  # w3
    "2020-06-20 10:00:00", "2020-07-01 10:00:00",  # w2
    "2020-07-20 10:00:00",  # w1, 25 days before as_of
)
