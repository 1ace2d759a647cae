"""ebbtide: find regular customers whose order rate has dropped, on Spark.

Public entry points::

    from ebbtide import SegmentConfig, lists, tables
    t = tables.load(spark, customers=..., orders=..., subscriptions=..., metros=...)
    cfg = SegmentConfig(as_of="2020-08-14 12:00:00")
    lists.base_list(t, cfg)      # date, customer_id, sub_group
    lists.metro_list(t, cfg)     # + metro
    lists.test_list(t, cfg)      # + test_cohort
    lists.detail_list(t, cfg)    # run_date, 23 measures, sub_group
    lists.all_lists(t, cfg)      # all four from one pass over orders
"""

from .config import SegmentConfig
from .plans import lists
from .sources import tables

__all__ = ["SegmentConfig", "lists", "tables"]
