"""The lists as SQL temp views, for users who query them with spark.sql."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..config import SegmentConfig
from ..sources.tables import Tables
from . import lists

VIEW_NAMES = {
    "base": "lapse_list",
    "metro": "lapse_list_metro",
    "test": "lapse_list_test",
    "details": "lapse_list_details",
}


def register(tables: Tables, cfg: SegmentConfig) -> dict[str, DataFrame]:
    """Compute the lists in one pass over orders and register them as views."""
    out = lists.all_lists(tables, cfg)
    for key, df in out.items():
        df.createOrReplaceTempView(VIEW_NAMES[key])
    return out
