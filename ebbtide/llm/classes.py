"""Rows joined with the classes that they belong to, where one class may hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A class is large from this share of all rows on; so there are this many large classes at most.
SHARES = 1024


def attach(rows: DataFrame, classes: DataFrame, on: list[str], size: str, total: int) -> DataFrame:
    """``rows`` left-joined with ``classes`` (unique in ``on``) on columns without nulls.

    ``size`` is the number of rows of a class and ``total`` that of all rows. The
    at most ``SHARES`` classes with 1/``SHARES`` of the rows or more are broadcast,
    so no key of the shuffled join holds more than that share.
    """
    large = F.col(size) * SHARES >= F.lit(total)
    hot = classes.filter(large)
    met = rows.join(F.broadcast(hot), on, "inner")
    rest = rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(classes.filter(~large), on, "left")
    return met.unionByName(rest)
