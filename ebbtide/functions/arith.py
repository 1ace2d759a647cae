"""Null-aware arithmetic used by the scores."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column) -> Column:
    """num / den as a double; NULL (never an error) when den is 0 or NULL.

    Spark runs ANSI mode by default, where ``/`` by zero raises; the
    averages here can legitimately be 0 before the filter that drops them.
    """
    return F.try_divide(num.cast("double"), den.cast("double"))


def total(cols: list[Column]) -> Column:
    """Left-to-right sum, NULL terms counted as 0."""
    return reduce(add, [F.coalesce(c, F.lit(0)) for c in cols])


def present(cols: list[Column]) -> Column:
    """How many of ``cols`` are not NULL."""
    return reduce(add, [F.when(c.isNotNull(), 1).otherwise(0) for c in cols])


def mean_of_present(cols: list[Column]) -> Column:
    """Unweighted mean of the non-NULL columns; NULL when none is present."""
    return ratio(total(cols), present(cols))


def adjacent_change(cols: list[Column]) -> Column:
    """Sum of |c[i] - c[i+1]| over neighbours; a pair with a NULL adds 0."""
    return reduce(
        add, [F.coalesce(F.abs(a - b), F.lit(0)) for a, b in zip(cols, cols[1:])]
    )
