"""``NOT IN`` over a subquery as a join that needs no broadcast, and keys that must be unique.

Spark joins a null-aware anti-join only by broadcasting the subquery's side. Here
two numbers about that side (its rows, its NULLs) decide what NULLs mean, as scalar
subqueries of one row, and the rest is a plain anti-join that Spark may shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_in(df: DataFrame, key: str, banned: DataFrame) -> DataFrame:
    """Rows of ``df`` WHERE ``key`` NOT IN ``banned`` (its one column).

    As in SQL: a NULL in ``banned`` leaves no row; a NULL key passes only where
    ``banned`` is empty.
    """
    (name,) = banned.columns
    n = banned.agg(F.count(F.lit(1))).scalar()
    nulls = banned.agg(F.count_if(F.col(name).isNull())).scalar()
    open_rows = df.filter((nulls == 0) & (F.col(key).isNotNull() | (n == 0)))
    # combined map-side: a banned key comes once a task
    ids = banned.filter(F.col(name).isNotNull()).select(F.col(name).alias(key)).distinct()
    return open_rows.join(ids, key, "left_anti")


def unique(df: DataFrame, key: str) -> DataFrame:
    """``df``, whose rows must differ in ``key``: a key found twice stops the job.

    Grouped by the key, so a join by it that follows needs no exchange of its own.
    The check is part of the key that is returned and cannot be pruned.
    """
    rest = [c for c in df.columns if c != key]
    grouped = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *[F.any_value(c).alias(c) for c in rest])
    message = F.concat(F.lit(f"{key} "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")), F.lit(" is there more than once"))
    checked = F.when(F.col("_n") > 1, F.raise_error(message).cast(df.schema[key].dataType)).otherwise(F.col(key))
    return grouped.select(checked.alias(key), *rest)
