"""Joins whose plain form would not hold for large groups or null keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def anti_null_aware(df: DataFrame, other: DataFrame, col: str, by: str | None = None) -> DataFrame:
    """``col NOT IN (select col from other)`` with SQL null rules.

    A null in ``other`` empties the result; a null in ``df`` passes only if ``other``
    is empty. Both facts are scalar subqueries, so the set itself is never broadcast
    as one null-aware hash table; the rest is an ordinary anti join on distinct keys.

    ``by`` makes the test separate for each of a handful of values, such as days.
    """
    group = F.lit(0) if by is None else F.col(by)
    rows = other.select(group.alias("_by"), F.col(col)).distinct()
    any_row = rows.agg(F.collect_set("_by")).scalar()
    null_row = rows.agg(F.collect_set(F.when(F.col(col).isNull(), F.col("_by")))).scalar()
    wanted = ~F.array_contains(null_row, group) & (
        F.col(col).isNotNull() | ~F.array_contains(any_row, group)
    )
    return (
        df.filter(wanted)
        .withColumn("_by", group)
        .join(rows, ["_by", col], "left_anti")
        .select(*df.columns)
    )


def left_join_many(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join where one left row may match a large part of ``right``.

    An outer join cannot be split on its null-supplying side. The inner part can,
    on both sides, and the unmatched left rows need only the distinct right keys.
    Both inputs are read twice, so pass stored tables or plain scans.
    """
    keys = list(keys)
    matched = left.join(right, keys)
    unmatched = left.join(right.select(*keys).distinct(), keys, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)
