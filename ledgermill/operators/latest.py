"""One row, or all tied rows, per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], ties: Sequence[Column] = ()
) -> DataFrame:
    """First row of each group by ``order`` then ``ties``.

    Spark puts a group limit before the shuffle, so each task sends at most one row
    per group and a group holding much of the table costs no more than any other.
    """
    window = Window.partitionBy(*keys).orderBy(*order, *ties)
    return (
        df.withColumn("_place", F.row_number().over(window))
        .filter(F.col("_place") == 1)
        .drop("_place")
    )


def latest_ties(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Every row that holds the greatest ``order`` of its group (rank 1, descending).

    The tied rows can be an unbounded part of one group, so they never meet in one
    window: the greatest value of each group is a pre-aggregated maximum, and an inner
    join, which the adaptive planner may split on both sides, picks the rows.
    """
    best = df.groupBy(*keys).agg(F.max(order).alias(order))
    match = F.struct(*keys, order)
    best = best.select(match.alias("_match"))
    return df.withColumn("_match", match).join(best, "_match").select(*df.columns)
