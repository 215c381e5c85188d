"""Manual corrections of one column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def apply_corrections(
    df: DataFrame, column: str, rules: Sequence[tuple[Column, str]]
) -> DataFrame:
    """Set ``column`` to the value of the first rule that holds; else leave it."""
    if not rules:
        return df
    (condition, value), *rest = rules
    chain = F.when(condition, F.lit(value))
    for condition, value in rest:
        chain = chain.when(condition, F.lit(value))
    return df.withColumn(column, chain.otherwise(F.col(column)))
