"""Exact money sums, conditional sums and run statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Six decimals keep instalments such as 100 / 3; a sum then has 38 digits.
MONEY = "decimal(28,6)"


def money(amount: Column) -> Column:
    """Amount as DECIMAL, rounded to six decimals: sums are exact, so they do not depend on
    partition order. An amount of 10^22 or more, or none at all such as NaN, is an error."""
    exact = amount.try_cast(MONEY)
    lost = F.raise_error(F.lit("an amount does not fit the money type")).cast(MONEY)
    return F.when(amount.isNotNull() & exact.isNull(), lost).otherwise(exact)


def money_sum(amount: Column) -> Column:
    return F.sum(money(amount)).cast("double")


def pivot_sum(
    df: DataFrame, keys: Sequence[str], tag: str, value: str, tags: Mapping[str, str]
) -> DataFrame:
    """One summed column per tag; rows with another tag count as 0."""
    sums = [
        money_sum(F.when(F.col(tag) == wanted, F.col(value)).otherwise(0)).alias(name)
        for wanted, name in tags.items()
    ]
    return df.groupBy(*keys).agg(*sums)


def paid_runs(
    df: DataFrame, keys: Sequence[str], time: str, cost: str, payload: Sequence[str] = ()
) -> DataFrame:
    """One row per group and run instant with a cost above 0: the highest cost, and
    ``payload`` (a struct) of that row. Pre-aggregated before the shuffle."""
    kept = [F.max(F.struct(cost, *payload)).alias("_best")] if payload else [F.max(cost).alias(cost)]
    runs = df.filter(F.col(cost) > 0).groupBy(*keys, time).agg(*kept)
    if payload:
        runs = runs.select(*keys, time, "_best.*")
    return runs


def run_stats(df: DataFrame, keys: Sequence[str], time: str, cost: str) -> DataFrame:
    """First and last run, number of runs and total of the rounded costs per group.

    Costs are rounded before they are summed.
    """
    return df.groupBy(*keys).agg(
        F.min(time).alias("first_run"),
        F.max(time).alias("last_run"),
        money_sum(F.round(cost, 2)).alias("total_cost"),
        F.count(F.lit(1)).alias("runs"),
    )


def mean_cost(total: Column, runs: Column) -> Column:
    return F.round(total / runs, 2)
