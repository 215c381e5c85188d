"""The balance as a table by year, of which a run computes the open years and those that late rows reopen."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.functions.dates import date_lit, datetime_lit
from ledgermill.operators.balance import LEDGER_POLICY, BalancePolicy, running_balance
from ledgermill.plans.balance import monthly_flows
from ledgermill.plans.ledger import FORECAST_YEAR
from ledgermill.session import smaller_tasks, stored
from ledgermill.sources.writers import remove_partitions, table_exists

#: Partition column of the stored balance.
YEAR_OF = "ano_saldo"


def in_years(month: str, years: Iterable[int]) -> Column:
    """Ranges of the stored date, which reach the scan; no year is no row."""
    ranges = [
        (F.col(month) >= date_lit(date(year, 1, 1))) & (F.col(month) <= date_lit(date(year, 12, 31))) for year in sorted(set(years))
    ]
    return reduce(lambda a, b: a | b, ranges, F.lit(False))


def reopened_years(
    receipts: DataFrame,
    costs: DataFrame,
    balances: DataFrame,
    forms: DataFrame,
    since: datetime,
    before: str | date,
    as_of: str | date,
) -> list[int]:
    """Years of rows loaded after ``since``, and of receipt forecasts that fell due between two runs."""
    loaded = [df.filter(F.col("process_time") > datetime_lit(since)).select("dt_mes_base") for df in (receipts, costs, balances)]
    low, high = F.least(date_lit(before), date_lit(as_of)), F.greatest(date_lit(before), date_lit(as_of))
    due = forms.filter((F.col("dt_recebido") >= low) & (F.col("dt_recebido") < high)).select("dt_mes_base")
    months = reduce(DataFrame.union, [*loaded, due])
    # One row for each year.
    return sorted(r[0] for r in months.select(F.year("dt_mes_base")).distinct().collect() if r[0] is not None)


def balance_of_years(
    receipts: DataFrame,
    forms: DataFrame,
    costs: DataFrame,
    cost_forms: DataFrame,
    balances: DataFrame,
    as_of: str | date,
    years: Iterable[int],
    forecast_year: int = FORECAST_YEAR,
    by: Sequence[str] = (),
    policy: BalancePolicy = LEDGER_POLICY,
) -> DataFrame:
    """``monthly_balance`` of some years, from the rows of their months only.

    A January takes its opening balance from the bank, and no other month is chained over the turn of a year; the month
    is also part of every duplicate rule. So a year's balance depends on that year's rows alone.
    """
    years = list(years)
    parts = [df.filter(in_years("dt_mes_base", years)) for df in (receipts, forms, costs)]
    due = cost_forms.filter(in_years("data_base_bq", years))
    opening = balances.filter(in_years("dt_mes_base", years))
    return running_balance(monthly_flows(*parts, due, opening, as_of, forecast_year, by), policy, by)


def refresh_balance(
    spark: SparkSession,
    path: str,
    receipts: DataFrame,
    forms: DataFrame,
    costs: DataFrame,
    cost_forms: DataFrame,
    balances: DataFrame,
    as_of: str | date,
    years: Iterable[int] | None = None,
    forecast_year: int = FORECAST_YEAR,
    by: Sequence[str] = (),
    policy: BalancePolicy = LEDGER_POLICY,
) -> None:
    """Replace ``years`` of the stored balance; without them, or if it does not exist yet, all.

    Give the open year, ``forecast_year``, whose pending costs change without a load time, and ``reopened_years``.
    A year that has no rows any more loses its folder.
    """
    args = (receipts, forms, costs, cost_forms, balances, as_of)
    if years is None or not table_exists(spark, path):
        rows, years = running_balance(monthly_flows(*args, forecast_year, by), policy, by), None
    else:
        years = sorted(set(years))
        rows = balance_of_years(*args, years, forecast_year, by, policy)
    # At most twelve rows for an account and year; what is computed once decides what is removed.
    with smaller_tasks(spark):
        rows = stored(rows.withColumn(YEAR_OF, F.year("dt_mes_base")))
    mode = "static" if years is None else "dynamic"
    laid = rows.hint("rebalance", YEAR_OF)
    laid.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(YEAR_OF).parquet(path)
    if years:
        held = {r[0] for r in rows.select(YEAR_OF).distinct().collect()}  # one value for each year
        remove_partitions(spark, path, YEAR_OF, [str(y) for y in years if y not in held])
    spark.catalog.refreshByPath(path)
