"""Monthly balance: receipts, costs, forecasts and opening balances in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.dates import date_lit
from ledgermill.operators.aggregates import money
from ledgermill.operators.balance import LEDGER_POLICY, BalancePolicy, running_balance
from ledgermill.plans.ledger import COST_KEYS, FORECAST_YEAR, RECEIPT_KEYS, YEAR, pending_costs
from ledgermill.session import smaller_tasks, stored

FLOWS = ("valor_recebido", "valor_recebido_prev", "custo_prev", "custo_real", "saldo")


def _flows(df: DataFrame, by: Sequence[str], month: str, **amounts: Column) -> DataFrame:
    """Rows as (by, month, five amounts); an amount the source lacks is null."""
    return df.select(
        *by,
        F.col(month).alias("dt_mes_base"),
        *[money(amounts.get(name, F.lit(None))).alias(name) for name in FLOWS],
    )


def opening_balances(balances: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The first balance of each month, if it is also the last load of its duplicates.

    A month whose first row was loaded again later has no opening balance. Loads of
    one row are reduced to their first and last load time, so the row passes if the
    two are equal; unloaded (null) times sort first and are never the last.
    """
    loads = (
        balances.filter(F.col("saldo").isNotNull())
        .groupBy(*by, YEAR, "dt_mes_base", "dt_recebido", "saldo", "descricao")
        .agg(
            F.when(F.count("process_time") == F.count(F.lit(1)), F.min("process_time")).alias(
                "_first_load"
            ),
            F.max("process_time").alias("_last_load"),
        )
    )
    rank = F.struct("dt_recebido", "_first_load", "saldo", "descricao", "_last_load")
    first = loads.groupBy(*by, YEAR, "dt_mes_base").agg(F.min(rank).alias("_row"))
    return first.filter(F.col("_row._first_load").eqNullSafe(F.col("_row._last_load"))).select(
        *by, YEAR, "dt_mes_base", "_row.descricao", "_row.dt_recebido", "_row.saldo"
    )


def monthly_flows(
    receipts: DataFrame,
    forms: DataFrame,
    costs: DataFrame,
    cost_forms: DataFrame,
    balances: DataFrame,
    as_of: str | date,
    forecast_year: int = FORECAST_YEAR,
    by: Sequence[str] = (),
    spent: DataFrame | None = None,
) -> DataFrame:
    """One row per month that has receipts or open receipt forecasts.

    The kept values are key columns of the duplicate rule, so a distinct, which is
    pre-aggregated, replaces the choice of the latest row. The five kinds of amount
    are stacked and summed once; no join is needed. ``spent`` are the distinct costs, if they are known already.
    """
    received = receipts.select(*by, *RECEIPT_KEYS).distinct()
    planned = forms.filter(F.col("dt_recebido") >= date_lit(as_of))
    if spent is None:
        spent = costs.select(*by, *COST_KEYS).distinct()
    due = pending_costs(cost_forms, forecast_year)
    opening = opening_balances(balances.filter(F.month("dt_mes_base") == 1), by)

    zero = F.lit(0)
    parts = [
        _flows(received, by, "dt_mes_base", valor_recebido=F.col("valor_recebido"), valor_recebido_prev=zero),
        _flows(planned, by, "dt_mes_base", valor_recebido=zero, valor_recebido_prev=F.col("valor_recebido")),
        _flows(spent, by, "dt_mes_base", custo_prev=zero, custo_real=F.col("valor_custo")),
        _flows(due, by, "data_base_bq", custo_prev=F.col("valor_custo"), custo_real=zero),
    ]
    rows = parts[0].withColumn("_receipt", F.lit(True))
    rows = rows.unionByName(parts[1].withColumn("_receipt", F.lit(True)))
    for part in (parts[2], parts[3], _flows(opening, by, "dt_mes_base", saldo=F.col("saldo"))):
        rows = rows.unionByName(part.withColumn("_receipt", F.lit(False)))
    return (
        rows.groupBy(*by, "dt_mes_base")
        .agg(F.max("_receipt").alias("_receipt"), *[F.sum(name).alias(name) for name in FLOWS])
        .filter("_receipt")
        .drop("_receipt")
    )


def monthly_balance(
    receipts: DataFrame,
    forms: DataFrame,
    costs: DataFrame,
    cost_forms: DataFrame,
    balances: DataFrame,
    as_of: str | date,
    forecast_year: int = FORECAST_YEAR,
    by: Sequence[str] = (),
    policy: BalancePolicy = LEDGER_POLICY,
    spent: DataFrame | None = None,
) -> DataFrame:
    """The running balance of ``monthly_flows``, which are stored: by tasks small enough for sums by account, of which
    a task holds nearly as many as rows."""
    flows = monthly_flows(receipts, forms, costs, cost_forms, balances, as_of, forecast_year, by, spent)
    with smaller_tasks(flows.sparkSession):
        flows = stored(flows)
    return running_balance(flows, policy, by)
