"""Month-by-month balance chained through a window instead of month after month."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Forecast formulas: subtract forecast and real costs, or forecast costs only.
ALL_COSTS = "all_costs"
FORECAST_COSTS = "forecast_costs"


@dataclass(frozen=True)
class BalancePolicy:
    """How months treat nulls and forecasts: a rule for every month, and the exceptions.

    Every month of the input is reported. ``first`` and ``last`` limit the report if given.
    """

    first: date | None = None
    last: date | None = None
    strict_years: frozenset[int] = frozenset()
    forecast_from: date | None = None
    no_forecast: frozenset[date] = frozenset()
    forecast_balance: Mapping[date, str] = field(default_factory=dict)

    def wanted(self, month: Column) -> Column:
        kept = F.lit(True)
        if self.first is not None:
            kept = kept & (month >= F.lit(self.first))
        if self.last is not None:
            kept = kept & (month <= F.lit(self.last))
        return kept

    def rules(self, month: Column) -> dict[str, Column]:
        """``_strict``, ``_forecast`` and ``_formula`` of a month."""
        forecast = F.lit(False)
        if self.forecast_from is not None:
            forecast = (month >= F.lit(self.forecast_from)) & ~month.isin(*self.no_forecast)
        formula = F.lit(None).cast("string")
        for exception, name in self.forecast_balance.items():
            formula = F.when(month == F.lit(exception), name).otherwise(formula)
        return {"_strict": F.year(month).isin(*self.strict_years), "_forecast": forecast, "_formula": formula}


# The exceptions of the ledger.
LEDGER_POLICY = BalancePolicy(
    strict_years=frozenset({2021}),
    forecast_from=date(2022, 3, 1),
    no_forecast=frozenset({date(2023, 1, 1)}),
    forecast_balance={date(2023, 7, 1): ALL_COSTS, date(2023, 8, 1): FORECAST_COSTS},
)


def running_balance(
    months: DataFrame,
    policy: BalancePolicy = LEDGER_POLICY,
    by: Sequence[str] = (),
) -> DataFrame:
    """Balance of every month from that month's flow and the balance before it.

    ``months`` has one row per ``by`` and ``dt_mes_base`` with ``valor_recebido``,
    ``valor_recebido_prev``, ``custo_prev``, ``custo_real`` and ``saldo``, the bank
    balance that opens a January. A window holds the at most twelve rows of one
    account and year.

    The chain restarts at 0 after a missing month and after a month without costs,
    whose own balance is null. In a strict year it does not restart: from there on,
    and without an opening balance, every month is null.
    """
    rows = months.filter(policy.wanted(F.col("dt_mes_base"))).withColumns(policy.rules(F.col("dt_mes_base")))
    month = F.month("dt_mes_base")
    rows = rows.withColumns(
        {
            "_year": F.year("dt_mes_base"),
            "_flow": F.col("valor_recebido") - F.col("custo_real"),
            "_opening": F.when(month == 1, F.col("saldo")),
            "valor_recebido_prev": F.when(F.col("_forecast"), F.col("valor_recebido_prev")).otherwise(0),
            "custo_prev": F.when(F.col("_forecast"), F.col("custo_prev")).otherwise(0),
        }
    )

    year = Window.partitionBy(*by, "_year").orderBy("dt_mes_base")
    so_far = year.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    follows = F.add_months(F.lag("dt_mes_base").over(year), 1) == F.col("dt_mes_base")
    rows = rows.withColumn("_follows", F.coalesce(follows, F.lit(False)))
    chained = F.col("_follows") & F.lag("_flow").over(year).isNotNull()
    rows = rows.withColumns(
        {
            "_starts": F.when(chained, 0).otherwise(1),
            "_unbroken": F.count("_flow").over(so_far) == month,
            "_year_flow": F.sum("_flow").over(so_far) + F.first("_opening").over(so_far),
        }
    )

    # A chain's sum is the year's sum so far less that before the chain's first month: one sort does for all windows.
    step = F.coalesce("_flow", F.lit(0)) + F.coalesce("_opening", F.lit(0))
    rows = rows.withColumns({"_step": step, "_steps": F.sum(step).over(so_far)})
    first = F.when(F.col("_starts") == 1, F.col("_steps") - F.col("_step"))
    in_chain = F.col("_steps") - F.last(first, ignorenulls=True).over(so_far)
    balance = F.when(F.col("_strict"), F.when(F.col("_unbroken"), F.col("_year_flow"))).otherwise(
        F.when(F.col("_flow").isNotNull(), in_chain)
    )
    rows = rows.withColumn("saldo_real", balance)

    before = F.when(F.col("_follows"), F.lag("saldo_real").over(year))
    before = F.coalesce(F.when(month == 1, F.col("saldo")).otherwise(before), F.lit(0))
    formula = F.col("_formula")
    forecast = (
        F.when(
            formula == ALL_COSTS,
            F.col("valor_recebido_prev") - (F.col("custo_prev") + F.col("custo_real")) + before,
        )
        .when(
            formula == FORECAST_COSTS, F.col("valor_recebido_prev") - F.col("custo_prev") + before
        )
        .otherwise(0)
    )
    amounts = {
        "valor_recebido": F.col("valor_recebido"),
        "valor_recebido_prev": F.col("valor_recebido_prev"),
        "valor_custo_prev": F.col("custo_prev"),
        "valor_custo_real": F.col("custo_real"),
        "saldo_prev": forecast,
        "saldo_real": F.col("saldo_real"),
    }
    return rows.select(
        *by, "dt_mes_base", *[c.cast("double").alias(name) for name, c in amounts.items()]
    )
