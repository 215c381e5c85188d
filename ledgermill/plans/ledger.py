"""Consolidated cost, credit card, receipts and cost of living.

The yearly source tables come as one DataFrame with the source year in
``ano_fonte``; duplicates are sought within a source year.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.dates import add_calendar, date_lit
from ledgermill.operators.aggregates import money_sum
from ledgermill.operators.joins import left_join_many
from ledgermill.operators.latest import latest_by
from ledgermill.operators.numbering import running_total
from ledgermill.session import stored

YEAR = "ano_fonte"

# Labels, categories and the first month of the cost of living.
CONSOLIDATED = "consolidado"
FORECAST = "previsão"
PENDING = "Sim"
LIVING_CATEGORIES = ("mercado", "alimentação", "compras", "farmacia")
LIVING_SINCE = date(2022, 1, 1)
RECEIPTS_SINCE = date(2021, 1, 1)
FORECAST_YEAR = 2023

# Order matters for speed only: sorts compare the most distinct, fixed-width key first.
COST_KEYS = ("valor_custo", "dt_custo", "custo", "dt_mes_base", YEAR)
CREDIT_KEYS = ("valor_credito_parc", "dt_credito", "custo_credito", "dt_mes_base", YEAR)
RECEIPT_KEYS = ("valor_recebido", "dt_recebido", "descricao", "dt_mes_base", YEAR)


def newest_costs(costs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The last load of each cost; of equal load times the first category."""
    return latest_by(costs, [*by, *COST_KEYS], [F.desc("process_time")], [F.asc("tipo_custo")])


def newest_credits(credits: DataFrame) -> DataFrame:
    return latest_by(
        credits, CREDIT_KEYS, [F.desc("process_time")], [F.asc("tipo_custo_credito")]
    )


def pending_costs(cost_forms: DataFrame, year: int) -> DataFrame:
    return cost_forms.filter((F.col("pendente") == PENDING) & (F.col("ano_base") == year))


def consolidated_cost(costs: DataFrame, cost_forms: DataFrame, year: int = FORECAST_YEAR) -> DataFrame:
    columns = (
        "dt_mes_base", "custo", "tipo_custo", "dt_custo_bq", "valor_custo",
        "ano_base", "mes_base_ordem", "mes_base", "source",
    )
    actual = add_calendar(newest_costs(costs), "dt_mes_base").withColumnRenamed(
        "dt_custo", "dt_custo_bq"
    )
    planned = pending_costs(cost_forms, year).withColumnRenamed("data_base_bq", "dt_mes_base")
    return (
        actual.withColumn("source", F.lit(CONSOLIDATED))
        .select(*columns)
        .unionByName(planned.withColumn("source", F.lit(FORECAST)).select(*columns))
    )


def credit_month(credits: DataFrame) -> DataFrame:
    """Instalments summed per purchase; the calendar follows the purchase date."""
    spent = (
        newest_credits(credits)
        .groupBy("tipo_custo_credito", "custo_credito", "dt_mes_base", "dt_credito")
        .agg(money_sum(F.col("valor_credito_parc")).alias("valor_credito"))
    )
    return add_calendar(spent, "dt_credito").select(
        "tipo_custo_credito", "custo_credito", "dt_mes_base", "dt_credito",
        "ano_base", "mes_base_ordem", "mes_base", "valor_credito",
    )


def ordered_receipts(receipts: DataFrame) -> DataFrame:
    """Distinct receipts with their place in the month, newest first.

    The place counts every loaded row, copies included, so the numbers have gaps.
    Copies of a receipt stand next to each other in that order and the kept row is the
    first of them; its place is therefore one more than the rows of all receipts
    before it, and counting copies replaces sorting them.
    """
    counted = receipts.groupBy(*RECEIPT_KEYS).agg(F.count(F.lit(1)).alias("_loads"))
    order = [F.desc("dt_recebido"), F.desc("valor_recebido"), F.asc("descricao")]
    placed = running_total(counted, [YEAR, "dt_mes_base"], order, "_loads", "_before")
    return placed.select(
        "descricao", "dt_recebido", "dt_mes_base", "valor_recebido",
        (F.col("_before") + 1).alias("ordem_recebimento"),
    )


def receipts_with_forecast(
    receipts: DataFrame,
    forms: DataFrame,
    as_of: str | date,
    loaded_at: datetime,
    since: str | date = RECEIPTS_SINCE,
) -> DataFrame:
    """Receipts beside the open forecasts of the same month, day and value.

    One receipt may meet many forecasts and the other way round, so the join is the
    kind that can be split on both sides.
    """
    kept = stored(ordered_receipts(receipts.filter(F.col("dt_mes_base") >= date_lit(since))))
    keys = ["dt_mes_base", "dt_recebido", "valor_recebido"]
    planned = forms.filter(F.col("dt_recebido") >= date_lit(as_of)).select(
        *keys,
        F.col("descricao").alias("fonte_previsao"),
        F.col("dt_recebido").alias("dt_recebido_previsao"),
        F.col("valor_recebido").alias("valor_recebido_previsao"),
    )
    return left_join_many(kept, planned, keys).select(
        "descricao", "dt_recebido", "dt_mes_base", "valor_recebido", "ordem_recebimento",
        "fonte_previsao", "dt_recebido_previsao", "valor_recebido_previsao",
        F.when(F.col("valor_recebido_previsao").isNull(), "Historico")
        .otherwise("Previsto")
        .alias("source"),
        F.lit(loaded_at).alias("data_atualizacao_jobs"),
    )


def cost_of_living(
    costs: DataFrame,
    credits: DataFrame,
    since: str | date = LIVING_SINCE,
    categories: Sequence[str] = LIVING_CATEGORIES,
) -> DataFrame:
    """Debit costs and credit purchases of the chosen categories."""
    debit = (
        newest_costs(costs)
        .groupBy("tipo_custo", "custo", "dt_mes_base", "dt_custo")
        .agg(money_sum(F.col("valor_custo")).alias("valor_custo"))
        .withColumn("source", F.lit("debito"))
    )
    credit = (
        newest_credits(credits)
        .groupBy(YEAR, "dt_credito", "custo_credito", "tipo_custo_credito")
        .agg(money_sum(F.col("valor_credito_parc")).alias("valor_custo"))
        .select(
            F.col("tipo_custo_credito").alias("tipo_custo"),
            F.col("custo_credito").alias("custo"),
            F.col("dt_credito").alias("dt_mes_base"),
            F.col("dt_credito").alias("dt_custo"),
            "valor_custo",
            F.lit("credito").alias("source"),
        )
    )
    chosen = debit.unionByName(credit).filter(
        (F.col("dt_mes_base") >= date_lit(since)) & F.col("tipo_custo").isin(*categories)
    )
    return add_calendar(chosen, "dt_mes_base", week=True).select(
        "dt_mes_base", "custo", "tipo_custo", "dt_custo", "semana_base",
        "ano_base", "mes_base_ordem", "mes_base", "source", "valor_custo",
    )
