"""The two scheduled runs: the ledger refresh and the monitoring run."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill import schemas
from ledgermill.functions.dates import day_of
from ledgermill.operators.balance import LEDGER_POLICY, BalancePolicy
from ledgermill.plans import access, balance, history, inventory, jobs, ledger, monitor, rollup, snapshot
from ledgermill.plans.ledger import YEAR
from ledgermill.session import intermediate
from ledgermill.sources.writers import (
    append_run,
    on_load_days,
    read_stored,
    replace_load_days,
    replace_table,
)

# Names of the stored tables.
COSTS = "custo_consolidado_2022"
CREDITS = "credito_mes"
RECEIPTS = "recebimento_geral_2022"
BALANCE = "saldo_mes_2022"
LIVING = "custo_vida_2022"
JOBS = "information_executor_jobs"
DETAILS = "information_details_jobs"
HISTORY = "historico_info_tabelas"
SNAPSHOT = "consolidado_info_tabelas"
FACTS = "ultimo_uso_e_custo_tabelas"
DAILY = "execucoes_por_dia"
MONITOR = "monitoria_tabelas_ativas"

LIVING_COST_YEARS = (2022,)
LIVING_CREDIT_YEARS = (2022, 2023)


@dataclass(frozen=True)
class LedgerInputs:
    costs: DataFrame
    credits: DataFrame
    receipts: DataFrame
    balances: DataFrame
    cost_forms: DataFrame
    receipt_forms: DataFrame


@dataclass(frozen=True)
class WarehouseInputs:
    job_log: DataFrame
    catalog: DataFrame
    access_log: DataFrame
    table_costs: DataFrame


def ledger_tables(
    inputs: LedgerInputs,
    as_of: str | date,
    loaded_at: datetime,
    forecast_year: int = ledger.FORECAST_YEAR,
    policy: BalancePolicy = LEDGER_POLICY,
    living_cost_years: Sequence[int] = LIVING_COST_YEARS,
    living_credit_years: Sequence[int] = LIVING_CREDIT_YEARS,
    spent: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The five ledger tables in the order of the run; none reads another, unless ``spent`` are the first one's costs."""
    i = inputs
    return {
        COSTS: ledger.consolidated_cost(i.costs, i.cost_forms, forecast_year),
        CREDITS: ledger.credit_month(i.credits),
        RECEIPTS: ledger.receipts_with_forecast(i.receipts, i.receipt_forms, as_of, loaded_at),
        BALANCE: balance.monthly_balance(
            i.receipts, i.receipt_forms, i.costs, i.cost_forms, i.balances, as_of,
            forecast_year, policy=policy, spent=spent,
        ),
        LIVING: ledger.cost_of_living(
            i.costs.filter(i.costs[YEAR].isin(*living_cost_years)),
            i.credits.filter(i.credits[YEAR].isin(*living_credit_years)),
        ),
    }


def distinct_costs(costs: DataFrame, path: str) -> DataFrame | None:
    """The costs in the consolidated table at ``path``, which holds each of ``costs`` once; none if it holds them as
    another type."""
    kept = costs.sparkSession.read.parquet(path).filter(F.col("source") == ledger.CONSOLIDATED)
    same = all(kept.schema[c].dataType == costs.schema[c].dataType for c in ("dt_mes_base", "valor_custo"))
    return kept if same else None


def refresh_finance(inputs: LedgerInputs, root: str, as_of: str | date, loaded_at: datetime, **options) -> None:
    """Write the five ledger tables under ``root``. The balance reads its costs from the consolidated table just
    written, so their duplicates are sought once."""
    with intermediate(inputs.costs.sparkSession):
        year = options.get("forecast_year", ledger.FORECAST_YEAR)
        replace_table(ledger.consolidated_cost(inputs.costs, inputs.cost_forms, year), f"{root}/{COSTS}")
        spent = distinct_costs(inputs.costs, f"{root}/{COSTS}")
        for name, df in ledger_tables(inputs, as_of, loaded_at, spent=spent, **options).items():
            if name != COSTS:
                replace_table(df, f"{root}/{name}")


def append_details(details: DataFrame, root: str, run: str) -> None:
    """Append table details by the day of their job; a repeated run replaces its own."""
    append_run(details, f"{root}/{DETAILS}", schemas.DETAILS, run, moment=history.RUN)


def monitoring_run(
    spark: SparkSession,
    inputs: WarehouseInputs,
    root: str,
    as_of: datetime,
    project: str,
    flag_prefixes: Iterable[str],
    snapshot_prefixes: Iterable[str],
    flag_users: Iterable[str] = (),
    snapshot_users: Iterable[str] = (),
    days: int = 10,
    offsets: Iterable[int] = monitor.RESTATED_OFFSETS,
) -> None:
    """Job costs, details, history of the restated days, snapshot, roll-up by day, monitor.

    Each merge reads and replaces only the load days it can change, and reads only the
    details of those days, of the days before them, and of tables without a run. The
    lifetime figures come from the stored roll-up, of which a run computes the restated days; the
    first run computes all. The snapshot is rebuilt where history, users or costs changed. A
    log that is stored by local day is read in the folders of these days only.
    """
    with intermediate(spark):
        _monitoring_steps(
            spark, inputs, root, as_of, project, list(flag_prefixes), list(snapshot_prefixes),
            list(flag_users), list(snapshot_users), days, list(offsets),
        )


def _monitoring_steps(
    spark, inputs, root, as_of, project, flag_prefixes, snapshot_prefixes, flag_users, snapshot_users, days, offsets
) -> None:
    moments = monitor.restated_moments(as_of, offsets)
    load_days = [day_of(m) for m in moments]

    replace_table(jobs.job_costs(inputs.job_log, as_of, days), f"{root}/{JOBS}", moment="start_time")
    costed = spark.read.parquet(f"{root}/{JOBS}")

    tables = inventory.table_inventory(inputs.catalog, as_of)
    flags = access.last_access_flags(
        inputs.access_log, tables, project, flag_users, flag_prefixes
    )
    extract = jobs.job_extract(costed, project)
    append_details(inventory.table_details(tables, flags, extract), root, as_of.strftime("%Y%m%dT%H%M%S"))
    eves = [day - timedelta(days=1) for day in load_days]
    details = read_stored(spark, f"{root}/{DETAILS}", schemas.DETAILS)
    details = on_load_days(details, [*load_days, *eves], unknown=True)

    past = on_load_days(read_stored(spark, f"{root}/{HISTORY}", schemas.HISTORY), load_days)
    merged = history.merge_history(details, past, moments, project)
    replace_load_days(merged, f"{root}/{HISTORY}", "data_carga")

    stored = read_stored(spark, f"{root}/{HISTORY}", schemas.HISTORY)
    facts = snapshot.table_facts(inputs.access_log, inputs.table_costs, project, snapshot_users, snapshot_prefixes)
    snapshot.refresh_snapshot(spark, stored, facts, f"{root}/{SNAPSHOT}", f"{root}/{FACTS}", load_days, project)
    shown = on_load_days(read_stored(spark, f"{root}/{SNAPSHOT}", schemas.SNAPSHOT), load_days)

    rollup.refresh_runs(spark, inputs.job_log, f"{root}/{DAILY}", load_days)
    source = monitor.monitor_rows(rollup.read_runs(spark, f"{root}/{DAILY}"), shown, load_days)
    past = on_load_days(read_stored(spark, f"{root}/{MONITOR}", schemas.MONITOR), load_days)
    merged = monitor.merge_monitor(source, past, load_days)
    replace_load_days(merged, f"{root}/{MONITOR}", "data_carga")
