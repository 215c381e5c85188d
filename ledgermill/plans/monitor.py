"""Active-table monitor and the restatement of several days."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill import schemas
from ledgermill.functions.dates import (
    LOCAL_ZONE,
    date_lit,
    day_of,
    days_before,
    in_local_days,
)
from ledgermill.functions.text import decimal_comma
from ledgermill.operators.aggregates import mean_cost, money
from ledgermill.operators.upsert import upsert
from ledgermill.plans.jobs import classified_jobs

TABLE = ["project_id", "dataset_id", "table_id"]
MONITOR_KEYS = [*TABLE, "data_carga"]

# First day of the lifetime figures and the restated days.
LIFETIME_SINCE = date(2022, 1, 1)
RESTATED_OFFSETS = range(-1, 4)
EXECUTORS = ("airflow", "consulta_programada", "manual")

MICROS = 1_000_000

LIFETIME_COLUMNS = (
    "qtde_execucao",
    "custo_hist",
    "pri_data_hora_execucao_job",
    "ulti_data_hora_execucao_job",
    "custo_query_execucao_job",
)


def daily_runs(
    job_log: DataFrame,
    until: str | date,
    since: str | date = LIFETIME_SINCE,
    zone: str = LOCAL_ZONE,
) -> DataFrame:
    """Paid runs per table and local day: count, cost, first and last run, and the
    executor of the last run. One run per start instant, the dearest one.

    Cost in millionths of a dollar and the executor's number share one integer, whose
    maximum is the dearest run. So both steps are hash aggregates on fixed-width
    values, and the job log is never sorted.
    """
    return runs_by_day(in_local_days(job_log, "start_time", since, until, zone), zone)


def runs_by_day(job_log: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """``daily_runs`` of all jobs of a log."""
    jobs = classified_jobs(job_log, zone, keep_other=False).filter(F.col("cost_us_dol") > 0)
    number = F.array_position(_executors(), F.col("executor_job")) - 1
    micros = F.round(F.col("cost_us_dol") * MICROS, 0).cast("long")
    runs = (
        jobs.groupBy(*TABLE, "start_time")
        .agg(F.max(micros * len(EXECUTORS) + number).alias("_run"))
        .select(
            *TABLE, "start_time",
            F.pmod("_run", F.lit(len(EXECUTORS))).cast("int").alias("executor"),
            (F.expr(f"_run div {len(EXECUTORS)}") / MICROS).alias("cost_us_dol"),
        )
    )
    return runs.groupBy(*TABLE, F.to_date("start_time").alias("day")).agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum(money(F.round("cost_us_dol", 2))).alias("cost"),
        F.min("start_time").alias("first_run"),
        F.max("start_time").alias("last_run"),
        F.max_by("executor", "start_time").alias("executor"),
    )


def _executors() -> Column:
    return F.array(*[F.lit(name) for name in EXECUTORS])


def executor_name(number: Column) -> Column:
    return F.get(_executors(), number)


def run_figures(days: DataFrame, as_of: Sequence[str | date]) -> DataFrame:
    """Lifetime and same-day figures per table for each ``as_of`` day.

    Works on the daily roll-up, so restating five days reads the job log once.
    """
    wanted = F.array(*[date_lit(d) for d in as_of])
    later = F.filter(wanted, lambda d: d >= F.col("day"))
    rows = days.withColumn("as_of", F.explode(later))
    today = F.col("day") == F.col("as_of")

    def day_value(column: str) -> Column:
        return F.max(F.when(today, F.col(column)))

    return rows.groupBy(*TABLE, "as_of").agg(
        F.sum("runs").alias("runs"),
        F.sum("cost").cast("double").alias("cost"),
        F.min("first_run").alias("first_run"),
        F.max("last_run").alias("last_run"),
        day_value("runs").alias("day_runs"),
        day_value("cost").cast("double").alias("day_cost"),
        day_value("first_run").alias("day_first"),
        day_value("last_run").alias("day_last"),
        executor_name(day_value("executor")).alias("day_executor"),
    )


def monitor_source(
    job_log: DataFrame,
    snapshot: DataFrame,
    as_of: Sequence[str | date],
    since: str | date = LIFETIME_SINCE,
    zone: str = LOCAL_ZONE,
) -> DataFrame:
    """Snapshot rows of the ``as_of`` days with lifetime and same-day figures.

    The figures are aggregated per table first. Joining the job log to the snapshot
    before, as a filter, would change nothing: only snapshot tables reach the output.
    """
    days = [day_of(d) for d in as_of]
    return monitor_rows(daily_runs(job_log, max(days), since, zone), snapshot, days)


def monitor_rows(runs: DataFrame, snapshot: DataFrame, as_of: Sequence[str | date]) -> DataFrame:
    """``monitor_source`` from runs by day, which may be a stored roll-up."""
    days = [day_of(d) for d in as_of]
    figures = run_figures(runs.filter(F.col("day") <= date_lit(max(days))), days)
    rows = (
        snapshot.filter(F.col("data_carga").isin(days))
        .withColumn("as_of", F.col("data_carga"))
        .join(figures, [*TABLE, "as_of"], "left")
    )
    return rows.select(
        *TABLE, "data_ult_modificacao", "access_date", "size_tb", "custo_ano_bee",
        F.col("runs").alias("qtde_execucao"),
        decimal_comma(F.col("cost")).alias("custo_hist"),
        F.col("first_run").alias("pri_data_hora_execucao_job"),
        F.col("last_run").alias("ulti_data_hora_execucao_job"),
        decimal_comma(mean_cost(F.col("cost"), F.col("runs"))).alias("custo_query_execucao_job"),
        F.col("day_executor").alias("executor_job_dia"),
        F.col("day_runs").alias("qtde_execucao_dia"),
        decimal_comma(F.col("day_cost")).alias("custo_dia"),
        F.col("day_first").alias("pri_data_hora_execucao_job_dia"),
        F.col("day_last").alias("ulti_data_hora_execucao_job_dia"),
        decimal_comma(mean_cost(F.col("day_cost"), F.col("day_runs"))).alias("custo_query_execucao_dia"),
        "data_carga",
    )


def merge_monitor(source: DataFrame, target: DataFrame, days: Iterable[str | date]) -> DataFrame:
    """New content of the monitor. A matched row keeps its lifetime figures."""
    updated = [c for c in schemas.MONITOR.names if c not in LIFETIME_COLUMNS]
    return upsert(
        schemas.conform(target, schemas.MONITOR),
        schemas.conform(source, schemas.MONITOR),
        MONITOR_KEYS,
        update_when=F.col("data_carga").isin([day_of(d) for d in days]),
        set_cols=updated,
    )


def merge_active_tables(
    job_log: DataFrame,
    snapshot: DataFrame,
    target: DataFrame,
    as_of: str | date | Sequence[str | date],
    since: str | date = LIFETIME_SINCE,
    zone: str = LOCAL_ZONE,
) -> DataFrame:
    days = [as_of] if isinstance(as_of, (str, date)) else list(as_of)
    return merge_monitor(monitor_source(job_log, snapshot, days, since, zone), target, days)


def restated_moments(
    as_of: str | date | datetime, offsets: Iterable[int] = RESTATED_OFFSETS
) -> list[date | datetime]:
    """Tomorrow, today and the days before, as the restatement wants them."""
    return [days_before(as_of, n) for n in offsets]


def restate(
    step: Callable[[date | datetime], DataFrame],
    as_of: str | date | datetime,
    offsets: Iterable[int] = RESTATED_OFFSETS,
) -> DataFrame:
    """Rows of ``step`` for every restated day."""
    return reduce(DataFrame.unionByName, [step(d) for d in restated_moments(as_of, offsets)])
