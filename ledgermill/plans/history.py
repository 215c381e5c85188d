"""History of table use and cost, and the daily snapshot."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill import schemas
from ledgermill.functions.dates import datetime_lit, day_of
from ledgermill.functions.text import decimal_comma
from ledgermill.operators.aggregates import money_sum
from ledgermill.operators.joins import anti_null_aware
from ledgermill.operators.latest import latest_by
from ledgermill.operators.upsert import upsert
from ledgermill.plans.access import last_users

RUN = "data_hora_execucao_job"
TABLE = ["project_id", "dataset_id", "table_id"]
Moment = str | date | datetime

# Status labels and stand-ins for missing dates, which are merge keys.
NEW, CORRECTED = "novo", "atualizado"
NO_ACCESS = "2001-01-01"
NO_RUN = "2020-01-01 00:00:00"
NO_EXECUTOR = "null"

HISTORY_KEYS = [*TABLE, "executor_job", "data_acesso", "data_ult_modificacao", "to_date(data_carga)"]


def moments_of(as_of: Moment | Sequence[Moment]) -> list[Moment]:
    return [as_of] if isinstance(as_of, (str, date)) else list(as_of)


def on_days(moment: str, days: Iterable[date]) -> Column:
    """Range form of ``date(moment) in days``, which a Parquet scan can use."""

    def one(day: date) -> Column:
        start, end = datetime_lit(day), datetime_lit(day + timedelta(days=1))
        return (F.col(moment) >= start) & (F.col(moment) < end)

    return reduce(lambda a, b: a | b, [one(day) for day in days])


def _access_date() -> Column:
    return F.coalesce("data_acesso", F.lit(NO_ACCESS).cast("date")).alias("data_acesso")


def executed_tables(
    details: DataFrame, as_of: Moment | Sequence[Moment], project: str
) -> DataFrame:
    """Tables run on a day, per executor, with the day's run count and cost.

    Runs are first reduced to one row per run instant: the highest paid cost and the
    details of the latest access. A table whose last run cost nothing drops out,
    because its last paid run is not its last run.
    """
    days = [day_of(m) for m in moments_of(as_of)]
    runs = (
        details.filter((F.col("project_id") == project) & on_days(RUN, days))
        .groupBy(*TABLE, "executor_job", RUN)
        .agg(
            F.max(F.when(F.col("cost_us_dol") > 0, F.col("cost_us_dol"))).alias("_paid"),
            F.max(
                F.struct(
                    "data_acesso", "size_tb", "flag_user_sa_bio", "flag_user_nominal",
                    "flag_sem_acesso", "pre_cost_storage",
                )
            ).alias("_row"),
        )
    )
    totals = runs.groupBy(*TABLE, "executor_job", F.to_date(RUN)).agg(
        F.max(F.struct(RUN, "_row", "_paid")).alias("_last"),
        money_sum(F.round("_paid", 2)).alias("custo_query"),
        F.count("_paid").alias("qtde_execucao"),
    )
    named = [F.col(c).isNotNull() for c in ("dataset_id", "table_id", "executor_job")]
    last_paid = F.col("_last._paid").isNotNull()
    chosen = totals.filter(reduce(lambda a, b: a & b, named, last_paid)).select(
        *TABLE, "executor_job", "custo_query", "qtde_execucao", "_last._row.*", f"_last.{RUN}"
    )
    return chosen.select(
        *TABLE, _access_date(), "flag_user_sa_bio", "flag_user_nominal", "flag_sem_acesso",
        F.col(RUN).alias("data_ult_modificacao"),
        "executor_job", RUN, "size_tb", "custo_query",
        F.col("pre_cost_storage").alias("custo_storage"),
        "qtde_execucao", F.lit(NEW).alias("status"), F.col(RUN).alias("data_carga"),
    )


def idle_tables(details: DataFrame, as_of: Moment | Sequence[Moment], project: str) -> DataFrame:
    """Tables not run on a day whose last run is unknown or of the day before.

    "Not run" compares table names only, over all projects and datasets. The executor is
    not named in the result, so a table that several executors ran on the eve is one row:
    that of the last run, then by the other columns. So rows are unique on the merge key.
    """
    moments = moments_of(as_of)
    days = [day_of(m) for m in moments]
    ran = details.filter(on_days(RUN, days)).select("table_id", F.to_date(RUN).alias("_as_of"))
    quiet = details.filter(
        (F.col("project_id") == project)
        & (F.col(RUN).isNull() | on_days(RUN, [d - timedelta(days=1) for d in days]))
        & F.col("data_ult_modificacao").isNotNull()
    ).withColumn("_day", F.to_date(RUN))
    one = latest_by(
        quiet,
        [*TABLE, "executor_job", "_day"],
        [F.desc(RUN)],
        [
            F.desc(c)
            for c in (
                "data_acesso", "size_tb", "data_ult_modificacao", "flag_user_sa_bio",
                "flag_user_nominal", "flag_sem_acesso", "pre_cost_us_dol", "pre_cost_storage",
            )
        ],
    )
    next_day = F.date_add("_day", 1)
    loads = F.filter(
        F.array(*[datetime_lit(m) for m in moments]),
        lambda m: next_day.isNull() | (F.to_date(m) == next_day),
    )
    offered = one.withColumn("data_carga", F.explode(loads)).withColumn(
        "_as_of", F.to_date("data_carga")
    )
    idle = anti_null_aware(offered, ran, "table_id", by="_as_of").select(
        *TABLE, _access_date(), "flag_user_sa_bio", "flag_user_nominal", "flag_sem_acesso",
        F.col("data_ult_modificacao").cast("timestamp_ntz").alias("data_ult_modificacao"),
        F.lit(NO_EXECUTOR).alias("executor_job"),
        F.coalesce(RUN, datetime_lit(NO_RUN)).alias(RUN),
        "size_tb",
        F.col("pre_cost_us_dol").alias("custo_query"),
        F.col("pre_cost_storage").alias("custo_storage"),
        F.lit(0).cast("long").alias("qtde_execucao"), F.lit(NEW).alias("status"),
        "data_carga", "_as_of",
    )
    ties = ("size_tb", "custo_query", "custo_storage", "flag_user_sa_bio", "flag_user_nominal", "flag_sem_acesso")
    return latest_by(
        idle,
        [*TABLE, "data_acesso", "data_ult_modificacao", "_as_of"],
        [F.desc(RUN)],
        [*[F.desc(c) for c in ties], F.desc("data_carga")],
    ).drop("_as_of")


def history_source(
    details: DataFrame, as_of: Moment | Sequence[Moment], project: str
) -> DataFrame:
    rows = executed_tables(details, as_of, project).unionByName(idle_tables(details, as_of, project))
    return schemas.conform(rows, schemas.HISTORY)


def merge_history(
    details: DataFrame,
    history: DataFrame,
    as_of: Moment | Sequence[Moment],
    project: str,
) -> DataFrame:
    """New content of ``history`` after the merge of one day, or of several days.

    A new row of the day is corrected once; a corrected row is left alone. The last
    run time is part of the key, so a later run on the same day adds a row.

    The rows of a day touch that load day only, so merging several days at once gives
    what merging them one after the other gives.
    """
    days = [day_of(m) for m in moments_of(as_of)]
    current = (F.col("status") == NEW) & F.to_date("data_carga").isin(days)
    return upsert(
        schemas.conform(history, schemas.HISTORY),
        history_source(details, as_of, project),
        HISTORY_KEYS,
        update_when=current,
        overrides={"status": F.lit(CORRECTED)},
    )


def daily_snapshot(
    history: DataFrame,
    access_log: DataFrame,
    table_costs: DataFrame,
    project: str,
    allow_list: Iterable[str],
    prefixes: Iterable[str],
) -> DataFrame:
    """One row per table and load day, with its last user and yearly cost, the highest if
    the costs name a table more than once."""
    users = last_users(access_log, project, allow_list, prefixes)
    yearly = yearly_costs(table_costs)
    return snapshot_rows(day_rows(history, project).join(users, TABLE, "left").join(yearly, TABLE, "left"))


def yearly_costs(table_costs: DataFrame) -> DataFrame:
    return table_costs.groupBy(*TABLE).agg(F.max("yearly_cost").alias("yearly_cost"))


def day_rows(history: DataFrame, project: str) -> DataFrame:
    """The last load of each table and load day, with the day in ``_day``."""
    loads = history.filter(F.col("project_id") == project).withColumn("_day", F.to_date("data_carga"))
    ties = ("executor_job", "data_ult_modificacao", "size_tb", "custo_query", "custo_storage")
    return latest_by(
        loads.select(*TABLE, "_day", "data_carga", *ties),
        [*TABLE, "_day"],
        [F.desc("data_carga")],
        [F.asc(ties[0]), *[F.desc(c) for c in ties[1:]]],
    )


def snapshot_rows(joined: DataFrame) -> DataFrame:
    return joined.select(
        "access_date", "user_email", "tipo_user", *TABLE, "data_ult_modificacao",
        decimal_comma(F.col("size_tb"), null=None).alias("size_tb"),
        decimal_comma(F.col("custo_query")).alias("custo_query"),
        decimal_comma(F.col("custo_storage")).alias("custo_storage"),
        decimal_comma(F.col("yearly_cost")).alias("custo_ano_bee"),
        F.col("_day").alias("data_carga"),
    )
