"""The daily roll-up of the job log as a stored table, so that a run reads restated days only."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill import schemas
from ledgermill.functions.dates import LOCAL_DAY, LOCAL_ZONE, day_of, in_local_days
from ledgermill.plans.monitor import LIFETIME_SINCE, runs_by_day
from ledgermill.session import stored
from ledgermill.sources.writers import read_stored, replace_days, table_exists

DAY = "day"


def of_days(job_log: DataFrame, days: Iterable[date] | DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Jobs of the given local days: a list of days, or a table with the column ``dia_local``.

    A list becomes ranges on the start time and, where the log is stored by local day, its folders. A table
    of days is a semi join on the log's folders, which the days' own filter prunes when the query runs.
    """
    if isinstance(days, DataFrame):
        return job_log.join(days.select(LOCAL_DAY).distinct(), LOCAL_DAY, "left_semi")
    days = sorted(days)
    jobs = in_local_days(job_log, "start_time", days[0], days[-1], zone)
    if LOCAL_DAY in jobs.columns:
        return jobs.filter(F.col(LOCAL_DAY).isin(days))
    return jobs


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return read_stored(spark, path, schemas.DAILY_RUNS)


def refresh_runs(
    spark: SparkSession,
    job_log: DataFrame,
    path: str,
    days: Iterable[str | date] | DataFrame,
    since: str | date = LIFETIME_SINCE,
    zone: str = LOCAL_ZONE,
) -> None:
    """Compute the roll-up of ``days`` anew and replace these days, also those without runs now.

    The first refresh computes every day from ``since`` to the last of ``days``. Other days keep
    their files. Days before ``since`` are left out.
    """
    table = isinstance(days, DataFrame)
    # One value for each restated day.
    wanted = [r[0] for r in days.select(LOCAL_DAY).distinct().collect()] if table else [day_of(d) for d in days]
    wanted = sorted(d for d in wanted if d is not None and d >= day_of(since))
    if not wanted:
        return
    if not table_exists(spark, path):
        jobs = in_local_days(job_log, "start_time", since, wanted[-1], zone)
    else:
        jobs = of_days(job_log, days if table else wanted, zone)
    fresh = schemas.conform(runs_by_day(jobs, zone), schemas.DAILY_RUNS).filter(F.col(DAY) >= F.lit(day_of(since)))
    if table_exists(spark, path) and not table:
        fresh = fresh.filter(F.col(DAY).isin(wanted))
    replace_days(stored(fresh), path, DAY, wanted)
