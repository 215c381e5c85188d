"""The job log stored by local day, and the days that changed."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.functions.dates import LOCAL_DAY, LOCAL_ZONE, datetime_lit, with_local_day
from ledgermill.session import stored

CHANGED_AT = "mudou_em"


def append_jobs(jobs: DataFrame, path: str, at: datetime, zone: str = LOCAL_ZONE) -> None:
    """Append jobs to the log in the folders of their local days, and note these days as changed at ``at``.

    A job that starts at 02:00 UTC lies in the day before. Late jobs go to the day they started in.
    Jobs without a start have no day, and are noted as such.
    """
    jobs = stored(with_local_day(jobs, "start_time", zone))
    jobs.hint("rebalance", LOCAL_DAY).write.mode("append").partitionBy(LOCAL_DAY).parquet(path)
    days = jobs.select(LOCAL_DAY).distinct().withColumn(CHANGED_AT, datetime_lit(at))
    days.coalesce(1).write.mode("append").parquet(changes_path(path))  # a row for each day of this load


def changes_path(path: str) -> str:
    return f"{path.rstrip('/')}_{CHANGED_AT}"


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    """The log with the column ``dia_local``, by which it is stored."""
    return spark.read.parquet(path)


def changed_days(spark: SparkSession, path: str, after: datetime) -> DataFrame:
    """``dia_local`` of the days with jobs that were appended after a moment."""
    days = spark.read.parquet(changes_path(path))
    return days.filter(F.col(CHANGED_AT) > datetime_lit(after)).select(LOCAL_DAY)
