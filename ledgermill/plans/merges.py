"""The two merges over targets in buckets of their merge key."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill import schemas
from ledgermill.functions.dates import day_of
from ledgermill.operators.upsert import upsert
from ledgermill.plans.history import CORRECTED, HISTORY_KEYS, NEW, Moment, history_source, moments_of
from ledgermill.plans.monitor import LIFETIME_COLUMNS, MONITOR_KEYS
from ledgermill.sources.buckets import replace_bucketed

#: The load day is part of the history's key, so it is a column of the bucketed table.
LOADED_ON = "dia_carga"
HISTORY_BUCKETS = [*HISTORY_KEYS[:-1], LOADED_ON]


def with_load_day(history: DataFrame) -> DataFrame:
    return schemas.conform(history, schemas.HISTORY).withColumn(LOADED_ON, F.to_date("data_carga"))


def history_merge(details: DataFrame, target: DataFrame, as_of: Moment | Sequence[Moment], project: str) -> DataFrame:
    """``merge_history`` into a target that has the load day as a column."""
    days = [day_of(m) for m in moments_of(as_of)]
    source = with_load_day(history_source(details, as_of, project))
    current = (F.col("status") == NEW) & F.col(LOADED_ON).isin(days)
    return upsert(target, source, HISTORY_BUCKETS, update_when=current, overrides={"status": F.lit(CORRECTED)})


def store_history(history: DataFrame, name: str, path: str, buckets: int) -> None:
    replace_bucketed(with_load_day(history), name, path, HISTORY_BUCKETS, buckets)


def merge_stored_history(
    spark: SparkSession, details: DataFrame, name: str, path: str, as_of: Moment | Sequence[Moment], project: str, buckets: int
) -> None:
    """Merge into the bucketed table ``name``; no row of the target moves before the merged table is written."""
    merged = history_merge(details, spark.table(name), as_of, project)
    replace_bucketed(merged, name, path, HISTORY_BUCKETS, buckets)


def monitor_merge(source: DataFrame, target: DataFrame, days: Iterable[str | date]) -> DataFrame:
    """``merge_monitor`` into a stored target, as it lies."""
    updated = [c for c in schemas.MONITOR.names if c not in LIFETIME_COLUMNS]
    wanted = F.col("data_carga").isin([day_of(d) for d in days])
    return upsert(target, schemas.conform(source, schemas.MONITOR), MONITOR_KEYS, update_when=wanted, set_cols=updated)


def store_monitor(monitor: DataFrame, name: str, path: str, buckets: int) -> None:
    replace_bucketed(schemas.conform(monitor, schemas.MONITOR), name, path, MONITOR_KEYS, buckets)


def merge_stored_monitor(
    spark: SparkSession, source: DataFrame, name: str, path: str, days: Iterable[str | date], buckets: int
) -> None:
    replace_bucketed(monitor_merge(source, spark.table(name), days), name, path, MONITOR_KEYS, buckets)
