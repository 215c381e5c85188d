"""Job costs and the job extract."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import classify, costs, dates
from ledgermill.functions.dates import LOCAL_ZONE, days_before, in_local_days, is_ntz, local_datetime


def classified_jobs(job_log: DataFrame, zone: str = LOCAL_ZONE, keep_other: bool = True) -> DataFrame:
    """Every job with local start, duration, cost, executor and dataset class."""
    target = {k: F.col(f"destination_table.{k}") for k in ("project_id", "dataset_id", "table_id")}
    matched = classify.add_matches(
        job_log, F.col("job_id"), F.col("parent_job_id"), target["dataset_id"], target["table_id"]
    )
    billed = F.col("total_bytes_billed")
    return matched.select(
        "statement_type", "user_email", "job_id", "job_type",
        local_datetime(F.col("start_time"), zone, is_ntz(job_log, "start_time")).alias("start_time"),
        "query", "state", "total_bytes_billed", "total_slot_ms", "transferred_bytes",
        "parent_job_id",
        dates.whole_seconds(F.col("start_time"), F.col("end_time")).alias("time_in_seconds"),
        costs.billed_tb(billed).alias("tb_billed"),
        costs.query_cost(billed).alias("cost_us_dol"),
        (F.col("total_slot_ms") / 1000).alias("total_slot"),
        *[value.alias(name) for name, value in target.items()],
        "dataset", "dataset_others", "executor_anon_job", "executor_parent_cons_prog_job",
        "executor_parent_airflow_job",
        classify.executor_class(keep_other).alias("executor_job"),
        classify.dataset_class(target["dataset_id"]).alias("dataset_id_job"),
    )


def job_costs(
    job_log: DataFrame,
    as_of: str | date,
    days: int = 10,
    tables: Sequence[str] | None = None,
    zone: str = LOCAL_ZONE,
) -> DataFrame:
    """Jobs since ``days`` local days before ``as_of`` that wrote a named table.

    ``tables`` narrows the jobs to those result tables. The date condition is a range
    on the stored start time and is pushed to the scan; a log stored by local day is read in the
    days' folders only.
    """
    recent = in_local_days(job_log, "start_time", since=days_before(as_of, days), zone=zone)
    if tables is not None:
        recent = recent.filter(F.col("destination_table.table_id").isin(*tables))
    named = recent.filter(~classify.is_anonymous(F.col("destination_table.table_id")))
    # Null in every row that is left, so its pattern need not run again.
    no_match = F.lit(None).cast("string")
    return classified_jobs(named, zone).withColumn("executor_anon_job", no_match)


def job_extract(costed_jobs: DataFrame, project: str) -> DataFrame:
    """Jobs of one project with a known target, without DELETE; an unknown statement
    type drops out too. A dataset class is known exactly if the dataset is."""
    return costed_jobs.filter(
        (F.col("statement_type") != "DELETE")
        & (F.col("project_id") == project)
        & F.col("dataset_id").isNotNull()
        & F.col("table_id").isNotNull()
    ).select(
        "project_id",
        F.col("dataset_id_job").alias("dataset_id"),
        "table_id",
        F.col("start_time").alias("data_hora_execucao_job"),
        "executor_job",
        "cost_us_dol",
    )
