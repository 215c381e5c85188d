"""Table inventory and table details."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill import schemas
from ledgermill.functions import costs
from ledgermill.functions.dates import datetime_lit, utc_clock
from ledgermill.operators.joins import left_join_many

TABLE = ["project_id", "table_id", "dataset_id"]


def table_inventory(
    catalog: DataFrame, loaded_at: str | datetime, tables: Sequence[str] | None = None
) -> DataFrame:
    """Size, storage and scan cost, kind and times of every table (or ``tables``)."""
    if tables is not None:
        catalog = catalog.filter(F.col("table_id").isin(*tables))
    size = F.col("size_bytes")
    kind = F.col("type")
    return catalog.select(
        "project_id", "dataset_id", "table_id", "row_count", "size_bytes",
        costs.decimal_size(size, 6).alias("size_mb"),
        costs.decimal_size(size, 9).alias("size_gb"),
        costs.storage_cost(size).alias("pre_cost_storage"),
        costs.decimal_size(size, 12).alias("size_tb"),
        costs.scan_estimate(size).alias("pre_cost_us_dol"),
        F.timestamp_millis("creation_time").alias("creation_time"),
        F.timestamp_millis("last_modified_time").alias("last_modified_time"),
        F.when(kind == 1, "table").when(kind == 2, "view").when(kind == 3, "external table").alias("type"),
        datetime_lit(loaded_at).alias("bio_process_time"),
    )


def dataset_names(schemata: DataFrame) -> DataFrame:
    return schemata.select(F.col("schema_name").alias("dataset")).distinct()


def table_details(inventory: DataFrame, flags: DataFrame, jobs: DataFrame) -> DataFrame:
    """Every table with its access flags, once per job that wrote it.

    Tables and flags have one row per table. Jobs are many and one table may have a large
    part of them, so that join is split into matched and unmatched tables; it reads
    ``jobs`` twice, so pass a stored table.
    """
    modified = utc_clock(F.col("last_modified_time"))
    tables = inventory.select(
        *TABLE, "row_count", "pre_cost_storage", "size_tb", "pre_cost_us_dol",
        F.to_date(modified).alias("data_ult_modificacao"),
        F.date_format(modified, "HH").alias("hora_ult_modificacao"),
    )
    users = flags.select(
        *TABLE, F.col("access_date").alias("data_acesso"),
        "flag_user_sa_bio", "flag_user_nominal", "flag_sem_acesso",
    )
    runs = jobs.select(*TABLE, "data_hora_execucao_job", "executor_job", "cost_us_dol")
    used = tables.join(users, TABLE, "left")
    return schemas.conform(left_join_many(used, runs, TABLE), schemas.DETAILS)
