"""Who used a table on its latest access day."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import classify
from ledgermill.operators.latest import latest_by


def _on_latest_day(day: Column, flag: Column) -> Column:
    """Whether ``flag`` holds for some row of the latest day.

    Day number and flag share one integer, so its maximum is taken on the latest day
    and is odd if the flag holds there: a plain hash aggregate, one shuffle, and no
    list of users per table.
    """
    return F.pmod(F.max(F.unix_date(day).cast("long") * 2 + F.when(flag, 1).otherwise(0)), F.lit(2)) == 1


def last_access_flags(
    access_log: DataFrame,
    tables: DataFrame,
    project: str,
    allow_list: Iterable[str],
    prefixes: Iterable[str],
    newest_first: bool = False,
) -> DataFrame:
    """Per table its latest access day and which kinds of user came on that day.

    ``prefixes`` start the addresses that are no persons'.

    ``tables`` has the wanted names in ``table_id``; it replaces a list in the query
    text and is a semi join of any size.
    """
    wanted = access_log.join(tables.select("table_id").distinct(), "table_id", "left_semi")
    email = F.col("user_email")
    wanted = wanted.withColumn("_prefix", classify.user_prefix(email, prefixes))
    kind = classify.user_class(F.col("_prefix"), email, list(allow_list))
    known = email.isNotNull() & F.col("dataset_id").isNotNull()
    flags = {
        "flag_user_sa_bio": classify.SERVICE_ACCOUNT,
        "flag_user_nominal": classify.NAMED_USER,
        "flag_sem_acesso": classify.SECURITY_ACCOUNT,
    }
    day = F.col("access_date")
    found = (
        wanted.groupBy("dataset_id", "table_id")
        .agg(
            F.max(day).alias("access_date"),
            *[
                F.coalesce(_on_latest_day(day, known & (kind == label)), F.lit(False)).alias(name)
                for name, label in flags.items()
            ],
        )
        .select(
            F.lit(project).alias("project_id"), "dataset_id", "table_id", "access_date", *flags,
            F.lit(1).cast("long").alias("nrows"),
        )
    )
    return found.orderBy(F.desc("access_date")) if newest_first else found


def last_users(
    access_log: DataFrame, project: str, allow_list: Iterable[str], prefixes: Iterable[str]
) -> DataFrame:
    """One user of the latest access day of each table: the first by address."""
    last = latest_by(
        access_log.select("table_id", "dataset_id", "access_date", "user_email"),
        ["table_id", "dataset_id"],
        [F.desc("access_date")],
        [F.asc_nulls_last("user_email")],
    )
    email = F.col("user_email")
    last = last.withColumn("_prefix", classify.user_prefix(email, prefixes))
    kind = classify.user_class(F.col("_prefix"), email, list(allow_list))
    return last.select(
        F.lit(project).alias("project_id"), "dataset_id", "table_id", "access_date", "user_email",
        kind.alias("tipo_user"),
    )
