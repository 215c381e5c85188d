"""Named classification rules for jobs, datasets and users."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.text import regexp_group

# Name patterns, prefix lists and class labels.
NAME_TAIL = r"+[a-zA-Z0-9_.+-]+[^\\b]"
ANONYMOUS_TABLE = r"^(anon)" + NAME_TAIL
PARENT_AIRFLOW = r"^(airflow)" + NAME_TAIL
PARENT_SCHEDULED = r"^(scheduled_query)" + NAME_TAIL
OWN_EXECUTOR = r"(?i)(scheduled_query|script_job|airflow)" + NAME_TAIL
SCRIPT_DATASET = r"^(_script)" + NAME_TAIL
HIDDEN_DATASET = r"^(_[a-zA-Z0-9]{6})" + NAME_TAIL
SERVICE_ACCOUNT = "service account bio"
SECURITY_ACCOUNT = "service segurança"
DASHBOARD_USER = "usuario de dash"
NAMED_USER = "usuario nominal"
OTHER_USER = "Na"


def is_anonymous(table_id: Column) -> Column:
    return F.coalesce(F.rlike(table_id, F.lit(ANONYMOUS_TABLE)), F.lit(False))


def add_matches(
    df: DataFrame, job_id: Column, parent_job_id: Column, dataset_id: Column, table_id: Column
) -> DataFrame:
    """Name matches as columns, so that each pattern runs once per row."""
    return df.withColumns(
        {
            "executor": regexp_group(job_id, OWN_EXECUTOR),
            "executor_parent_cons_prog_job": regexp_group(parent_job_id, PARENT_SCHEDULED),
            "executor_parent_airflow_job": regexp_group(parent_job_id, PARENT_AIRFLOW),
            "executor_anon_job": regexp_group(table_id, ANONYMOUS_TABLE),
            "dataset": regexp_group(dataset_id, SCRIPT_DATASET),
            "dataset_others": regexp_group(dataset_id, HIDDEN_DATASET),
        }
    )


def executor_class(keep_other: bool = True) -> Column:
    """Who started a job, from the matches. A match ignores case but the comparison does
    not, so an upper-case id keeps its own text (``keep_other``) or counts as manual."""
    own = F.col("executor")
    scheduled = F.coalesce("executor_parent_cons_prog_job", own) == "scheduled_query"
    airflow = (own == "airflow") | (
        (own == "script_job") & (F.col("executor_parent_airflow_job") == "airflow")
    )
    rule = F.when(scheduled, "consulta_programada").when(airflow, "airflow")
    if keep_other:
        rule = rule.when(own.isNotNull(), own)
    return rule.otherwise("manual")


def dataset_class(dataset_id: Column) -> Column:
    """``temp`` for script and hidden datasets, from the matches."""
    temporary = F.coalesce("dataset", "dataset_others").isNotNull()
    return F.when(temporary, "temp").otherwise(dataset_id)


def user_prefix(email: Column, prefixes: Iterable[str]) -> Column:
    return regexp_group(email, "^(" + "|".join(prefixes) + ")" + NAME_TAIL)


def user_class(prefix: Column, email: Column, allow_list: Iterable[str]) -> Column:
    return (
        F.when(prefix == "bio", SERVICE_ACCOUNT)
        .when(prefix == "service", SECURITY_ACCOUNT)
        .when(prefix.isNotNull(), OTHER_USER)
        .when(email.isin(*allow_list), DASHBOARD_USER)
        .otherwise(NAMED_USER)
    )
