"""Access days as stored state: words of 64 days for each table and kind of user, to which a day's log is added."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill import schemas
from ledgermill.functions import classify
from ledgermill.sources.writers import read_stored, replace_table

STATE_KEYS = ["dataset_id", "table_id", "kind", "bucket"]
#: Days of a word, one bit each. Words are longs, so that states are added by hash aggregates of fixed-width values.
BUCKET_DAYS = 64
#: The kind of rows that count for the access day only.
UNNAMED = ""


def access_days(access_log: DataFrame, allow_list: Iterable[str], prefixes: Iterable[str]) -> DataFrame:
    """dataset_id, table_id, kind, bucket, days: the state of some rows of the log.

    Rows without an address or a dataset have no kind. A row without a day leaves an empty word, so its
    table is known. The kinds are those of the lists in force when the rows come in.
    """
    email = F.col("user_email")
    rows = access_log.withColumn("_prefix", classify.user_prefix(email, prefixes))
    known = email.isNotNull() & F.col("dataset_id").isNotNull()
    kind = F.when(known, classify.user_class(F.col("_prefix"), email, list(allow_list))).otherwise(UNNAMED)
    number = F.unix_date("access_date")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(number, F.lit(BUCKET_DAYS)))
    rows = rows.select(
        "dataset_id", "table_id", kind.alias("kind"), F.floor(number / BUCKET_DAYS).alias("bucket"),
        F.coalesce(bit, F.lit(0)).alias("days"),
    )
    return rows.groupBy(*STATE_KEYS).agg(F.bit_or("days").alias("days"))


def added(state: DataFrame, more: DataFrame) -> DataFrame:
    """Both states as one. Adding rows again changes nothing."""
    both = state.unionByName(more)
    return both.groupBy(*STATE_KEYS).agg(F.bit_or("days").alias("days"))


def last_day(bucket: Column, days: Column) -> Column:
    """The date of a word's highest bit, null if it has none."""
    number = bucket * BUCKET_DAYS + F.length(F.bin(days)) - 1
    return F.when(days != 0, F.date_from_unix_date(number.cast("int")))


def flags_of(state: DataFrame, tables: DataFrame, project: str) -> DataFrame:
    """``access.last_access_flags`` from the state: latest access day and the kinds of user of that day."""
    flags = {
        "flag_user_sa_bio": classify.SERVICE_ACCOUNT,
        "flag_user_nominal": classify.NAMED_USER,
        "flag_sem_acesso": classify.SECURITY_ACCOUNT,
    }
    wanted = state.join(tables.select("table_id").distinct(), "table_id", "left_semi")
    rows = wanted.select("dataset_id", "table_id", "kind", last_day(F.col("bucket"), F.col("days")).alias("day"))
    latest = rows.groupBy("dataset_id", "table_id").agg(
        F.max("day").alias("access_date"),
        *[F.max(F.when(F.col("kind") == label, F.col("day"))).alias(name) for name, label in flags.items()],
    )
    same = [F.coalesce(F.col(name) == F.col("access_date"), F.lit(False)).alias(name) for name in flags]
    return latest.select(
        F.lit(project).alias("project_id"), "dataset_id", "table_id", "access_date", *same, F.lit(1).cast("long").alias("nrows")
    )


def add_access(
    spark: SparkSession, rows: DataFrame, path: str, allow_list: Iterable[str], prefixes: Iterable[str]
) -> None:
    """Add rows of the log, such as a day's, to the stored state; the rest of the log is not read."""
    state = read_stored(spark, path, schemas.ACCESS_DAYS)
    replace_table(schemas.conform(added(state, access_days(rows, allow_list, prefixes)), schemas.ACCESS_DAYS), path)
