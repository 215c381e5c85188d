"""Writing result tables: replace, append, and replace the load days of a merge."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ledgermill import schemas
from ledgermill.operators.corrections import apply_corrections
from ledgermill.sources.readers import read_forms, read_table

#: Partition columns: the day of a row, and the run that appended it.
LOAD_DAY, RUN_NAME = "dia_particao", "execucao"


def replace_table(df: DataFrame, path: str, moment: str | None = None) -> None:
    """Create or replace a whole table, from a complete write beside it.

    ``moment`` partitions the table by the day of that column.

    A failed job leaves the old table; a reader sees the old or the new one, but for the
    moment between two renames. ``df`` may read the table it replaces.
    """
    spark = df.sparkSession
    mark = uuid.uuid4().hex
    fresh, old = f"{path}.new-{mark}", f"{path}.old-{mark}"
    if moment is None:
        df.write.parquet(fresh)
    else:
        _by_day(df, moment).write.partitionBy(LOAD_DAY).parquet(fresh)
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    place = files.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    swap(system, files.Path(fresh), place, files.Path(old))
    spark.catalog.refreshByPath(path)


def swap(system, fresh, place, old) -> None:
    """Put ``fresh`` in the place of a table; if that fails, the table goes back to its place."""
    before = system.exists(place)
    if before and not system.rename(place, old):
        raise OSError(f"{place} could not be set aside")
    try:
        moved = system.rename(fresh, place)
    except Exception:
        moved = False
        raise
    finally:
        if not moved and before:
            system.rename(old, place)
    if not moved:
        raise OSError(f"{fresh} could not become {place}")
    system.delete(old, True)


def load_forms(spark: SparkSession, path: str, schema: T.StructType, rejected: str) -> DataFrame:
    """The rows of form files that fit ``schema``; the lines that do not are kept in the table ``rejected``, which
    is replaced, so a repaired file empties it."""
    rows, lines = read_forms(spark, path, schema)
    replace_table(lines, rejected)
    return rows


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        return bool(spark.read.parquet(path).columns)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def read_stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table with ``schema``, empty if it does not exist yet.

    Keeps the load-day partition column, when there is one, for pruning.
    """
    if not table_exists(spark, path):
        return spark.createDataFrame([], schema)
    found = spark.read.parquet(path).columns
    folders = [(RUN_NAME, T.StringType()), (LOAD_DAY, T.DateType())]
    folders = [T.StructField(name, kind) for name, kind in folders if name in found]
    if not folders:
        return read_table(spark, path, schema)
    read_table(spark, path, schema)
    return spark.read.schema(T.StructType([*schema.fields, *folders])).parquet(path).drop(RUN_NAME)


def on_load_days(df: DataFrame, days: list, unknown: bool = False) -> DataFrame:
    """The partitions of the given days of a stored table, without the partition column;
    ``unknown`` adds the rows without a day."""
    if LOAD_DAY not in df.columns:
        return df
    wanted = F.col(LOAD_DAY).isin(days)
    return df.filter(wanted | F.col(LOAD_DAY).isNull() if unknown else wanted).drop(LOAD_DAY)


def _by_day(df: DataFrame, moment: str) -> DataFrame:
    """Rows with their day; ``rebalance`` evens out the files and splits a day that
    holds most of the rows."""
    return df.withColumn(LOAD_DAY, F.to_date(moment)).hint("rebalance", LOAD_DAY)


def append_table(df: DataFrame, path: str, schema: T.StructType, moment: str | None = None) -> None:
    """Append rows of exactly the declared columns; the first append creates the table.

    ``moment`` partitions the table by the day of that column.
    """
    unknown = [c for c in df.columns if c not in schema.names]
    if unknown:
        raise ValueError(f"{path}: columns not in the table: {unknown}")
    rows = schemas.conform(df, schema)
    if table_exists(df.sparkSession, path):
        read_table(df.sparkSession, path, schema)
    if moment is None:
        rows.write.mode("append").parquet(path)
    else:
        _by_day(rows, moment).write.mode("append").partitionBy(LOAD_DAY).parquet(path)


def append_run(df: DataFrame, path: str, schema: T.StructType, run: str, moment: str) -> None:
    """Append rows of exactly the declared columns under the name of a run, by the day of ``moment``.

    A repeated run replaces its own rows; those of other runs stay. ``run`` must be fit for a folder name.
    """
    unknown = [c for c in df.columns if c not in schema.names]
    if unknown:
        raise ValueError(f"{path}: columns not in the table: {unknown}")
    replace_table(schemas.conform(df, schema), f"{path}/{RUN_NAME}={run}", moment)


def replace_days(df: DataFrame, path: str, column: str, days: Iterable[date]) -> None:
    """Write rows by the date in ``column`` and replace ``days`` and every day that has rows.

    Of ``days``, those without rows lose their folder. ``df`` is read twice and must not read ``path``.
    """
    spark = df.sparkSession
    written = {r[0] for r in df.select(column).distinct().collect()}  # one value for each day
    (
        df.hint("rebalance", column)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    )
    remove_load_days(spark, path, set(days) - written, column)


def remove_load_days(spark: SparkSession, path: str, days: Iterable[date], column: str = LOAD_DAY) -> None:
    """Remove the folders of the given days from a table that is stored by day."""
    remove_partitions(spark, path, column, [day.isoformat() for day in days])


def remove_partitions(spark: SparkSession, path: str, column: str, values: Iterable[str]) -> None:
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    place = files.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for value in values:
        system.delete(files.Path(f"{path}/{column}={value}"), True)
    spark.catalog.refreshByPath(path)


def write_corrections(
    spark: SparkSession, path: str, partition: str, column: str, rules: Sequence[tuple[Column, str]]
) -> list:
    """Correct ``column`` in a stored table and rewrite only the partitions that hold a row to change.

    Returns the values of ``partition`` that were rewritten. Rules are as in ``apply_corrections`` and see the
    stored rows, so a second run finds none, unless rules test the column that they correct. The files of all other
    partitions stay.
    """
    table = spark.read.parquet(path)
    if column == partition:
        raise ValueError(f"{column} says where rows lie; correcting it would move them")
    corrected = apply_corrections(table.withColumn("_before", F.col(column)), column, rules)
    changed = corrected.filter(~F.col(column).eqNullSafe(F.col("_before")))
    # One value for each partition.
    hit = [r[0] for r in changed.select(partition).distinct().collect()]
    if not hit:
        return []
    here = F.col(partition).isin([v for v in hit if v is not None])
    rows = corrected.filter(here | F.col(partition).isNull() if None in hit else here).select(*table.columns)
    (
        rows.hint("rebalance", partition)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    )
    spark.catalog.refreshByPath(path)
    return hit


def replace_load_days(df: DataFrame, path: str, moment: str) -> None:
    """Write rows by the day of ``moment`` and replace only those day partitions.

    Spark writes to a staging folder and swaps the partitions at commit, so ``df`` may
    read the table it replaces.
    """
    (
        _by_day(df, moment)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(LOAD_DAY)
        .parquet(path)
    )
