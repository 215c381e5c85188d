"""The daily snapshot as a stored table, of which a run replaces only the days that changed."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill import schemas
from ledgermill.plans.access import last_users
from ledgermill.plans.history import TABLE, day_rows, snapshot_rows, yearly_costs
from ledgermill.session import stored
from ledgermill.sources.writers import (
    LOAD_DAY,
    on_load_days,
    read_stored,
    remove_load_days,
    replace_load_days,
    replace_table,
    table_exists,
)


def table_facts(
    access_log: DataFrame, table_costs: DataFrame, project: str, allow_list: Iterable[str], prefixes: Iterable[str]
) -> DataFrame:
    """Last user and yearly cost of each table that has either: the state a snapshot row depends on."""
    users = last_users(access_log, project, allow_list, prefixes)
    return schemas.conform(users.join(yearly_costs(table_costs), TABLE, "full"), schemas.TABLE_FACTS)


def changed_tables(before: DataFrame, now: DataFrame) -> DataFrame:
    """Tables whose facts are not the same in both states."""
    differ = now.exceptAll(before).select(*TABLE).union(before.exceptAll(now).select(*TABLE))
    return differ.distinct()


def _content(rows: DataFrame) -> DataFrame:
    """A number of rows and a sum of hashes for each day, which do not depend on their order."""
    whole = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in schemas.SNAPSHOT.names])
    return rows.groupBy("data_carga").agg(F.count(F.lit(1)).alias("n"), F.sum(whole.cast("decimal(38,0)")).alias("h"))


def changed_days(before: DataFrame, now: DataFrame) -> list[date]:
    """Days whose rows are not the same in both; one value for each day."""
    old, new = _content(before), _content(now)
    differ = new.exceptAll(old).select("data_carga").union(old.exceptAll(new).select("data_carga"))
    return sorted(r[0] for r in differ.distinct().collect())


def refresh_snapshot(
    spark: SparkSession,
    history: DataFrame,
    facts: DataFrame,
    path: str,
    facts_path: str,
    days: Iterable[date],
    project: str,
) -> list[date]:
    """Bring the stored snapshot up to date with a stored history; returns the replaced days.

    Looked at are ``days``, which the caller may have changed, and every day that shows a table whose
    facts are not the stored ones. Of these, days whose rows come out as they are stored are left alone, so
    a second run with the same data writes nothing. The history is read in the folders of
    these days only. The first refresh builds every day.
    """
    now = stored(facts)
    joined = lambda rows: snapshot_rows(day_rows(rows, project).join(now, TABLE, "left"))
    if not table_exists(spark, path):
        fresh = stored(joined(history.drop(LOAD_DAY)))
        replace_load_days(fresh, path, "data_carga")
        replace_table(now, facts_path)
        # A row for each day.
        return sorted(r[0] for r in fresh.select("data_carga").distinct().collect())
    kept = read_stored(spark, path, schemas.SNAPSHOT)
    others = changed_tables(read_stored(spark, facts_path, schemas.TABLE_FACTS), now)
    # A row for each day.
    shown = {r[0] for r in kept.join(others, TABLE, "left_semi").select("data_carga").distinct().collect()}
    looked = sorted(shown | set(days))
    fresh = stored(schemas.conform(joined(on_load_days(history, looked)), schemas.SNAPSHOT))
    changed = changed_days(on_load_days(kept, looked), fresh)
    if changed:
        replace_load_days(fresh.filter(F.col("data_carga").isin(changed)), path, "data_carga")
        left = {r[0] for r in fresh.select("data_carga").distinct().collect()}
        remove_load_days(spark, path, [d for d in changed if d not in left])
    if others.head(1):
        replace_table(now, facts_path)
    return changed
