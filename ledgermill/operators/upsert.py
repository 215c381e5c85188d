"""MERGE as a DataFrame: the new content of a target table or partition."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.session import stored


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_when: Column | None = None,
    set_cols: Sequence[str] | None = None,
    overrides: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Target rows with matches updated, then the source rows that match nothing.

    ``keys`` are columns or SQL expressions evaluated on both sides. A null key never
    matches. ``update_when`` is a condition on the target row; a matched row that
    fails it stays as it is and still blocks the insert. ``set_cols`` are taken from
    the source, ``overrides`` are set on update. Two source rows that would update
    one target row raise an error, as MERGE does.

    Only rows that can be updated are shuffled with the source; all other target
    rows pass straight through. Source rows are collapsed per key and target keys are
    made distinct before their joins, so no key brings its copies into one task. The collapse
    is a hash aggregate on a count and a row number, by which the source row's columns are fetched
    before the target is met. So a target that lies in buckets of its keys is joined as it lies. The source is
    read more than once and must be the same each time, so it is stored first.
    """
    columns = target.columns
    set_cols = list(set_cols or columns)
    overrides = dict(overrides or {})
    names = [f"_key{i}" for i in range(len(keys))]
    key_values = {n: F.expr(k) for n, k in zip(names, keys)}
    keyed = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])

    old = target.withColumns(key_values)
    numbered = stored(source.select(*columns, F.monotonically_increasing_id().alias("_row")))
    new = numbered.withColumns(key_values)

    may_update = keyed if update_when is None else keyed & F.coalesce(update_when, F.lit(False))
    untouched = old.filter(~may_update).select(*columns)

    collapsed = (
        new.filter(keyed)
        .groupBy(*names)
        .agg(F.count(F.lit(1)).alias("_found"), F.max("_row").alias("_row"))
    )
    # The only source row of a key that is hit, so the choice by number is none.
    payload = numbered.select("_row", F.struct(*set_cols).alias("_new"))
    offered = collapsed.join(payload, "_row").drop("_row")
    clash = F.raise_error(F.lit("several source rows update one target row")).cast("boolean")
    hit = F.when(F.col("_found") > 1, clash).otherwise(F.col("_found") == 1)

    def merged(column: str) -> Column:
        if column in overrides:
            value = overrides[column]
        elif column in set_cols:
            value = F.col(f"_new.{column}")
        else:
            return F.col(column)
        return F.when(F.col("_hit"), value).otherwise(F.col(column)).alias(column)

    updated = (
        old.filter(may_update)
        .join(offered, names, "left")
        .withColumn("_hit", hit)
        .select(*[merged(c) for c in columns])
    )
    taken = old.filter(keyed).select(*names).distinct()
    inserted = new.filter(keyed).join(taken, names, "left_anti").select(*columns)
    keyless = new.filter(~keyed).select(*columns)
    return updated.unionByName(untouched).unionByName(inserted).unionByName(keyless)
