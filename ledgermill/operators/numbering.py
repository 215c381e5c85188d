"""Running totals and row numbers within groups of any size.

A window over ``month`` would bring a whole month into one task. Here the rows are
cut into ordered slices by a range partitioning, each slice is numbered alone, and a
small table of slice totals shifts the slices. The slices are written to the shared
folder first, so that a lost executor or a changed partition count cannot give the
two reads different slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.session import stored

EXPAND_CHUNK = 100_000


def sliced(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Stored rows with ``_part``: the group and the number of its ordered slice."""
    ranged = df.repartitionByRange(*[F.col(k) for k in keys], *order)
    slices = stored(ranged.withColumn("_slice", F.spark_partition_id()))
    return slices.withColumn("_part", F.struct(*keys, "_slice"))


def total_before(
    slices: DataFrame, keys: Sequence[str], order: Sequence[Column], amount: str, name: str
) -> DataFrame:
    sizes = slices.groupBy("_part").agg(F.sum(amount).alias("_size"))
    earlier = (
        Window.partitionBy(*[F.col(f"_part.{k}") for k in keys])
        .orderBy("_part._slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = sizes.select("_part", F.sum("_size").over(earlier).alias("_shift"))
    within = (
        Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    total = F.coalesce("_shift", F.lit(0)) + F.coalesce(F.sum(amount).over(within), F.lit(0))
    return slices.join(shifts, "_part").withColumn(name, total).drop("_part", "_slice")


def running_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], amount: str, name: str
) -> DataFrame:
    """Add ``name``: the sum of ``amount`` over the rows of the group before this one.

    ``order`` must tell the rows of a group apart.
    """
    return total_before(sliced(df, keys, order), keys, order, amount, name)


def expand_copies(
    df: DataFrame, count: str, index: str, chunk: int = EXPAND_CHUNK
) -> DataFrame:
    """Repeat each row ``count`` times with ``index`` 0, 1, ...

    Every row is first cut into chunks of copies, and the chunks are spread over all tasks.
    """
    zero, copies = F.lit(0).cast("long"), F.col(count)
    starts = F.sequence(zero, copies - 1, F.lit(chunk).cast("long"))
    last = F.least(F.col("_start") + chunk, copies) - 1
    return (
        df.withColumn("_start", F.explode(starts))
        .repartition("_start", *df.columns)
        .withColumn(index, F.explode(F.sequence("_start", last)))
        .drop("_start")
    )


def rank_in_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    name: str,
    chunk: int = EXPAND_CHUNK,
) -> DataFrame:
    """``row_number`` of every row in its group, without one task per group.

    ``order`` must leave only fully equal rows tied. Equal rows are counted before
    the shuffle, so a large group of copies travels as one row.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    slices = sliced(counted, keys, order)
    numbered = total_before(slices, keys, order, "_copies", "_before")
    rows = expand_copies(numbered, "_copies", "_index", chunk=chunk)
    return rows.withColumn(name, F.col("_before") + F.col("_index") + 1).select(*df.columns, name)
