"""Tables that lie in buckets of their merge key, so that a merge reads the target as it lies."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from ledgermill.session import remove


def replace_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> None:
    """Create or replace the catalog table ``name``, in ``buckets`` by ``keys``, one file each.

    Every version has a folder of its own under ``path``; the name moves to the new version when it is whole, so
    a failed job leaves the old one. ``df`` may read the table it replaces; what else was read from the table must be read
    anew. ``buckets`` should be the shuffle partitions of the merges or more: a join whose other side
    has more partitions would deal the target anew.
    """
    spark = df.sparkSession
    before = location(spark, name) if spark.catalog.tableExists(name) else None
    mark = uuid.uuid4().hex
    fresh = f"{name}_{mark}"
    rows = df.repartition(buckets, *keys)
    rows.write.option("path", f"{path}/{mark}").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(fresh)
    if before:
        spark.sql(f"DROP TABLE {name}")  # the files stay, as the table has a place of its own
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name.rpartition('.')[2]}")
    if before:
        remove(spark, [before])


def location(spark, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'")
    return rows.first()["data_type"]


def register_bucketed(spark, df_schema, name: str, path: str, keys: Sequence[str], buckets: int) -> None:
    """Name a bucketed folder in a catalog that does not know it, such as that of a new session."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df_schema.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
