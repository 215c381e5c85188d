"""Session settings used by tests, the benchmark and stand-alone runs."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "ledgermill", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``; without it, the warehouse.

    A warehouse in a folder of one machine will do only where everything runs on that machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return folder or in_warehouse(spark.conf.get("spark.sql.warehouse.dir"), spark.sparkContext.master)


def in_warehouse(warehouse: str, master: str) -> str:
    here = warehouse.startswith(("file:", "/")) or "://" not in warehouse
    if here and not master.startswith("local"):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all machines share; {warehouse} may not be one")
    return f"{warehouse.rstrip('/')}/_intermediate"


#: What ``stored`` has written in this process and not removed.
_written: list[str] = []


@contextmanager
def intermediate(spark: SparkSession) -> Iterator[None]:
    """Removes at its end what ``stored`` writes inside: for runs whose results are written by then."""
    before = len(_written)
    try:
        yield
    finally:
        paths = _written[before:]
        del _written[before:]
        remove(spark, paths)


def remove(spark: SparkSession, paths: list[str]) -> None:
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    for path in paths:
        place = files.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


#: What a task of ``smaller_tasks`` reads of a shuffle, and the setting that says so.
SMALL_TASK = 16 << 20
TASK_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def bytes_of(size: str) -> int:
    """Spark's notation of a size, such as ``64MB``, ``16m`` or ``67108864b``."""
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)(?:i?b)?", size.strip().lower()).groups()
    return int(number) * _UNITS[unit]


@contextmanager
def smaller_tasks(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution joins shuffle partitions up to SMALL_TASK only for what runs inside: for hash aggregates
    whose rows take very much more memory than their compressed bytes. A smaller setting stays."""
    before = spark.conf.get(TASK_SIZE)
    if bytes_of(before) <= SMALL_TASK:
        yield
        return
    spark.conf.set(TASK_SIZE, f"{SMALL_TASK}b")
    try:
        yield
    finally:
        spark.conf.set(TASK_SIZE, before)


#: Bytes of a batch of rows on its way to Python, about, and the setting that says so.
BATCH = 4 << 20
BATCH_SIZE = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """From here on, batches for Python hold BATCH bytes: by default they hold 10,000 rows or 64 MB, of which
    the executor holds copies outside its heap and its Python worker one more. A smaller setting stays.

    The setting stays in the session, for what operators return is computed when their caller writes it.
    """
    if bytes_of(spark.conf.get(BATCH_SIZE, "64m")) > BATCH:
        spark.conf.set(BATCH_SIZE, f"{BATCH}b")


def stored(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written once to the shared folder and read back.

    Cuts the lineage as a checkpoint does and survives lost executors; being Parquet,
    it also keeps column pruning, pushed filters and size statistics. The files lie
    under the application id, so they can be removed when the application has ended;
    ``intermediate`` removes them earlier.
    """
    found, path = stored_at(df)
    _written.append(path)
    return found


def stored_at(df: DataFrame) -> tuple[DataFrame, str]:
    """What ``stored`` does, and the folder; ``intermediate`` does not remove it, the caller does."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stored_by(df: DataFrame, key: str) -> DataFrame:
    """What ``stored`` does, with rows dealt once by ``key`` into a bucket for each shuffle partition: for wide rows that
    many joins by ``key`` need. These move only their other side.

    Spark knows buckets by a table of the catalog; its name is dropped at once, the files stay as those of ``stored``.
    """
    spark = df.sparkSession
    mark = uuid.uuid4().hex
    name, path = f"stored_{mark}", f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{mark}"
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    _written.append(path)
    try:
        df.repartition(count, key).write.option("path", path).bucketBy(count, key).saveAsTable(name)
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
