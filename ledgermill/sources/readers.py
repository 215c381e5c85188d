"""Reading the input and stored tables with their declared schemas."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.session import stored

YEAR = "ano_fonte"
#: Column of a line that does not fit the schema.
REJECTED = "_linha_rejeitada"


def _shape(schema: T.StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema}


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """A table of exactly ``schema``; a missing column or another type is an error.

    CSV files need a header row, which is checked against the schema; a value that
    does not parse fails the job instead of becoming null.
    """
    if fmt == "csv":
        return (
            spark.read.schema(schema)
            .options(header=True, enforceSchema=False, mode="FAILFAST")
            .csv(path)
        )
    df = spark.read.format(fmt).load(path)
    found, wanted = _shape(df.schema), _shape(schema)
    wrong = {c: (t, found.get(c)) for c, t in wanted.items() if found.get(c) != t}
    if wrong:
        raise ValueError(f"{path}: columns (wanted, found) differ: {wrong}")
    return df.select(*wanted)


def read_forms(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows that fit ``schema``, rejected lines with their file) of CSV files that people filled in.

    The header must name the schema's columns. A line with a value that does not parse, or with too few or too
    many values, is rejected as a whole and does not fail the job. The files are parsed once, with all columns, and
    what was parsed is stored, so that every query sees the same lines rejected.
    """
    whole = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
    found = (
        spark.read.schema(whole)
        .options(header=True, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=REJECTED)
        .csv(path)
        .withColumn("arquivo", F.element_at(F.split(F.input_file_name(), "/"), -1))
    )
    found, bad = stored(found), F.col(REJECTED).isNotNull()
    return found.filter(~bad).select(*schema.names), found.filter(bad).select("arquivo", F.col(REJECTED).alias("linha"))


def stack_years(tables: Mapping[int, DataFrame]) -> DataFrame:
    """One DataFrame from one table per source year, with the year as a column."""
    marked = [df.withColumn(YEAR, F.lit(year)) for year, df in sorted(tables.items())]
    return reduce(DataFrame.unionByName, marked)


def read_years(
    spark: SparkSession, paths: Mapping[int, str], schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    return stack_years({y: read_table(spark, p, schema, fmt) for y, p in paths.items()})
