"""Cost rules of the warehouse."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prices and thresholds.
BYTES_PER_TB = 1024**4
USD_PER_TB = 5
STORAGE_USD_PER_GB = 0.02
FREE_STORAGE_GB = 10
FREE_SCAN_TB = 1


def billed_tb(size: Column) -> Column:
    return F.round(size / F.lit(BYTES_PER_TB), 6)


def query_cost(size: Column) -> Column:
    return F.round(size / F.lit(BYTES_PER_TB) * USD_PER_TB, 6)


def decimal_size(size: Column, power: int) -> Column:
    """Size in units of 10**power bytes, two decimals."""
    return F.round(size / F.lit(float(10**power)), 2)


def storage_cost(size: Column) -> Column:
    gigabytes = decimal_size(size, 9)
    return F.when(
        gigabytes > FREE_STORAGE_GB, F.round(gigabytes * STORAGE_USD_PER_GB, 6)
    ).otherwise(0.0)


def scan_estimate(size: Column) -> Column:
    terabytes = decimal_size(size, 12)
    return F.when(terabytes > FREE_SCAN_TB, F.round(terabytes * USD_PER_TB, 6)).otherwise(0.0)
