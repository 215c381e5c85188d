"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def regexp_group(text: Column, pattern: str) -> Column:
    """First capture group of the first match, null if there is no match."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def decimal_comma(value: Column, null: str | None = "0") -> Column:
    """Two decimals at most, no trailing zeros, comma as the decimal mark.

    Formats from DECIMAL, because the text of a double differs between engines.
    """
    plain = F.round(value, 2).cast("decimal(38,2)").cast("string")
    short = F.rtrim(F.rtrim(plain, F.lit("0")), F.lit("."))
    text = F.replace(short, F.lit("."), F.lit(","))
    return text if null is None else F.coalesce(text, F.lit(null))
