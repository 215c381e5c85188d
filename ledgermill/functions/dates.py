"""Calendar fields and local time."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Partition column of a job log that is stored by local day.
LOCAL_DAY = "dia_local"

# Local zone and month labels.
LOCAL_ZONE = "America/Sao_Paulo"
MONTH_LABELS = (
    "JAN", "FEV", "MAR", "ABR", "MAI", "JUN",
    "JUL", "AGO", "SET", "OUT", "NOV", "DEZ",
)


def day_of(value: str | date | datetime) -> date:
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    return value.date() if isinstance(value, datetime) else value


def moment_of(value: str | date | datetime) -> datetime:
    if isinstance(value, str):
        return datetime.fromisoformat(value)
    return value if isinstance(value, datetime) else datetime(value.year, value.month, value.day)


def days_before(value: str | date | datetime, days: int) -> date | datetime:
    """``value`` minus ``days``; a negative count lies in the future."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    return value - timedelta(days=days)


def date_lit(value: str | date | datetime) -> Column:
    return F.lit(day_of(value))


def datetime_lit(value: str | date | datetime) -> Column:
    return F.lit(moment_of(value).isoformat(sep=" ")).cast("timestamp_ntz")


def month_label(day: Column) -> Column:
    return F.get(F.array(*[F.lit(m) for m in MONTH_LABELS]), F.month(day) - 1)


def sunday_week(day: Column) -> Column:
    """Week of the year, weeks starting on Sunday, days before the first Sunday = 0."""
    return F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7).cast("int")


def add_calendar(df: DataFrame, date_col: str, week: bool = False) -> DataFrame:
    day = F.col(date_col)
    fields = {"semana_base": sunday_week(day)} if week else {}
    fields |= {
        "ano_base": F.year(day),
        "mes_base_ordem": F.month(day),
        "mes_base": month_label(day),
    }
    return df.withColumns(fields)


def is_ntz(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.TimestampNTZType)


def utc_clock(instant: Column) -> Column:
    """UTC wall clock of an instant, whatever the session time zone is."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)


def local_datetime(moment: Column, zone: str = LOCAL_ZONE, ntz: bool = False) -> Column:
    """Local wall clock of an instant; ``ntz`` marks a column that is a UTC clock already."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), moment if ntz else utc_clock(moment))


def local_date(moment: Column, zone: str = LOCAL_ZONE, ntz: bool = False) -> Column:
    return F.to_date(local_datetime(moment, zone, ntz))


def local_midnight(day: str | date | datetime, zone: str = LOCAL_ZONE, ntz: bool = False) -> Column:
    """First moment of a local day, as a constant the Parquet scan can compare with.

    ``moment >= local_midnight(d)`` keeps the same rows as ``local_date(moment) >= d``,
    but reaches the scan as a plain range on the stored column.
    """
    midnight = f"{day_of(day).isoformat()} 00:00:00"
    if ntz:
        clock = F.lit(midnight).cast("timestamp_ntz")
        return F.convert_timezone(F.lit(zone), F.lit("UTC"), clock)
    return F.lit(f"{midnight} {zone}").cast("timestamp")


def with_local_day(df: DataFrame, moment: str, zone: str = LOCAL_ZONE) -> DataFrame:
    return df.withColumn(LOCAL_DAY, local_date(F.col(moment), zone, is_ntz(df, moment)))


def in_local_days(
    df: DataFrame,
    moment: str,
    since: str | date | datetime | None = None,
    until: str | date | datetime | None = None,
    zone: str = LOCAL_ZONE,
) -> DataFrame:
    """Rows from local day ``since`` to local day ``until``, both included.

    The range on the stored moment reaches the Parquet scan; a table that is stored by local day
    is also read in these day folders only.
    """
    ntz, at = is_ntz(df, moment), F.col(moment)
    if since is not None:
        df = df.filter(at >= local_midnight(since, zone, ntz))
    if until is not None:
        df = df.filter(at < local_midnight(days_before(day_of(until), -1), zone, ntz))
    if LOCAL_DAY in df.columns:
        day = F.col(LOCAL_DAY)
        df = df if since is None else df.filter(day >= date_lit(since))
        df = df if until is None else df.filter(day <= date_lit(until))
    return df


def whole_seconds(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)
