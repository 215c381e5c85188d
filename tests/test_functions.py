from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import rows
from ledgermill.functions import classify, costs, dates
from ledgermill.functions.text import decimal_comma, regexp_group


def test_week_starts_on_sunday_and_counts_from_zero(spark):
    first = date(2015, 1, 1)
    days = [(first + timedelta(days=i),) for i in range(4383)]
    df = spark.createDataFrame(days, "day date")
    for day, week in rows(df.select("day", dates.sunday_week(F.col("day")))):
        assert week == int(day.strftime("%U")), day


def test_calendar_fields(spark):
    df = spark.createDataFrame([(date(2023, m, 1),) for m in range(1, 13)] + [(None,)], "day date")
    got = rows(dates.add_calendar(df, "day").orderBy(F.asc_nulls_last("day")))
    assert [r[3] for r in got] == [*dates.MONTH_LABELS, None]
    assert got[4][1:3] == (2023, 5)
    assert got[-1] == (None, None, None, None)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_local_time_ignores_the_session_zone(spark, conf, zone):
    conf(spark__sql__session__timeZone=zone)
    df = spark.sql(
        "select timestamp '2024-01-01 02:00:00 UTC' at, timestamp_ntz '2024-01-01 02:00:00' clock"
    )
    got = df.select(
        dates.local_datetime(F.col("at")),
        dates.local_datetime(F.col("clock"), ntz=True),
        dates.local_date(F.col("at")),
    ).first()
    assert tuple(got) == (datetime(2023, 12, 31, 23), datetime(2023, 12, 31, 23), date(2023, 12, 31))


def test_midnight_bound_equals_local_date_around_clock_changes(spark):
    # Days on which the local clock skipped or repeated midnight, and a plain day.
    for day in (date(2018, 11, 4), date(2018, 2, 18), date(2024, 1, 1)):
        hours = spark.range(-30, 30).select(
            F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit(datetime(day.year, day.month, day.day))).alias("at")
        )
        clock = hours.select(F.col("at"), dates.utc_clock(F.col("at")).alias("clock"))
        wrong = clock.filter(
            ((F.col("at") >= dates.local_midnight(day)) != (dates.local_date(F.col("at")) >= dates.date_lit(day)))
            | (
                (F.col("clock") >= dates.local_midnight(day, ntz=True))
                != (dates.local_date(F.col("clock"), ntz=True) >= dates.date_lit(day))
            )
        )
        assert wrong.count() == 0, day


def test_whole_seconds_truncates(spark):
    df = spark.sql("select timestamp '2024-01-01 00:00:00' a, timestamp '2024-01-01 00:00:01.999' b")
    assert df.select(dates.whole_seconds(F.col("a"), F.col("b"))).first()[0] == 1


def test_days_before_accepts_negative_counts():
    assert dates.days_before(date(2024, 1, 1), -1) == date(2024, 1, 2)
    assert dates.days_before("2024-01-01 10:00:00", 1) == datetime(2023, 12, 31, 10)


@pytest.mark.parametrize(
    "value, text",
    [
        (5.0, "5"), (10.0, "10"), (100.0, "100"), (0.0, "0"), (0.1, "0,1"), (1.10, "1,1"),
        (1234567.891, "1234567,89"), (-2.5, "-2,5"), (0.005, "0,01"), (None, "0"),
    ],
)
def test_decimal_comma(spark, value, text):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(decimal_comma(F.col("x"))).first()[0] == text
    if value is None:
        assert df.select(decimal_comma(F.col("x"), null=None)).first()[0] is None


def test_regexp_group_is_null_without_match(spark):
    df = spark.createDataFrame([("ab1",), ("x",), (None,)], "t string")
    assert [r[0] for r in rows(df.select(regexp_group(F.col("t"), r"^(ab)\d")))] == ["ab", None, None]


@pytest.mark.parametrize(
    "job_id, parent, wide, narrow",
    [
        ("airflow_1a", None, "airflow", "airflow"),
        ("airflow_", None, "manual", "manual"),
        ("airflow_b", None, "manual", "manual"),
        ("airflow_1b", None, "airflow", "airflow"),
        ("scheduled_query_12", None, "consulta_programada", "consulta_programada"),
        ("job_1", "scheduled_query_12", "consulta_programada", "consulta_programada"),
        ("script_job_77", "airflow_99", "airflow", "airflow"),
        ("script_job_77", "other_99", "script_job", "manual"),
        ("SCRIPT_JOB_77", "airflow_99", "SCRIPT_JOB", "manual"),
        ("x_airflow_77", None, "airflow", "airflow"),
        ("bquxjob_1", None, "manual", "manual"),
        (None, None, "manual", "manual"),
    ],
)
def test_executor_class(spark, job_id, parent, wide, narrow):
    df = spark.createDataFrame([(job_id, parent, None, None)], "j string, p string, d string, t string")
    df = classify.add_matches(df, *[F.col(c) for c in "jpdt"])
    got = df.select(classify.executor_class(), classify.executor_class(keep_other=False)).first()
    assert tuple(got) == (wide, narrow)


@pytest.mark.parametrize(
    "dataset, table, kind, anon",
    [
        ("_script1a2b", "t", "temp", None),
        ("_abc123xyz", "t", "temp", None),
        ("_abc123", "t", "_abc123", None),
        ("sales", "anon12", "sales", "anon"),
        ("sales", "anon", "sales", None),
        (None, None, None, None),
    ],
)
def test_dataset_class_and_anonymous_tables(spark, dataset, table, kind, anon):
    df = spark.createDataFrame([(None, None, dataset, table)], "j string, p string, d string, t string")
    df = classify.add_matches(df, *[F.col(c) for c in "jpdt"])
    assert tuple(df.select(classify.dataset_class(F.col("d")), "executor_anon_job").first()) == (kind, anon)


@pytest.mark.parametrize(
    "email, wide, narrow",
    [
        ("bio-1@x.example", "service account bio", "service account bio"),
        ("service-1@x.example", "service segurança", "service segurança"),
        ("core-1@x.example", "Na", "usuario nominal"),
        ("dash@x.example", "usuario de dash", "usuario de dash"),
        ("ana@x.example", "usuario nominal", "usuario nominal"),
        (None, "usuario nominal", "usuario nominal"),
    ],
)
def test_user_class(spark, email, wide, narrow):
    df = spark.createDataFrame([(email,)], "e string")
    e = F.col("e")
    got = df.select(
        *[
            classify.user_class(classify.user_prefix(e, p), e, ["dash@x.example"])
            for p in (("service", "bio", "core"), ("service", "bio"))
        ]
    ).first()
    assert tuple(got) == (wide, narrow)


@pytest.mark.parametrize(
    "size, storage, scan",
    [
        (10 * 10**9, 0.0, 0.0),
        (10 * 10**9 + 10**7, 0.2002, 0.0),
        (10**12, 20.0, 0.0),
        (10**12 + 10**10, 20.2, 5.05),
    ],
)
def test_storage_and_scan_thresholds(spark, size, storage, scan):
    df = spark.createDataFrame([(size,)], "b bigint")
    got = df.select(costs.storage_cost(F.col("b")), costs.scan_estimate(F.col("b"))).first()
    assert tuple(got) == (storage, scan)


def test_query_cost(spark):
    df = spark.createDataFrame([(1024**4,), (None,)], "b bigint")
    got = rows(df.select(costs.billed_tb(F.col("b")), costs.query_cost(F.col("b"))))
    assert got == [(1.0, 5.0), (None, None)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_money_is_wide_and_never_lost(spark, conf, ansi):
    from ledgermill.operators.aggregates import money_sum

    conf(spark__sql__ansi__enabled=ansi)
    df = spark.createDataFrame([(2e12,), (5.0,), (2e15,), (None,)], "v double")
    assert df.agg(money_sum(F.col("v"))).first()[0] == 2_002_000_000_000_005.0
    with pytest.raises(Exception):
        spark.createDataFrame([(1e30,)], "v double").agg(money_sum(F.col("v"))).first()
