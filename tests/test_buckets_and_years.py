"""Bucketed merge targets, access days as bitmaps, the balance by year, and corrections written back."""

import os
import random
import re
import uuid
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import counted, d, rows, ts
from ledgermill import schemas
from ledgermill.operators.balance import BalancePolicy
from ledgermill.plans import access, access_state, balance, balance_years, history, merges, monitor
from ledgermill.sources import buckets, writers
from test_monitoring import P, PREFIXES, detail, details
from test_state import files, history_rows


def above(df, table):
    """Operators above each scan of ``table`` in the physical plan."""
    found, path = [], []
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-*")) if line.strip() else 0
        name = re.sub(r"^[\s:+\-*]*(\(\d+\) )?", "", line)
        path = [(n, x) for n, x in path if n < depth]
        if table in name and "Scan" in name:
            found.append([x.split("(")[0].split(" ")[0] for _, x in path])
        path.append((depth, name))
    return found


@pytest.fixture
def merged(spark, tmp_path, conf):
    conf(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__shuffle__partitions="4")
    return f"t_{uuid.uuid4().hex}", str(tmp_path / "buckets")


def test_history_merge_takes_the_target_as_it_lies(spark, merged):
    name, path = merged
    day = "2024-01-15 12:00:00"
    runs = [detail(f"t{i % 7}", f"2024-01-15 {i % 5 + 8:02d}:00:00", cost=float(i)) for i in range(20)]
    idle = [detail("quiet", "2024-01-14 09:00:00"), detail("never", None)]
    log = details(spark, *runs, *idle)
    past = history_rows(spark, ("t1", "2024-01-15 09:00:00"), ("x", "2024-01-02 10:00:00"), ("y", "2024-01-15 10:00:00"))
    merges.store_history(past, name, path, 4)
    plain = past
    for _ in range(2):
        target = spark.table(name)
        scans = above(merges.history_merge(log, target, day, P), name)
        assert len(scans) == 3 and all("Exchange" not in x for x in scans), scans
        merges.merge_stored_history(spark, log, name, path, day, P, 4)
        plain = spark.createDataFrame(history.merge_history(log, plain, day, P).collect(), schemas.HISTORY)
        assert counted(spark.table(name), *schemas.HISTORY.names) == counted(plain, *schemas.HISTORY.names)
    assert len(os.listdir(path)) == 1  # one version


def test_monitor_merge_takes_the_target_as_it_lies(spark, merged):
    name, path = merged
    row = lambda table, day, **more: {**dict.fromkeys(schemas.MONITOR.names), "project_id": P, "dataset_id": "ds", "table_id": table, "data_carga": d(day), **more}
    make = lambda *data: spark.createDataFrame([tuple(r.values()) for r in data], schemas.MONITOR)
    past = make(row("a", "2024-01-01", custo_hist="1", custo_dia="2"), row("a", "2024-01-02", custo_hist="3", custo_dia="4"), row(None, "2024-01-02"))
    source = make(row("a", "2024-01-02", custo_hist="9", custo_dia="9"), row("b", "2024-01-02", custo_hist="5"), row(None, "2024-01-02", custo_hist="7"))
    merges.store_monitor(past, name, path, 4)
    df = merges.monitor_merge(source, spark.table(name), ["2024-01-02"])
    scans = above(df, name)
    assert len(scans) == 3 and all("Exchange" not in x for x in scans), scans
    want = counted(monitor.merge_monitor(source, past, ["2024-01-02"]))
    assert counted(df) == want
    merges.merge_stored_monitor(spark, source, name, path, ["2024-01-02"], 4)
    assert counted(spark.table(name)) == want

    # Another catalog learns the table from its folder.
    other = f"{name}_again"
    buckets.register_bucketed(spark, schemas.MONITOR, other, buckets.location(spark, name), monitor.MONITOR_KEYS, 4)
    again = merges.monitor_merge(source, spark.table(other), [])
    assert counted(spark.table(other)) == want and all("Exchange" not in x for x in above(again, other))


def test_a_failing_job_leaves_the_bucketed_table(spark, tmp_path):
    name, path = f"t_{uuid.uuid4().hex}", str(tmp_path / "b")
    buckets.replace_bucketed(spark.range(5), name, path, ["id"], 2)
    with pytest.raises(Exception, match="stop here"):
        broken = spark.range(3).withColumn("id", F.when(F.col("id") > 1, F.raise_error(F.lit("stop here"))).otherwise(F.col("id")))
        buckets.replace_bucketed(broken.select(F.col("id").cast("long").alias("id")), name, path, ["id"], 2)
    assert spark.table(name).count() == 5
    buckets.replace_bucketed(spark.table(name).filter("id > 0"), name, path, ["id"], 2)  # reads itself
    assert counted(spark.table(name)) == {(i,): 1 for i in range(1, 5)}


def test_access_days_add_up_to_a_full_rebuild(spark, tmp_path):
    draw = random.Random(4)
    emails = ["bio-1@x", "service-1@x", "ana@x", "dash@x", None, "bo@x"]
    days = ["0001-01-01", "1969-12-31", "1970-01-01", "2024-01-01", "2024-01-02", "2059-09-19", "2059-09-18", "9999-12-31", None]
    log = [(f"t{draw.randrange(12)}", draw.choice(["a", "b", None]), d(draw.choice(days)), draw.choice(emails)) for _ in range(250)]
    log.append(("undated", "a", None, "ana@x"))
    tables = spark.createDataFrame([*((f"t{i}",) for i in range(10)), ("t1",), ("undated",), ("absent",)], "table_id string")
    make = lambda data: spark.createDataFrame(data, schemas.ACCESS_LOG)
    want = counted(access.last_access_flags(make(log), tables, P, ["dash@x"], PREFIXES))
    path = str(tmp_path / "state")
    for part in (log[:100], log[100:180], [], log[180:], log[50:120]):  # the last one repeats rows
        access_state.add_access(spark, make(part), path, ["dash@x"], PREFIXES)
    state = writers.read_stored(spark, path, schemas.ACCESS_DAYS)
    assert counted(access_state.flags_of(state, tables, P)) == want and len(want) > 20


def test_highest_bit_is_the_last_day(spark):
    first = date(2023, 1, 1)
    every = spark.range(400).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("access_date"))
    one = every.select(F.date_format("access_date", "yyyyMMdd").alias("table_id"), F.lit("ds").alias("dataset_id"), "access_date", F.lit("ana@x").alias("user_email"))
    state = access_state.access_days(one, [], PREFIXES)
    got = state.select("table_id", access_state.last_day(F.col("bucket"), F.col("days")).alias("day"))
    assert {r[0]: r[1] for r in rows(got)} == {f"{first + timedelta(i):%Y%m%d}": first + timedelta(i) for i in range(400)}


FIRST, SECOND = ts("2024-01-01 00:00:00"), ts("2024-02-01 00:00:00")


def ledger(spark, late):
    """Receipts, forms, costs, pending costs and balances of three years; ``late`` adds rows loaded later."""
    draw = random.Random(9)
    receipts, costs, forms, due, banks = [], [], [], [], []
    for year in (2021, 2022, 2023):
        banks.append((f"b{year}", d(f"{year}-01-02"), d(f"{year}-01-01"), 100.0, FIRST, year, 0))
        for month in range(1, 13):
            if draw.random() < 0.85:
                for _ in range(3):
                    day, value = d(f"{year}-{month:02d}-03"), float(draw.randrange(1, 50))
                    receipts.append((f"r{value}", day, day.replace(day=1), value, FIRST, year, 0))
                    costs.append((f"c{value}", "t", day.replace(day=1), day, value / 2, FIRST, year, 0))
    if late:
        day = d("2022-03-03")
        receipts.append(("late", day, day.replace(day=1), 1000.0, SECOND, 2022, 0))
    forms += [("f", d("2023-11-03"), d("2023-11-01"), 7.0), ("f", d("2023-05-03"), d("2023-05-01"), 8.0)]
    return receipts, forms, costs, due, banks


def frames(spark, late):
    receipts, forms, costs, due, banks = ledger(spark, late)
    more = "process_time timestamp_ntz, ano_fonte int, conta int"
    return {
        "receipts": spark.createDataFrame(receipts, f"descricao string, dt_recebido date, dt_mes_base date, valor_recebido double, {more}"),
        "forms": spark.createDataFrame([(*f, 0) for f in forms], "descricao string, dt_recebido date, dt_mes_base date, valor_recebido double, conta int"),
        "costs": spark.createDataFrame(costs, f"custo string, tipo_custo string, dt_mes_base date, dt_custo date, valor_custo double, {more}"),
        "cost_forms": spark.createDataFrame([], schemas.COST_FORM).withColumn("conta", F.lit(0)),
        "balances": spark.createDataFrame(banks, f"descricao string, dt_recebido date, dt_mes_base date, saldo double, {more}"),
    }


def test_the_balance_by_year_reopens_years_of_late_rows(spark, tmp_path):
    path, policy = str(tmp_path / "saldo"), BalancePolicy(strict_years=frozenset({2021}))
    options = {"forecast_year": 2023, "by": ["conta"], "policy": policy}

    def whole(data, as_of):
        return counted(balance.monthly_balance(**data, as_of=as_of, **options))

    def kept():
        return counted(spark.read.parquet(path).drop(balance_years.YEAR_OF))

    early = frames(spark, late=False)
    balance_years.refresh_balance(spark, path, **early, as_of="2023-05-01", **options)
    assert kept() == whole(early, "2023-05-01")
    before = files(path)

    # A late receipt in a closed year reopens that year; 2021 keeps its files.
    now = frames(spark, late=True)
    args = (now["receipts"], now["costs"], now["balances"], now["forms"])
    assert balance_years.reopened_years(*args, datetime(2024, 1, 15), "2023-05-01", "2023-05-01") == [2022]
    assert balance_years.reopened_years(*args, datetime(2024, 3, 1), "2023-05-01", "2023-06-01") == [2023]
    assert balance_years.reopened_years(*args, datetime(2024, 3, 1), "2023-06-01", "2023-06-01") == []
    balance_years.refresh_balance(spark, path, **now, as_of="2023-05-01", years=[2022], **options)
    assert kept() == whole(now, "2023-05-01") != whole(early, "2023-05-01")
    stays = {f for f in before if "=2022" not in f}
    assert stays and stays < set(files(path))

    # A year that has no rows any more goes; the scan of a year reads that year's rows only.
    gone = {k: v.filter(F.year("dt_mes_base") != 2022) if k in ("receipts", "costs", "balances") else v for k, v in now.items()}
    balance_years.refresh_balance(spark, path, **gone, as_of="2023-05-01", years=[2022, 2023], **options)
    assert kept() == whole(gone, "2023-05-01")
    balance_years.refresh_balance(spark, path, **now, as_of="2023-05-01", years=[], **options)
    assert kept() == whole(gone, "2023-05-01")


def test_a_year_reads_its_own_rows_only(spark, tmp_path):
    data = frames(spark, late=True)
    for name in ("receipts", "costs"):
        data[name].write.parquet(f"{tmp_path}/{name}")
        data[name] = spark.read.parquet(f"{tmp_path}/{name}")
    text = balance_years.balance_of_years(**data, as_of="2023-05-01", years=[2022])._jdf.queryExecution().toString()
    assert len(re.findall(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(dt_mes_base,2022-01-01", text)) >= 2


def test_corrections_rewrite_only_partitions_with_matches(spark, tmp_path):
    path = str(tmp_path / "t")
    data = [(i, f"n{i}", ["a", "b", None, "c"][i % 4], i % 4) for i in range(40)] + [(99, "n99", "a", None)]
    spark.createDataFrame(data, "id int, name string, kind string, part int").write.partitionBy("part").parquet(path)
    before = files(path)
    rules = [(F.col("kind") == "b", "B"), (F.col("id").isin(3, 7), "seven"), (F.col("kind") == "c", "c")]
    assert sorted(writers.write_corrections(spark, path, "part", "kind", rules)) == [1, 3]
    want = {1: lambda i, k: "B", 3: lambda i, k: "seven" if i in (3, 7) else "c"}
    expected = {(i, n, want.get(p, lambda i, k: k)(i, k), p): 1 for i, n, k, p in data}
    assert counted(spark.read.parquet(path), "id", "name", "kind", "part") == expected
    assert {f for f in before if "part=1" not in f and "part=3" not in f} < set(files(path))
    after = files(path)
    assert writers.write_corrections(spark, path, "part", "kind", rules) == [] and files(path) == after
    # Rows of the partition without a value, and a null that is filled.
    assert writers.write_corrections(spark, path, "part", "kind", [(F.col("id") == 99, "z")]) == [None]
    assert writers.write_corrections(spark, path, "part", "kind", [(F.col("kind").isNull(), "n")]) == [2]
    found = {r[0]: r[1] for r in rows(spark.read.parquet(path), "id", "kind")}
    assert found[99] == "z" and found[2] == "n" and len(found) == 41
    assert writers.write_corrections(spark, path, "part", "kind", []) == []
    with pytest.raises(ValueError, match="would move"):
        writers.write_corrections(spark, path, "part", "part", [])
