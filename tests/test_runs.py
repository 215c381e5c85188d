"""Sources, sinks, and the two scheduled runs against real folders."""

from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import counted, d, rows, ts
from ledgermill import schemas
from ledgermill.plans import monitor, refresh
from ledgermill.session import stored
from ledgermill.sources.readers import read_table, read_years
from ledgermill.sources.writers import (
    append_table,
    on_load_days,
    read_stored,
    replace_load_days,
    replace_table,
)
from test_ledger import balances, cost_forms, costs, credits, forms, receipts
from test_monitoring import P, access_log, job, job_log


def test_csv_years_are_read_with_their_schema(spark, tmp_path):
    for year in (2021, 2022):
        (tmp_path / f"{year}.csv").write_text(
            "tipo_custo,custo,valor_custo,dt_mes_base,dt_custo,process_time\n"
            f"mercado,pao,1.5,{year}-01-01,{year}-01-02,{year}-01-03 10:00:00\n"
        )
    df = read_years(spark, {y: str(tmp_path / f"{y}.csv") for y in (2021, 2022)}, schemas.COST, "csv")
    assert counted(df, "custo", "valor_custo", "dt_custo", "ano_fonte") == Counter(
        [("pao", 1.5, d(f"{y}-01-02"), y) for y in (2021, 2022)]
    )


@pytest.mark.parametrize(
    "text",
    [
        "tipo_custo,custo,wrong,dt_mes_base,dt_custo,process_time\nm,p,1.5,2021-01-01,2021-01-02,2021-01-03 10:00:00\n",
        "tipo_custo,custo,valor_custo,dt_mes_base,dt_custo,process_time\nm,p,dear,2021-01-01,2021-01-02,2021-01-03 10:00:00\n",
    ],
)
def test_bad_csv_fails(spark, tmp_path, text):
    (tmp_path / "bad.csv").write_text(text)
    with pytest.raises(Exception):
        read_table(spark, str(tmp_path / "bad.csv"), schemas.COST, "csv").collect()


def test_parquet_of_another_shape_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", 1)], "schema_name string, n int").write.parquet(path)
    assert read_table(spark, path, schemas.SCHEMATA).columns == ["schema_name"]
    with pytest.raises(ValueError, match="columns"):
        read_table(spark, path, schemas.ACCESS_LOG)


def test_append_creates_then_appends_and_checks_columns(spark, tmp_path):
    path = str(tmp_path / "log")
    one = spark.createDataFrame([("t", "ds", d("2024-01-01"), "a")], schemas.ACCESS_LOG)
    append_table(one, path, schemas.ACCESS_LOG)
    append_table(one.select(*reversed(one.columns)), path, schemas.ACCESS_LOG)
    assert counted(read_table(spark, path, schemas.ACCESS_LOG)) == counted(one.unionByName(one))
    with pytest.raises(ValueError, match="not in the table"):
        append_table(one.withColumn("extra", F.lit(1)), path, schemas.ACCESS_LOG)
    with pytest.raises(Exception):
        append_table(one.drop("user_email"), path, schemas.ACCESS_LOG)
    other = str(tmp_path / "other")
    replace_table(spark.range(3), other)
    with pytest.raises(ValueError, match="columns"):
        append_table(one, other, schemas.ACCESS_LOG)


def test_load_days_are_replaced_one_by_one_even_when_read(spark, tmp_path):
    path = str(tmp_path / "days")
    schema = schemas._table(k=schemas.STRING, at=schemas.CLOCK)
    assert read_stored(spark, path, schema).count() == 0
    data = [("a", ts("2024-01-01 10:00:00")), ("b", ts("2024-01-02 10:00:00"))]
    replace_load_days(spark.createDataFrame(data, schema), path, "at")
    today = on_load_days(read_stored(spark, path, schema), [d("2024-01-02")])
    assert rows(today) == [data[1]]
    replace_load_days(today.withColumn("k", F.lit("c")), path, "at")
    assert sorted(rows(read_stored(spark, path, schema), "k", "at")) == [data[0], ("c", data[1][1])]


def test_stored_keeps_rows_and_types(spark):
    df = spark.createDataFrame([(1, (2, "x")), (None, None)], "a int, s struct<b: int, c: string>")
    kept = stored(df)
    assert kept.schema.simpleString() == df.schema.simpleString()
    assert counted(kept) == counted(df)


def ledger_inputs(spark):
    return refresh.LedgerInputs(
        costs=costs(spark, [("mercado", "pao", 1.0, "2022-01-01", "2022-01-01", "2022-01-02 00:00:00")]),
        credits=credits(spark, [(2023, "farmacia", "gel", "2023-01-01", "2023-02-01", 7.0, "2023-01-02 00:00:00")]),
        receipts=receipts(spark, [(2022, "s", "2022-01-05", "2022-01-01", 9.0, "2022-01-06 00:00:00")]),
        balances=balances(spark, [(2022, "b", "2022-01-01", "2022-01-01", 5.0, "2022-01-06 00:00:00")]),
        cost_forms=cost_forms(spark, [("2023-08-01", "gas", "casa", "2023-08-25", 60.0, 2023, "Sim")]),
        receipt_forms=forms(spark, [("p", "2023-08-20", "2023-08-01", 70.0)]),
    )


def test_refresh_finance_writes_five_tables_and_can_run_again(spark, tmp_path):
    for _ in range(2):
        refresh.refresh_finance(ledger_inputs(spark), str(tmp_path), "2023-08-01", datetime(2023, 8, 1))
    read = {n: spark.read.parquet(f"{tmp_path}/{n}") for n in
            (refresh.COSTS, refresh.CREDITS, refresh.RECEIPTS, refresh.BALANCE, refresh.LIVING)}
    assert {n: df.count() for n, df in read.items()} == {
        refresh.COSTS: 2, refresh.CREDITS: 1, refresh.RECEIPTS: 1, refresh.BALANCE: 2, refresh.LIVING: 2,
    }
    assert sorted(rows(read[refresh.BALANCE], "dt_mes_base", "saldo_real")) == [
        (d("2022-01-01"), 13.0), (d("2023-08-01"), 0.0),
    ]


def test_monitoring_run_twice(spark, tmp_path):
    catalog = spark.createDataFrame(
        [(P, "ds", t, 5, 10**9, 0, 1_704_067_200_000, 1) for t in ("t1", "t2", "t9")], schemas.CATALOG
    )
    log = job_log(
        spark,
        job("2024-01-10 12:00:00", job_id="airflow_77"),
        job("2024-01-10 13:00:00", job_id="airflow_77"),
        job("2024-01-09 13:00:00", table="t2"),
    )
    inputs = refresh.WarehouseInputs(
        log, catalog, access_log(spark), spark.createDataFrame([(P, "ds", "t1", 3.5)], schemas.TABLE_COSTS)
    )
    as_of, root = datetime(2024, 1, 10, 18), str(tmp_path)

    def run(moment):
        refresh.monitoring_run(spark, inputs, root, moment, P, ["service", "bio"], ["service", "bio"])
        past = read_stored(spark, f"{root}/{refresh.HISTORY}", schemas.HISTORY)
        seen = read_stored(spark, f"{root}/{refresh.MONITOR}", schemas.MONITOR)
        return past, seen

    past, seen = run(as_of)
    status = counted(past, "table_id", F.to_date("data_carga"), "qtde_execucao", "status")
    want = Counter(
        [("t1", d("2024-01-10"), 2, "novo"), ("t2", d("2024-01-09"), 1, "novo")]
        + [("t9", d(f"2024-01-{day:02d}"), 0, "novo") for day in (7, 8, 9, 10, 11)]
        + [("t2", d("2024-01-10"), 0, "novo"), ("t1", d("2024-01-11"), 0, "novo")]
    )
    assert status == want
    one = seen.filter((F.col("table_id") == "t1") & (F.col("data_carga") == "2024-01-10")).first()
    assert (one.qtde_execucao, one.qtde_execucao_dia, one.custo_hist, one.custo_ano_bee) == (2, 2, "10", "3,5")
    assert one.executor_job_dia == "airflow"
    snapshots, monitored = past.count(), seen.count()
    assert snapshots == monitored

    # The same run again: every row of the restated days is corrected, none is added.
    past, seen = run(as_of)
    assert Counter(r[0] for r in rows(past, "status")) == {"atualizado": snapshots}
    assert seen.count() == monitored
    # Its details are replaced.
    assert spark.read.parquet(f"{root}/{refresh.DETAILS}").count() == 4

    # Five days later the old load days are not touched.
    before = counted(past.filter("dia_particao < '2024-01-12'"))
    past, _ = run(datetime(2024, 1, 15, 18))
    assert counted(past.filter("dia_particao < '2024-01-12'")) == before
    assert monitor.RESTATED_OFFSETS == range(-1, 4)


def test_monitoring_run_with_several_executors_on_the_eve(spark, tmp_path):
    """Two executors on the eve and yearly costs that name a table twice: three days in a row."""
    catalog = spark.createDataFrame([(P, "ds", "t1", 5, 10**9, 0, 1_704_067_200_000, 1)], schemas.CATALOG)
    log = job_log(
        spark,
        job("2024-01-09 12:00:00", job_id="airflow_77"),
        job("2024-01-09 13:00:00", job_id="scheduled_query_5"),
    )
    costs = spark.createDataFrame([(P, "ds", "t1", 3.5), (P, "ds", "t1", 4.5)], schemas.TABLE_COSTS)
    inputs = refresh.WarehouseInputs(log, catalog, access_log(spark), costs)
    for day in (10, 11, 12):
        refresh.monitoring_run(
            spark, inputs, str(tmp_path), datetime(2024, 1, day, 18), P, ["service", "bio"], ["service", "bio"]
        )
    past = read_stored(spark, f"{tmp_path}/{refresh.HISTORY}", schemas.HISTORY)
    idle = past.filter("executor_job = 'null'")
    assert idle.count() == idle.select(*history_keys()).distinct().count() > 0
    seen = read_stored(spark, f"{tmp_path}/{refresh.MONITOR}", schemas.MONITOR)
    assert seen.count() == seen.select("table_id", "data_carga").distinct().count() > 0
    assert {r[0] for r in rows(seen, "custo_ano_bee")} == {"4,5"}


def history_keys():
    return [F.expr(k) for k in refresh.history.HISTORY_KEYS]


def test_replace_table_keeps_the_old_table_when_the_write_fails(spark, tmp_path):
    path = f"{tmp_path}/t"
    replace_table(spark.range(3), path)
    with pytest.raises(Exception):
        replace_table(spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("id")), path)
    assert spark.read.parquet(path).count() == 3
    replace_table(spark.read.parquet(path).filter("id > 0"), path)
    assert spark.read.parquet(path).count() == 2
