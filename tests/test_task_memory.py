"""What a task holds: words instead of bitmaps, one sort for all windows, smaller tasks for sums by account."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import counted, d, rows
from ledgermill import schemas, session
from ledgermill.operators.balance import BalancePolicy, running_balance
from ledgermill.plans import access_state, balance, balance_years, refresh
from test_buckets_and_years import frames
from test_scale import plan_of

PREFIXES = ["service"]


def test_access_days_are_hash_aggregates_of_words(spark):
    first = date(1969, 10, 1)
    log = [(f"t{i}", "ds", first + timedelta(j), "ana@x") for i in range(200) for j in (0, i)]
    state = access_state.access_days(spark.createDataFrame(log, "table_id string, dataset_id string, access_date date, user_email string"), [], PREFIXES)
    both = access_state.added(state, state)
    assert "SortAggregate" not in plan_of(both) and "ObjectHash" not in plan_of(both)
    assert dict(schemas.ACCESS_DAYS["days"].jsonValue())["type"] == "long"
    last = both.select("table_id", access_state.last_day(F.col("bucket"), F.col("days")).alias("day")).groupBy("table_id").agg(F.max("day"))
    assert dict(rows(last)) == {f"t{i}": first + timedelta(i) for i in range(200)}


def test_one_sort_does_for_all_windows_of_the_balance(spark):
    flow = "conta int, dt_mes_base date, valor_recebido decimal(38,6), valor_recebido_prev decimal(38,6), custo_prev decimal(38,6), custo_real decimal(38,6), saldo decimal(38,6)"
    # Chains: with the opening balance; anew after a month without costs; anew after a missing month.
    cost = {1: 1, 2: 1, 3: None, 4: 2, 5: 2, 8: 3, 9: 4}
    data = [(1, d(f"2022-{m:02d}-01"), 10, 0, 0, c, 100 if m == 1 else None) for m, c in cost.items()]
    months = spark.createDataFrame([tuple(str(v) if i > 1 and v is not None else v for i, v in enumerate(r)) for r in data],
                                   "conta int, dt_mes_base date, a string, b string, c string, d string, e string")
    months = months.toDF(*[f.split()[0] for f in flow.split(", ")]).selectExpr(
        *[f"cast({f.split()[0]} as {f.split()[1]}) as {f.split()[0]}" for f in flow.split(", ")]
    )
    got = running_balance(months, BalancePolicy(), ["conta"])
    physical = plan_of(got).split("== Physical Plan ==")[-1]
    assert physical.count("Sort [") == 1, physical
    assert dict(rows(got, "dt_mes_base", "saldo_real")) == {
        d(f"2022-{m:02d}-01"): v for m, v in {1: 109, 2: 118, 3: None, 4: 8, 5: 16, 8: 7, 9: 13}.items()
    }


def test_sums_by_account_run_in_smaller_tasks(spark, conf, monkeypatch, tmp_path):
    conf(**{session.TASK_SIZE: "64MB"})
    seen = []

    def watched(df):
        seen.append(session.bytes_of(spark.conf.get(session.TASK_SIZE)))
        return session.stored(df)

    for module in (balance, balance_years):
        monkeypatch.setattr(module, "stored", watched)
    data, options = frames(spark, late=True), {"forecast_year": 2023, "by": ["conta"], "policy": BalancePolicy()}
    whole = balance.monthly_balance(**data, as_of="2023-05-01", **options)
    balance_years.refresh_balance(spark, str(tmp_path / "b"), **data, as_of="2023-05-01", **options)
    assert counted(spark.read.parquet(str(tmp_path / "b")).drop(balance_years.YEAR_OF)) == counted(whole)
    assert seen == [session.SMALL_TASK] * 2 and spark.conf.get(session.TASK_SIZE) == "64MB"
    conf(**{session.TASK_SIZE: "1m"})  # a smaller setting stays
    with session.smaller_tasks(spark):
        assert spark.conf.get(session.TASK_SIZE) == "1m"


@pytest.mark.parametrize("size, wanted", [("64MB", 1 << 26), ("67108864b", 1 << 26), ("16m", 1 << 24), ("5", 5), ("1 g".replace(" ", ""), 1 << 30)])
def test_sizes_are_read_as_spark_writes_them(size, wanted):
    assert session.bytes_of(size) == wanted


def test_the_ledger_run_seeks_the_duplicates_of_costs_once(spark, monkeypatch, tmp_path):
    cost = "custo string, tipo_custo string, dt_mes_base date, dt_custo date, valor_custo double, process_time timestamp_ntz, ano_fonte int"
    at = datetime(2022, 5, 1)
    loads = [("pao", kind, d("2022-01-01"), d("2022-01-03"), 2.0, at + timedelta(i), 2022) for i, kind in enumerate("abb")]
    loads += [(None, None, None, None, None, None, None)] * 2 + [("pao", "a", d("2022-01-01"), d("2022-01-03"), None, at, 2022)]
    loads += [("pao", "a", d("2022-01-01"), d("2022-01-03"), 2.0, at, 2021), ("gas", "a", d("2022-02-01"), d("2022-02-03"), 3.0, None, 2022)]
    costs = spark.createDataFrame(loads, cost)
    data = frames(spark, late=True)
    due = spark.createDataFrame([], schemas.COST_FORM)
    others = {k: data[k].drop("conta") for k in ("receipts", "balances")}
    inputs = refresh.LedgerInputs(costs, spark.createDataFrame([], schemas.CREDIT).withColumn("ano_fonte", F.lit(2022)), others["receipts"], others["balances"], due, data["forms"].drop("conta"))
    given, whole = [], balance.monthly_balance

    def watched(*args, **options):
        given.append(options.get("spent"))
        return whole(*args, **options)

    monkeypatch.setattr(refresh.balance, "monthly_balance", watched)
    for _ in range(2):
        refresh.refresh_finance(inputs, str(tmp_path), "2023-05-01", at, forecast_year=2023)
    want = whole(others["receipts"], inputs.receipt_forms, costs, due, others["balances"], "2023-05-01", 2023)
    assert counted(spark.read.parquet(f"{tmp_path}/{refresh.BALANCE}")) == counted(want)
    assert len(given) == 2 and all(df is not None and "Aggregate" not in plan_of(df) for df in given)
    # Held as another type, they are sought anew.
    assert refresh.distinct_costs(costs.withColumn("valor_custo", F.col("valor_custo").cast("float")), f"{tmp_path}/{refresh.COSTS}") is None
