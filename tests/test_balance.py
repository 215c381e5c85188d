"""The balance against a chain walked month by month in Python."""

import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import rows
from ledgermill.operators.balance import (
    ALL_COSTS,
    FORECAST_COSTS,
    LEDGER_POLICY,
    BalancePolicy,
    running_balance,
)

COLUMNS = (
    "conta int, dt_mes_base date, valor_recebido decimal(18,2), valor_recebido_prev decimal(18,2),"
    " custo_prev decimal(18,2), custo_real decimal(18,2), saldo decimal(18,2)"
)


#: The months that the tests draw rows for; the policy itself has no limits.
MONTHS = [date(2020 + n // 12, n % 12 + 1, 1) for n in range(60)]


def chain(data: dict, policy: BalancePolicy) -> list[tuple]:
    """One account: month -> (received, planned, due, spent, bank)."""
    out, previous = [], None
    for month in MONTHS:
        if month.month == 1:
            previous = None
        row = data.get(month)
        if row is None:
            previous = None
            continue
        received, planned, due, spent, bank = row
        strict = month.year in policy.strict_years
        keep = policy.forecast_from and month >= policy.forecast_from and month not in policy.no_forecast
        planned, due = (planned, due) if keep else (Decimal(0), Decimal(0))
        opening = bank if month.month == 1 else previous
        balance = None
        if spent is not None and (opening is not None or not strict):
            balance = received - spent + (opening or 0)
        formula, forecast = policy.forecast_balance.get(month), Decimal(0)
        if formula == ALL_COSTS:
            forecast = None if None in (due, spent) else planned - (due + spent) + (opening or 0)
        elif formula == FORECAST_COSTS:
            forecast = None if due is None else planned - due + (opening or 0)
        out.append((month, received, planned, due, spent, forecast, balance))
        previous = balance
    return out


def random_months(rng, policy):
    def amount(null=0.0):
        return None if rng.random() < null else Decimal(rng.randrange(0, 100_000)) / 100

    data = {}
    for month in MONTHS:
        if rng.random() < 0.12:
            continue
        spent = amount(0.12)
        due = amount(0.1) if spent is not None else None
        data[month] = (amount(), amount(), due, spent, amount(0.3))
    return data


@pytest.mark.parametrize("seed", range(3))
def test_window_equals_the_literal_chain(spark, seed):
    rng = random.Random(seed)
    accounts = {a: random_months(rng, LEDGER_POLICY) for a in range(60)}
    data = [(a, m, *v) for a, months in accounts.items() for m, v in months.items()]
    rng.shuffle(data)
    df = spark.createDataFrame(data, COLUMNS)
    got = {(r[0], r[1]): r[2:] for r in rows(running_balance(df, LEDGER_POLICY, ["conta"]))}
    want = {
        (a, r[0]): tuple(None if v is None else float(v) for v in r[1:])
        for a, months in accounts.items()
        for r in chain(months, LEDGER_POLICY)
    }
    assert got == want


def test_policy_months_and_exceptions(spark):
    df = spark.createDataFrame([(m,) for m in MONTHS], "m date")
    table = {r[0]: r[1:] for r in rows(df.withColumns(LEDGER_POLICY.rules(F.col("m"))))}
    assert table[date(2021, 5, 1)] == (True, False, None)
    assert table[date(2022, 2, 1)] == (False, False, None)
    assert table[date(2022, 3, 1)] == (False, True, None)
    assert table[date(2023, 1, 1)] == (False, False, None)
    assert table[date(2023, 7, 1)] == (False, True, ALL_COSTS)
    assert table[date(2023, 8, 1)] == (False, True, FORECAST_COSTS)


def test_every_month_is_reported_unless_limits_are_given(spark):
    df = spark.createDataFrame([(1, m, *[Decimal(1)] * 5) for m in MONTHS], COLUMNS)
    assert [r[0] for r in sorted(rows(running_balance(df, LEDGER_POLICY, ["conta"]), "dt_mes_base"))] == MONTHS
    limited = BalancePolicy(first=MONTHS[3], last=MONTHS[9])
    assert [r[0] for r in sorted(rows(running_balance(df, limited, ["conta"]), "dt_mes_base"))] == MONTHS[3:10]
