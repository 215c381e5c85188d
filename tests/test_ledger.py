from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from helpers import counted, d, rows, ts
from ledgermill import schemas
from ledgermill.plans import balance, ledger
from ledgermill.sources.readers import stack_years


def table(spark, schema, data):
    return spark.createDataFrame(data, schema)


def costs(spark, data, year=2022):
    """Rows (tipo, custo, valor, month, day, loaded)."""
    return stack_years({year: table(spark, schemas.COST, [(*r[:3], d(r[3]), d(r[4]), ts(r[5])) for r in data])})


def credits(spark, data):
    """Rows (year, tipo, custo, bought, month, valor, loaded)."""
    years = {}
    for year, kind, item, bought, month, value, loaded in data:
        years.setdefault(year, []).append((kind, item, d(bought), d(month), value, ts(loaded)))
    return stack_years({y: table(spark, schemas.CREDIT, r) for y, r in years.items()})


def receipts(spark, data):
    """Rows (year, descricao, day, month, valor, loaded)."""
    years = {}
    for year, what, day, month, value, loaded in data:
        years.setdefault(year, []).append((what, d(day), d(month), value, ts(loaded)))
    return stack_years({y: table(spark, schemas.RECEIPT, r) for y, r in years.items()})


def balances(spark, data):
    years = {}
    for year, what, day, month, value, loaded in data:
        years.setdefault(year, []).append((what, d(day), d(month), value, ts(loaded)))
    return stack_years({y: table(spark, schemas.BANK_BALANCE, r) for y, r in years.items()})


def forms(spark, data):
    return table(spark, schemas.RECEIPT_FORM, [(w, d(a), d(m), v) for w, a, m, v in data])


def cost_forms(spark, data):
    """Rows (month, custo, tipo, day, valor, year, pending)."""
    return table(
        spark, schemas.COST_FORM,
        [(d(m), c, k, d(a), v, y, d(m).month, ledger_label(m), p) for m, c, k, a, v, y, p in data],
    )


def ledger_label(month):
    from ledgermill.functions.dates import MONTH_LABELS

    return MONTH_LABELS[d(month).month - 1]


def test_consolidated_cost_keeps_the_last_load_and_adds_pending_forecasts(spark):
    actual = costs(
        spark,
        [
            ("mercado", "pao", 1.1, "2022-02-01", "2022-02-03", "2022-02-04 10:00:00"),
            ("compras", "pao", 1.1, "2022-02-01", "2022-02-03", "2022-02-05 10:00:00"),
            ("b", "luz", 9.0, "2022-03-01", "2022-03-03", "2022-03-04 10:00:00"),
            ("a", "luz", 9.0, "2022-03-01", "2022-03-03", "2022-03-04 10:00:00"),
            ("a", "luz", 9.5, "2022-03-01", "2022-03-03", None),
        ],
    )
    planned = cost_forms(
        spark,
        [
            ("2023-08-01", "gas", "casa", "2023-08-09", 50.0, 2023, "Sim"),
            ("2023-08-01", "agua", "casa", "2023-08-09", 60.0, 2023, "Não"),
            ("2022-08-01", "agua", "casa", "2022-08-09", 60.0, 2022, "Sim"),
            ("2023-08-01", "net", "casa", "2023-08-09", 60.0, 2023, None),
        ],
    )
    got = ledger.consolidated_cost(actual, planned, 2023)
    assert got.columns == [
        "dt_mes_base", "custo", "tipo_custo", "dt_custo_bq", "valor_custo",
        "ano_base", "mes_base_ordem", "mes_base", "source",
    ]
    assert counted(got, "custo", "tipo_custo", "valor_custo", "ano_base", "mes_base", "source") == Counter(
        [
            ("pao", "compras", 1.1, 2022, "FEV", "consolidado"),
            ("luz", "a", 9.0, 2022, "MAR", "consolidado"),
            ("luz", "a", 9.5, 2022, "MAR", "consolidado"),
            ("gas", "casa", 50.0, 2023, "AGO", "previsão"),
        ]
    )


def test_duplicates_are_sought_within_a_source_year(spark):
    row = ("mercado", "pao", 1.1, "2022-02-01", "2022-02-03", "2022-02-04 10:00:00")
    both = costs(spark, [row], 2021).unionByName(costs(spark, [row], 2022))
    assert ledger.newest_costs(both).count() == 2


def test_credit_month_uses_the_purchase_date(spark):
    data = [
        (2022, "loja", "tv", "2021-12-30", "2022-01-01", 100.0, "2022-01-02 00:00:00"),
        (2022, "loja", "tv", "2021-12-30", "2022-01-01", 100.0, "2022-01-03 00:00:00"),
        (2022, "loja", "tv", "2021-12-30", "2022-01-01", 50.5, "2022-01-03 00:00:00"),
        (2023, "loja", "tv", "2021-12-30", "2022-01-01", 100.0, "2022-01-03 00:00:00"),
    ]
    got = rows(ledger.credit_month(credits(spark, data)))
    assert got == [("loja", "tv", date(2022, 1, 1), date(2021, 12, 30), 2021, 12, "DEZ", 250.5)]


RECEIPTS = [
    (2022, "salario", "2022-05-05", "2022-05-01", 10.0, "2022-05-06 00:00:00"),
    (2022, "salario", "2022-05-05", "2022-05-01", 10.0, "2022-05-07 00:00:00"),
    (2022, "extra", "2022-05-05", "2022-05-01", 10.0, "2022-05-06 00:00:00"),
    (2022, "bonus", "2022-05-20", "2022-05-01", 30.0, "2022-05-21 00:00:00"),
    (2022, "velho", "2020-05-20", "2020-05-01", 30.0, "2022-05-21 00:00:00"),
    (2023, "salario", "2022-05-05", "2022-05-01", 10.0, "2022-05-06 00:00:00"),
]


def test_receipts_are_numbered_before_copies_are_dropped(spark):
    got = counted(ledger.ordered_receipts(receipts(spark, RECEIPTS)), "descricao", "ordem_recebimento")
    # Copies of "salario" take places 3 and 4 of 2022; the kept row has the first of them.
    assert got == Counter(
        [("bonus", 1), ("extra", 2), ("salario", 3), ("velho", 1), ("salario", 1)]
    )


def test_receipts_meet_every_equal_forecast_from_the_day_on(spark):
    planned = forms(
        spark,
        [
            ("p1", "2022-05-05", "2022-05-01", 10.0),
            ("p2", "2022-05-05", "2022-05-01", 10.0),
            ("p3", "2022-05-20", "2022-05-01", 30.0),
        ],
    )
    loaded = datetime(2022, 6, 1, 8, 0)
    got = ledger.receipts_with_forecast(receipts(spark, RECEIPTS[:5]), planned, "2022-05-05", loaded)
    assert got.columns[-2:] == ["source", "data_atualizacao_jobs"]
    assert counted(got, "descricao", "fonte_previsao", "source") == Counter(
        [(w, p, "Previsto") for w in ("salario", "extra") for p in ("p1", "p2")]
        + [("bonus", "p3", "Previsto")]
    )
    later = ledger.receipts_with_forecast(receipts(spark, RECEIPTS[:5]), planned, "2022-05-06", loaded)
    assert counted(later, "descricao", "fonte_previsao", "source") == Counter(
        [("salario", None, "Historico"), ("extra", None, "Historico"), ("bonus", "p3", "Previsto")]
    )
    assert {r[0] for r in rows(later, F.to_timestamp("data_atualizacao_jobs"))} == {loaded}


def test_opening_balance_needs_first_row_and_last_load(spark):
    data = [
        (2021, "itau", "2021-01-02", "2021-01-01", 100.0, "2021-01-03 00:00:00"),
        (2021, "itau", "2021-01-05", "2021-01-01", 70.0, "2021-01-06 00:00:00"),
        # Reloaded unchanged: the first row is no longer the last load.
        (2022, "itau", "2022-01-02", "2022-01-01", 200.0, "2022-01-03 00:00:00"),
        (2022, "itau", "2022-01-02", "2022-01-01", 200.0, "2022-01-04 00:00:00"),
        # A null balance is not a row at all.
        (2023, "itau", "2023-01-01", "2023-01-01", None, "2023-01-03 00:00:00"),
        (2023, "itau", "2023-01-02", "2023-01-01", 300.0, "2023-01-03 00:00:00"),
        # Unknown load time beside a known one.
        (2023, "itau", "2023-02-02", "2023-02-01", 5.0, None),
        (2023, "itau", "2023-02-02", "2023-02-01", 5.0, "2023-02-03 00:00:00"),
        # Only unknown load times.
        (2023, "itau", "2023-03-02", "2023-03-01", 6.0, None),
    ]
    got = rows(balance.opening_balances(balances(spark, data)), "dt_mes_base", "saldo")
    assert sorted(got) == [(d("2021-01-01"), 100.0), (d("2023-01-01"), 300.0), (d("2023-03-01"), 6.0)]


def test_monthly_balance_of_the_ledger(spark):
    received = receipts(
        spark,
        [
            (2021, "s", "2021-01-05", "2021-01-01", 100.0, "2021-01-06 00:00:00"),
            (2021, "s", "2021-02-05", "2021-02-01", 100.0, "2021-02-06 00:00:00"),
            (2022, "s", "2022-01-05", "2022-01-01", 100.0, "2022-01-06 00:00:00"),
            (2022, "s", "2022-01-05", "2022-01-01", 100.0, "2022-01-07 00:00:00"),
            (2022, "s", "2022-02-05", "2022-02-01", 100.0, "2022-02-06 00:00:00"),
            (2022, "s", "2022-03-05", "2022-03-01", 100.0, "2022-03-06 00:00:00"),
            (2023, "s", "2023-06-05", "2023-06-01", 100.0, "2023-06-06 00:00:00"),
            (2023, "s", "2023-07-05", "2023-07-01", 100.0, "2023-07-06 00:00:00"),
        ],
    )
    planned = forms(
        spark,
        [
            ("p", "2023-07-20", "2023-07-01", 500.0),
            ("p", "2023-08-20", "2023-08-01", 700.0),
            ("old", "2023-07-09", "2023-07-01", 999.0),
        ],
    )
    spent = costs(
        spark,
        [
            ("k", "c", 30.0, "2022-01-01", "2022-01-09", "2022-01-10 00:00:00"),
            ("k", "c", 40.0, "2022-03-01", "2022-03-09", "2022-03-10 00:00:00"),
            ("k", "c", 10.0, "2023-06-01", "2023-06-09", "2022-03-10 00:00:00"),
            ("k", "c", 20.0, "2023-07-01", "2023-07-09", "2022-03-10 00:00:00"),
            ("k", "c", 5.0, "2021-01-01", "2021-01-09", "2022-03-10 00:00:00"),
            ("k", "c", 5.0, "2021-02-01", "2021-02-09", "2022-03-10 00:00:00"),
        ],
    )
    due = cost_forms(
        spark,
        [
            ("2023-07-01", "gas", "casa", "2023-07-25", 50.0, 2023, "Sim"),
            ("2023-08-01", "gas", "casa", "2023-08-25", 60.0, 2023, "Sim"),
        ],
    )
    bank = balances(
        spark,
        [
            (2022, "itau", "2022-01-02", "2022-01-01", 1000.0, "2022-01-03 00:00:00"),
            (2023, "itau", "2023-02-02", "2023-02-01", 9000.0, "2023-02-03 00:00:00"),
        ],
    )
    got = balance.monthly_balance(received, planned, spent, due, bank, "2023-07-10")
    assert got.columns == [
        "dt_mes_base", "valor_recebido", "valor_recebido_prev", "valor_custo_prev",
        "valor_custo_real", "saldo_prev", "saldo_real",
    ]
    assert sorted(rows(got)) == [
        # 2021 has no opening balance, so it has no balance at all.
        (d("2021-01-01"), 100.0, 0.0, 0.0, 5.0, 0.0, None),
        (d("2021-02-01"), 100.0, 0.0, 0.0, 5.0, 0.0, None),
        # 2022 opens with the bank; the month without costs is null, the next restarts.
        (d("2022-01-01"), 100.0, 0.0, 0.0, 30.0, 0.0, 1070.0),
        (d("2022-02-01"), 100.0, 0.0, 0.0, None, 0.0, None),
        (d("2022-03-01"), 100.0, 0.0, 0.0, 40.0, 0.0, 60.0),
        # Each forecast formula starts from the real balance of the month before.
        (d("2023-06-01"), 100.0, 0.0, 0.0, 10.0, 0.0, 90.0),
        (d("2023-07-01"), 100.0, 500.0, 50.0, 20.0, 520.0, 170.0),
        # Forecast only: received and real cost are 0, not null.
        (d("2023-08-01"), 0.0, 700.0, 60.0, 0.0, 810.0, 170.0),
    ]


def test_cost_of_living(spark):
    debit = costs(
        spark,
        [
            ("mercado", "pao", 1.0, "2022-01-01", "2022-01-01", "2022-01-02 00:00:00"),
            ("mercado", "pao", 2.0, "2022-01-01", "2022-01-01", "2022-01-02 00:00:00"),
            ("lazer", "cine", 2.0, "2022-01-01", "2022-01-01", "2022-01-02 00:00:00"),
            ("mercado", "pao", 4.0, "2021-12-01", "2021-12-01", "2022-01-02 00:00:00"),
            # The category filter comes after the choice of the last load.
            ("mercado", "uva", 4.0, "2022-02-01", "2022-02-01", "2022-01-02 00:00:00"),
            ("lazer", "uva", 4.0, "2022-02-01", "2022-02-01", "2022-01-03 00:00:00"),
        ],
    )
    card = credits(
        spark,
        [
            (2022, "farmacia", "gel", "2023-01-01", "2023-02-01", 7.0, "2022-01-02 00:00:00"),
            (2022, "farmacia", "gel", "2023-01-01", "2023-03-01", 7.0, "2022-01-02 00:00:00"),
            (2023, "farmacia", "gel", "2023-01-01", "2023-03-01", 7.0, "2022-01-02 00:00:00"),
        ],
    )
    got = ledger.cost_of_living(debit, card)
    day = date(2023, 1, 1)
    assert counted(got) == Counter(
        [
            # 1 January 2022 is a Saturday (week 0), 1 January 2023 a Sunday (week 1).
            (date(2022, 1, 1), "pao", "mercado", date(2022, 1, 1), 0, 2022, 1, "JAN", "debito", 3.0),
            (day, "gel", "farmacia", day, 1, 2023, 1, "JAN", "credito", 14.0),
            (day, "gel", "farmacia", day, 1, 2023, 1, "JAN", "credito", 7.0),
        ]
    )


@pytest.mark.parametrize("seed", [3, 4])
def test_row_order_does_not_matter(spark, seed):
    base = receipts(spark, RECEIPTS)
    mixed = base.orderBy(F.rand(seed)).repartition(5)
    assert counted(ledger.ordered_receipts(base)) == counted(ledger.ordered_receipts(mixed))
