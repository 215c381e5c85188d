"""The driver tables in the roles of the ledger and warehouse inputs.

Each role is a list of SQL expressions over one driver table. Most are written in the
common part of both dialects; a pair holds the Spark and the DuckDB form. Every role
uses all rows of its table. ``loads`` repeats a row as later loads of the same row.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.operators.balance import ALL_COSTS, FORECAST_COSTS, BalancePolicy

PROJECT = "acme-warehouse"
FLAG_USERS = ("dash@example.org",)
SNAPSHOT_USERS = ("dash@example.org", "board@example.org")
FLAG_PREFIXES = ("service", "bio", "core", "batch")
SNAPSHOT_PREFIXES = ("service", "bio")
LEDGER_AS_OF = "1998-06-01"
FORECAST_YEAR = 1998
SINCE = "1995-01-01"
CATEGORIES = ("mercado", "farmacia", "compras")
JOBS_AS_OF, JOB_DAYS = "2024-01-31", 45
AS_OF = "2024-01-15 12:00:00"
RUN_DAYS = 29  # from AS_OF back to the first day of JOB_DAYS
POLICY = BalancePolicy(
    strict_years=frozenset({1996}),
    forecast_from=date(1997, 3, 1),
    no_forecast=frozenset({date(1998, 1, 1)}),
    forecast_balance={date(1998, 7, 1): ALL_COSTS, date(1998, 8, 1): FORECAST_COSTS},
)

COST_KIND = (
    "CASE WHEN load > 0 THEN 'compras' WHEN l_returnflag = 'A' THEN 'mercado'"
    " WHEN l_returnflag = 'N' THEN 'farmacia' ELSE 'lazer' END"
)
TABLE_OF_USER = {
    "dataset_id": "'ds_' || CAST(user_id % 4 AS STRING)",
    "table_id": "'tbl_' || CAST(user_id AS STRING)",
}
TABLE_OF_PART = {
    "project_id": f"'{PROJECT}'",
    "dataset_id": "'ds_' || CAST(p_partkey % 4 AS STRING)",
    "table_id": "'tbl_' || CAST(p_partkey AS STRING)",
}
JOB_TARGET = {
    "project_id": f"CASE WHEN user_id % 11 = 0 THEN 'other-project' ELSE '{PROJECT}' END",
    "dataset_id": (
        "CASE WHEN event_id % 17 = 0 THEN '_script1a2b3c4d'"
        " WHEN event_id % 19 = 0 THEN '_abc123x' || CAST(user_id AS STRING)"
        " ELSE 'ds_' || CAST(user_id % 4 AS STRING) END"
    ),
    "table_id": (
        "CASE WHEN event_id % 13 = 0 THEN 'anon' || CAST(event_id AS STRING)"
        " ELSE 'tbl_' || CAST(user_id AS STRING) END"
    ),
}


def month_name(day: str) -> str:
    """The month labels of the ledger."""
    return (
        f"CASE month({day}) WHEN 1 THEN 'JAN' WHEN 2 THEN 'FEV' WHEN 3 THEN 'MAR' WHEN 4 THEN 'ABR'"
        " WHEN 5 THEN 'MAI' WHEN 6 THEN 'JUN' WHEN 7 THEN 'JUL' WHEN 8 THEN 'AGO'"
        " WHEN 9 THEN 'SET' WHEN 10 THEN 'OUT' WHEN 11 THEN 'NOV' ELSE 'DEZ' END"
    )


@dataclass(frozen=True)
class Role:
    table: str
    columns: dict
    loads: str | None = None

    def read(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = spark.read.parquet(f"{sf_dir}/{self.table}.parquet")
        if self.loads:
            last = F.expr(self.loads).cast("int")
            df = df.withColumn("load", F.explode(F.sequence(F.lit(0), last)))
        return df.selectExpr(
            *[f"{e if isinstance(e, str) else e[0]} AS {n}" for n, e in self.columns.items()]
        )

    def duckdb(self) -> str:
        columns = ", ".join(
            f"{e if isinstance(e, str) else e[1]} AS {n}" for n, e in self.columns.items()
        )
        rows = self.table
        if self.loads:
            rows = f"(SELECT *, unnest(generate_series(0, CAST({self.loads} AS BIGINT))) AS load FROM {rows})"
        return f"SELECT {columns} FROM {rows}"


def _day(column: str) -> str:
    return f"CAST({column} AS DATE)"


def _month(column: str) -> str:
    return f"CAST(date_trunc('month', {column}) AS DATE)"


def _loaded(column: str) -> str:
    return f"{column} + load * INTERVAL '1' DAY"


ROLES = {
    "receipts": Role(
        "orders",
        {
            "conta": "o_custkey",
            "descricao": "o_orderpriority",
            "dt_recebido": _day("o_orderdate"),
            "dt_mes_base": _month("o_orderdate"),
            "valor_recebido": "o_totalprice",
            "process_time": _loaded("o_orderdate"),
            "ano_fonte": "CAST(year(o_orderdate) AS INT)",
        },
        loads="o_orderkey % 2",
    ),
    "balances": Role(
        "orders",
        {
            "conta": "o_custkey",
            "descricao": "o_orderpriority",
            "dt_recebido": _day("o_orderdate"),
            "dt_mes_base": _month("o_orderdate"),
            "saldo": "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_totalprice END",
            "process_time": _loaded("o_orderdate"),
            "ano_fonte": "CAST(year(o_orderdate) AS INT)",
        },
        loads="CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END",
    ),
    "receipt_forms": Role(
        "orders",
        {
            "conta": "o_custkey",
            "descricao": "'prev ' || o_orderpriority",
            "dt_recebido": _day("o_orderdate"),
            "dt_mes_base": _month("o_orderdate"),
            "valor_recebido": "CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END",
        },
    ),
    "costs": Role(
        "lineitem",
        {
            "conta": "l_suppkey",
            "tipo_custo": COST_KIND,
            "custo": "'item ' || CAST(l_partkey AS STRING)",
            "valor_custo": "l_extendedprice",
            "dt_mes_base": _month("l_shipdate"),
            "dt_custo": _day("l_shipdate"),
            "process_time": _loaded("l_shipdate"),
            "ano_fonte": "CAST(year(l_shipdate) AS INT)",
        },
        loads="l_linenumber % 2",
    ),
    "credits": Role(
        "lineitem",
        {
            "tipo_custo_credito": COST_KIND,
            "custo_credito": "'item ' || CAST(l_partkey AS STRING)",
            "dt_credito": _day("l_shipdate"),
            "dt_mes_base": "CAST(date_trunc('month', l_shipdate) + INTERVAL '1' MONTH AS DATE)",
            "valor_credito_parc": "l_extendedprice",
            "process_time": _loaded("l_shipdate"),
            "ano_fonte": "CAST(year(l_shipdate) AS INT)",
        },
        loads="l_linenumber % 2",
    ),
    "cost_forms": Role(
        "lineitem",
        {
            "conta": "l_suppkey",
            "data_base_bq": _month("l_shipdate"),
            "custo": "'item ' || CAST(l_partkey AS STRING)",
            "tipo_custo": "l_returnflag",
            "dt_custo_bq": _day("l_shipdate"),
            "valor_custo": "l_extendedprice",
            "ano_base": "CAST(year(l_shipdate) AS INT)",
            "mes_base_ordem": "CAST(month(l_shipdate) AS INT)",
            "mes_base": month_name("l_shipdate"),
            "pendente": "CASE WHEN l_linestatus = 'O' THEN 'Sim' ELSE 'Não' END",
        },
    ),
    "job_log": Role(
        "events",
        {
            "statement_type": (
                "CASE event_type WHEN 'error' THEN 'DELETE' WHEN 'signup' THEN NULL"
                " WHEN 'purchase' THEN 'INSERT' ELSE 'SELECT' END"
            ),
            "user_email": "'user' || CAST(user_id AS STRING) || '@example.org'",
            "job_id": (
                "CASE event_id % 8 WHEN 0 THEN 'airflow_' || CAST(event_id AS STRING)"
                " WHEN 1 THEN 'scheduled_query_' || CAST(event_id AS STRING)"
                " WHEN 2 THEN 'script_job_' || CAST(event_id AS STRING)"
                " WHEN 3 THEN 'SCRIPT_JOB_' || CAST(event_id AS STRING)"
                " WHEN 4 THEN 'airflow_' WHEN 5 THEN 'bquxjob_' || CAST(event_id AS STRING)"
                " ELSE 'x_airflow_b' END"
            ),
            "job_type": "'QUERY'",
            "start_time": "ts",
            "end_time": (
                "timestampadd(MILLISECOND, CAST(floor(value * 1000) AS BIGINT), ts)",
                "ts + to_milliseconds(CAST(floor(value * 1000) AS BIGINT))",
            ),
            "query": "props",
            "state": "'DONE'",
            "total_bytes_billed": (
                "CASE event_type WHEN 'view' THEN 0 WHEN 'signup' THEN NULL"
                " ELSE CAST(floor(value * 100) AS BIGINT) * 1000000000 END"
            ),
            "total_slot_ms": "CAST(floor(value * 1000) AS BIGINT)",
            "transferred_bytes": "user_id",
            "parent_job_id": (
                "CASE event_id % 7 WHEN 0 THEN 'airflow_run_' || CAST(event_id AS STRING)"
                " WHEN 1 THEN 'scheduled_query_run' WHEN 2 THEN 'script_job_parent' END"
            ),
            "destination_table": (
                "named_struct(" + ", ".join(f"'{n}', {e}" for n, e in JOB_TARGET.items()) + ")",
                "{" + ", ".join(f"'{n}': {e}" for n, e in JOB_TARGET.items()) + "}",
            ),
        },
    ),
    "catalog": Role(
        "part",
        {
            **TABLE_OF_PART,
            "row_count": "CAST(p_size AS BIGINT) * 1000",
            "size_bytes": "CAST(round(p_retailprice * 100) AS BIGINT) * p_size * p_size * 10000 + 1",
            "creation_time": "1600000000000 + p_partkey * 60000",
            "last_modified_time": "1700000000000 + p_partkey * 3600000",
            "type": "CAST(p_partkey % 5 AS INT)",
        },
    ),
    "access_log": Role(
        "events",
        {
            **TABLE_OF_USER,
            "access_date": _day("ts"),
            "user_email": (
                "CASE event_id % 7 WHEN 0 THEN 'bio-' || CAST(event_id AS STRING) || '@svc.example'"
                " WHEN 1 THEN 'service-' || CAST(event_id AS STRING) || '@svc.example'"
                " WHEN 2 THEN 'core-' || CAST(event_id AS STRING) || '@svc.example'"
                " WHEN 3 THEN 'ana' || CAST(event_id AS STRING) || '@example.org'"
                " WHEN 4 THEN 'dash@example.org' WHEN 5 THEN 'board@example.org' END"
            ),
        },
    ),
    "table_costs": Role("part", {**TABLE_OF_PART, "yearly_cost": "p_retailprice"}),
}
