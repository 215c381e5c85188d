"""Every operator over the driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill import schemas
from ledgermill.functions import classify, costs, dates
from ledgermill.functions.text import decimal_comma
from ledgermill.operators.aggregates import paid_runs, pivot_sum, run_stats
from ledgermill.operators.corrections import apply_corrections
from ledgermill.operators.joins import anti_null_aware, left_join_many
from ledgermill.operators.latest import latest_by, latest_ties
from ledgermill.operators.numbering import rank_in_group
from ledgermill.plans import (
    access,
    access_state,
    balance,
    balance_years,
    history,
    inventory,
    jobs,
    ledger,
    merges,
    monitor,
    refresh,
    rollup,
    snapshot,
)
from ledgermill.session import shared_folder, stored
from ledgermill.sources.joblog import append_jobs, changed_days, read_jobs
from ledgermill.sources.readers import read_table, read_years
from ledgermill.sources.writers import (
    load_forms,
    read_stored,
    remove_load_days,
    replace_load_days,
    replace_table,
    write_corrections,
)
from ledgermill.workloads.inputs import (
    AS_OF,
    CATEGORIES,
    FLAG_PREFIXES,
    FLAG_USERS,
    FORECAST_YEAR,
    JOB_DAYS,
    JOBS_AS_OF,
    LEDGER_AS_OF,
    POLICY,
    PROJECT,
    ROLES,
    RUN_DAYS,
    SINCE,
    SNAPSHOT_PREFIXES,
    SNAPSHOT_USERS,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


class Inputs:
    """Lazy access to the roles and driver tables of one scale folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in ROLES:
            return ROLES[name].read(self.spark, self.sf_dir)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def details(self) -> DataFrame:
        """Table details, stored once as the monitoring run stores them."""
        return stored(self.fresh_details())

    @cached_property
    def snapshot(self) -> DataFrame:
        return stored(self.fresh_snapshot())

    def fresh_details(self) -> DataFrame:
        tables = inventory.table_inventory(self.catalog, AS_OF)
        return inventory.table_details(tables, self.flags(tables), stored(self.extract()))

    def flags(self, tables: DataFrame) -> DataFrame:
        return access.last_access_flags(self.access_log, tables, PROJECT, FLAG_USERS, FLAG_PREFIXES)

    def costed(self) -> DataFrame:
        return jobs.job_costs(self.job_log, JOBS_AS_OF, JOB_DAYS)

    def extract(self) -> DataFrame:
        return jobs.job_extract(self.costed(), PROJECT)

    def history(self) -> DataFrame:
        """A history with one row per known run, half of the rows already corrected."""
        run = F.col("data_hora_execucao_job")
        rows = self.details.filter(run.isNotNull())
        return schemas.conform(
            rows.withColumns(
                {
                    "data_acesso": F.coalesce("data_acesso", F.lit("2001-01-01").cast("date")),
                    "data_ult_modificacao": run,
                    "custo_query": F.col("cost_us_dol") + 1,
                    "custo_storage": F.col("pre_cost_storage"),
                    "qtde_execucao": F.lit(1),
                    "status": F.when(F.hour(run) % 2 == 0, "novo").otherwise("atualizado"),
                    "data_carga": run,
                }
            ),
            schemas.HISTORY,
        )

    def fresh_snapshot(self) -> DataFrame:
        return history.daily_snapshot(
            self.history(), self.access_log, self.table_costs, PROJECT, SNAPSHOT_USERS, SNAPSHOT_PREFIXES
        )

    def monitor(self) -> DataFrame:
        """A monitor filled from the snapshot one load day later."""
        filled = {"custo_hist", "custo_query_execucao_job", "custo_dia", "custo_query_execucao_dia"}
        rows = self.snapshot.withColumn("data_carga", F.date_add("data_carga", 1))
        missing = [f for f in schemas.MONITOR if f.name not in rows.columns]
        rows = rows.withColumns(
            {f.name: F.lit("1,5" if f.name in filled else None) for f in missing}
        )
        return schemas.conform(rows, schemas.MONITOR)


def query(function: Callable[[Inputs], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(Inputs(spark, sf_dir))

    run.__doc__ = function.__doc__
    QUERIES[function.__name__] = run
    return function


# --- ledger ---


@query
def latest_by_key(t: Inputs) -> DataFrame:
    return latest_by(
        t.orders, ["o_custkey", "o_orderdate"], [F.desc("o_totalprice")], [F.asc("o_orderkey")]
    ).select("o_custkey", "o_orderdate", "o_totalprice", "o_orderkey", "o_orderpriority")


@query
def latest_rank_ties(t: Inputs) -> DataFrame:
    rows = t.events.select("event_type", "user_id", "event_id", "value", F.to_date("ts").alias("day"))
    return latest_ties(rows, ["event_type", "user_id"], "day")


@query
def receipt_order(t: Inputs) -> DataFrame:
    rows = t.receipts.select("ano_fonte", *schemas.RECEIPT.names)
    order = [F.desc("dt_recebido"), F.desc("valor_recebido"), F.asc("descricao"), F.desc("process_time")]
    return rank_in_group(rows, ["ano_fonte", "dt_mes_base"], order, "ordem_recebimento")


@query
def consolidated_cost(t: Inputs) -> DataFrame:
    return ledger.consolidated_cost(t.costs, t.cost_forms, FORECAST_YEAR)


@query
def credit_month(t: Inputs) -> DataFrame:
    return ledger.credit_month(t.credits)


@query
def receipts_forecast(t: Inputs) -> DataFrame:
    loaded_at = datetime(2024, 1, 31, 12, 0)
    return ledger.receipts_with_forecast(t.receipts, t.receipt_forms, LEDGER_AS_OF, loaded_at, SINCE)


@query
def opening_balance(t: Inputs) -> DataFrame:
    return balance.opening_balances(t.balances)


@query
def monthly_flows(t: Inputs) -> DataFrame:
    flows = balance.monthly_flows(
        t.receipts, t.receipt_forms, t.costs, t.cost_forms, t.balances, LEDGER_AS_OF, FORECAST_YEAR
    )
    return flows.select("dt_mes_base", *[F.col(c).cast("double").alias(c) for c in balance.FLOWS])


@query
def monthly_balance(t: Inputs) -> DataFrame:
    return balance.monthly_balance(
        t.receipts, t.receipt_forms, t.costs, t.cost_forms, t.balances, LEDGER_AS_OF,
        FORECAST_YEAR, policy=POLICY,
    )


@query
def account_balance(t: Inputs) -> DataFrame:
    return balance.monthly_balance(
        t.receipts, t.receipt_forms, t.costs, t.cost_forms, t.balances, LEDGER_AS_OF,
        FORECAST_YEAR, by=["conta"], policy=POLICY,
    )


@query
def month_cost_pivot(t: Inputs) -> DataFrame:
    tags = {"A": "custo_a", "N": "custo_n", "R": "custo_r"}
    rows = t.lineitem.withColumn("dt_mes_base", F.trunc("l_shipdate", "MM"))
    return pivot_sum(rows, ["dt_mes_base"], "l_returnflag", "l_extendedprice", tags)


@query
def cost_of_living(t: Inputs) -> DataFrame:
    return ledger.cost_of_living(t.costs, t.credits, "1996-01-01", CATEGORIES)


@query
def calendar_fields(t: Inputs) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("dia"))
    return dates.add_calendar(rows, "dia", week=True)


def part_rules():
    return [
        ((F.col("p_type") == "ECONOMY") & (F.col("p_size") > 40), "grande"),
        (F.col("p_name").rlike(r"^[a-z]+ (ring|bolt)$"), "metal"),
    ]


@query
def corrected_costs(t: Inputs) -> DataFrame:
    return apply_corrections(t.part.select("p_partkey", "p_name", "p_type", "p_size"), "p_type", part_rules())


@query
def decimal_comma_text(t: Inputs) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        decimal_comma(F.col("l_extendedprice")).alias("price"),
        decimal_comma(F.col("l_quantity")).alias("quantity"),
        decimal_comma(F.nullif("l_discount", F.lit(0.0))).alias("discount"),
    )


# --- jobs, tables and users ---


@query
def job_costs(t: Inputs) -> DataFrame:
    return t.costed()


@query
def job_extract(t: Inputs) -> DataFrame:
    return t.extract()


@query
def job_classes(t: Inputs) -> DataFrame:
    target = {n: F.col(f"destination_table.{n}") for n in ("dataset_id", "table_id")}
    matched = classify.add_matches(
        t.job_log, F.col("job_id"), F.col("parent_job_id"), target["dataset_id"], target["table_id"]
    )
    return matched.select(
        "start_time", "job_id", "parent_job_id", target["dataset_id"].alias("dataset_id"),
        classify.executor_class().alias("executor_job"),
        classify.executor_class(keep_other=False).alias("executor_strict"),
        classify.dataset_class(target["dataset_id"]).alias("dataset_id_job"),
        F.col("executor_anon_job").alias("anon"),
    )


@query
def local_day(t: Inputs) -> DataFrame:
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        dates.local_datetime(ts, ntz=True).alias("local_ts"),
        dates.local_date(ts, ntz=True).alias("local_day"),
    )


@query
def duration_seconds(t: Inputs) -> DataFrame:
    start, end = F.col("start_time"), F.col("end_time")
    return t.job_log.select(
        "start_time", "transferred_bytes", dates.whole_seconds(start, end).alias("seconds")
    )


@query
def job_prices(t: Inputs) -> DataFrame:
    billed = F.col("total_bytes_billed")
    return t.job_log.select(
        "start_time", "transferred_bytes",
        costs.billed_tb(billed).alias("tb_billed"), costs.query_cost(billed).alias("cost_us_dol"),
    )


@query
def table_inventory(t: Inputs) -> DataFrame:
    rows = inventory.table_inventory(t.catalog, AS_OF)
    return rows.withColumns(
        {c: dates.utc_clock(F.col(c)) for c in ("creation_time", "last_modified_time")}
    )


@query
def dataset_names(t: Inputs) -> DataFrame:
    return inventory.dataset_names(t.catalog.withColumnRenamed("dataset_id", "schema_name"))


@query
def user_classes(t: Inputs) -> DataFrame:
    email = F.col("user_email")
    rows = t.access_log.withColumns(
        {
            "prefix": classify.user_prefix(email, FLAG_PREFIXES),
            "short": classify.user_prefix(email, SNAPSHOT_PREFIXES),
        }
    )
    return rows.select(
        "table_id", "access_date", "user_email", "prefix",
        classify.user_class(F.col("prefix"), email, FLAG_USERS).alias("flag_class"),
        classify.user_class(F.col("short"), email, SNAPSHOT_USERS).alias("snapshot_class"),
    )


@query
def last_access_flags(t: Inputs) -> DataFrame:
    return t.flags(t.catalog)


@query
def last_users(t: Inputs) -> DataFrame:
    return access.last_users(t.access_log, PROJECT, SNAPSHOT_USERS, SNAPSHOT_PREFIXES)


@query
def table_details(t: Inputs) -> DataFrame:
    return t.fresh_details()


@query
def supplier_lines(t: Inputs) -> DataFrame:
    """Left join whose right side is many rows per left row."""
    parts = t.part.select(F.col("p_partkey").alias("partkey"), "p_brand")
    lines = t.lineitem.select(
        F.col("l_partkey").alias("partkey"), "l_suppkey", "l_quantity", F.to_date("l_shipdate").alias("day")
    )
    return left_join_many(parts, lines, ["partkey"])


@query
def idle_customers(t: Inputs) -> DataFrame:
    """Customers that are not among those with an urgent order."""
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT")
    customers = t.customer.select(F.col("c_custkey").alias("key"), "c_name", "c_mktsegment")
    return anti_null_aware(customers, urgent.select(F.col("o_custkey").alias("key")), "key")


# --- history, snapshot and monitor ---


@query
def paid_run_instants(t: Inputs) -> DataFrame:
    runs = t.events.select("user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("run"), "value", "event_type")
    return paid_runs(runs, ["user_id"], "run", "value", payload=["event_type"])


@query
def run_statistics(t: Inputs) -> DataFrame:
    return run_stats(t.events, ["user_id", "event_type"], "ts", "value")


@query
def history_executed(t: Inputs) -> DataFrame:
    return history.executed_tables(t.details, AS_OF, PROJECT)


@query
def history_idle(t: Inputs) -> DataFrame:
    return history.idle_tables(t.details, AS_OF, PROJECT)


@query
def merge_history(t: Inputs) -> DataFrame:
    return history.merge_history(t.details, t.history(), AS_OF, PROJECT)


@query
def restate_window(t: Inputs) -> DataFrame:
    moments = monitor.restated_moments(AS_OF)
    return history.merge_history(t.details, t.history(), moments, PROJECT)


@query
def daily_snapshot(t: Inputs) -> DataFrame:
    return t.fresh_snapshot()


@query
def daily_runs(t: Inputs) -> DataFrame:
    rows = monitor.daily_runs(t.job_log, AS_OF)
    return rows.select(
        *monitor.TABLE, "day", "runs", F.col("cost").cast("double").alias("cost"), "first_run",
        "last_run", monitor.executor_name(F.col("executor")).alias("executor_job"),
    )


@query
def active_monitor(t: Inputs) -> DataFrame:
    return monitor.monitor_source(t.job_log, t.snapshot, [AS_OF])


@query
def merge_active(t: Inputs) -> DataFrame:
    return monitor.merge_active_tables(t.job_log, t.snapshot, t.monitor(), AS_OF)


@query
def restate_monitor(t: Inputs) -> DataFrame:
    return monitor.merge_active_tables(
        t.job_log, t.snapshot, t.monitor(), monitor.restated_moments(AS_OF)
    )


@query
def merge_history_twice(t: Inputs) -> DataFrame:
    """A day, then the restated window, then the day again, each into the result before."""
    first = stored(history.merge_history(t.details, t.history(), AS_OF, PROJECT))
    second = stored(history.merge_history(t.details, first, monitor.restated_moments(AS_OF), PROJECT))
    return history.merge_history(t.details, second, AS_OF, PROJECT)


@query
def merge_active_twice(t: Inputs) -> DataFrame:
    """A day, then the restated window, into the result."""
    first = stored(monitor.merge_active_tables(t.job_log, t.snapshot, t.monitor(), AS_OF))
    return monitor.merge_active_tables(t.job_log, t.snapshot, first, monitor.restated_moments(AS_OF))


# --- runs, readers and writers ---


def work_folder(t: Inputs) -> str:
    """A new folder beside the other intermediate data."""
    return f"{shared_folder(t.spark)}/{t.spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


@query
def read_source_years(t: Inputs) -> DataFrame:
    """Receipts written as a table per source year and read back with the declared schema."""
    root, receipts = work_folder(t), stored(t.receipts)
    rows = schemas.conform(receipts, schemas.RECEIPT).withColumn("_year", F.year("dt_recebido"))
    years = [r[0] for r in receipts.select("ano_fonte").distinct().collect()]  # one row per source year
    for year in years:
        replace_table(rows.filter(F.col("_year") == year).drop("_year"), f"{root}/{year}")
    read = read_years(t.spark, {year: f"{root}/{year}" for year in years}, schemas.RECEIPT)
    return read.withColumn("process_time", F.col("process_time").cast("timestamp_ntz"))


@query
def run_balance(t: Inputs) -> DataFrame:
    """The balance that the ledger run writes, after a second run over the first."""
    root = work_folder(t)
    inputs = refresh.LedgerInputs(t.costs, t.credits, t.receipts, t.balances, t.cost_forms, t.receipt_forms)
    for _ in range(2):
        refresh.refresh_finance(
            inputs, root, LEDGER_AS_OF, datetime(2024, 1, 31, 12, 0), forecast_year=FORECAST_YEAR, policy=POLICY
        )
    return read_table(t.spark, f"{root}/{refresh.BALANCE}", schemas.BALANCE)


@query
def run_details(t: Inputs) -> DataFrame:
    """Table details appended to a partitioned table, twice by one run, and read back."""
    root = work_folder(t)
    for _ in range(2):
        refresh.append_details(t.details, root, "1")
    return read_stored(t.spark, f"{root}/{refresh.DETAILS}", schemas.DETAILS).select(*schemas.DETAILS.names)


@query
def run_history(t: Inputs) -> DataFrame:
    """The history that the first monitoring run writes; its job log starts where ``costed`` starts."""
    root = work_folder(t)
    inputs = refresh.WarehouseInputs(t.job_log, t.catalog, t.access_log, t.table_costs)
    refresh.monitoring_run(
        t.spark, inputs, root, datetime.fromisoformat(AS_OF), PROJECT, FLAG_PREFIXES, SNAPSHOT_PREFIXES,
        FLAG_USERS, SNAPSHOT_USERS, days=RUN_DAYS,
    )
    return read_stored(t.spark, f"{root}/{refresh.HISTORY}", schemas.HISTORY).select(*schemas.HISTORY.names)


@query
def job_costs_by_day(t: Inputs) -> DataFrame:
    """Job costs from a log that is stored by local day; only the wanted days' folders are read."""
    log = f"{work_folder(t)}/jobs"
    append_jobs(t.job_log, log, datetime.fromisoformat(AS_OF))
    return jobs.job_costs(read_jobs(t.spark, log), JOBS_AS_OF, JOB_DAYS)


def stored_runs(t: Inputs, root: str) -> DataFrame:
    """The roll-up of a log that came in two loads: half of the jobs, then the late ones, whose days alone are
    computed again; then a day is lost and restated."""
    log, path = f"{root}/jobs", f"{root}/{refresh.DAILY}"
    late = F.pmod(F.xxhash64("job_id", "start_time", "transferred_bytes"), F.lit(2)) == 1
    first, second = datetime.fromisoformat(AS_OF), datetime.fromisoformat(AS_OF) + timedelta(hours=1)
    append_jobs(t.job_log.filter(~late), log, first)
    rollup.refresh_runs(t.spark, read_jobs(t.spark, log), path, [AS_OF])
    append_jobs(t.job_log.filter(late), log, second)
    rollup.refresh_runs(t.spark, read_jobs(t.spark, log), path, changed_days(t.spark, log, first))
    lost = dates.day_of(AS_OF)
    remove_load_days(t.spark, path, [lost], rollup.DAY)
    rollup.refresh_runs(t.spark, read_jobs(t.spark, log), path, [lost])
    return rollup.read_runs(t.spark, path)


@query
def daily_runs_stored(t: Inputs) -> DataFrame:
    runs = stored_runs(t, work_folder(t)).filter(F.col("day") <= dates.date_lit(AS_OF))
    return runs.select(
        *monitor.TABLE, "day", "runs", F.col("cost").cast("double").alias("cost"), "first_run",
        "last_run", monitor.executor_name(F.col("executor")).alias("executor_job"),
    )


@query
def restate_monitor_stored(t: Inputs) -> DataFrame:
    """The restated monitor from the stored roll-up."""
    days = [dates.day_of(m) for m in monitor.restated_moments(AS_OF)]
    source = monitor.monitor_rows(stored_runs(t, work_folder(t)), t.snapshot, days)
    return monitor.merge_monitor(source, t.monitor(), days)


@query
def snapshot_refreshed(t: Inputs) -> DataFrame:
    """A stored snapshot with part of the history, older users and other costs, then brought up to date."""
    root, past = work_folder(t), stored(t.history())
    kept = f"{root}/{refresh.HISTORY}"
    day = F.to_date("data_carga")
    late = day >= dates.date_lit(AS_OF)
    used = [PROJECT, SNAPSHOT_USERS, SNAPSHOT_PREFIXES]
    older = t.access_log.filter(F.pmod(F.xxhash64("table_id"), F.lit(3)) > 0)
    dearer = t.table_costs.withColumn("yearly_cost", F.col("yearly_cost") + F.when(F.col("table_id").like("%7"), 1).otherwise(0))
    for rows, log, table_costs in ((past.filter(~late), older, dearer), (past, t.access_log, t.table_costs)):
        replace_load_days(rows, kept, "data_carga")
        facts = snapshot.table_facts(log, table_costs, *used)
        # One value for each late day.
        days = [r[0] for r in past.filter(late).select(day).distinct().collect()]
        paths = f"{root}/{refresh.SNAPSHOT}", f"{root}/{refresh.FACTS}"
        snapshot.refresh_snapshot(t.spark, read_stored(t.spark, kept, schemas.HISTORY), facts, *paths, days, PROJECT)
    return read_stored(t.spark, f"{root}/{refresh.SNAPSHOT}", schemas.SNAPSHOT).select(*schemas.SNAPSHOT.names)


def forms_as_files(t: Inputs, name: str, schema, root: str) -> DataFrame:
    """A form table written as CSV, with lines that do not parse among the others, and loaded from there."""
    path, rows = f"{root}/{name}", stored(schemas.conform(getattr(t, name), schema))
    rows.write.option("header", True).csv(path)
    broken = t.orders.filter("o_orderkey % 50 = 0").select(
        *[F.concat(F.lit("??"), F.col("o_orderkey").cast("string")).alias(c) for c in schema.names]
    )
    broken.write.mode("append").option("header", True).csv(path)
    return load_forms(t.spark, path, schema, f"{root}/{name}_rejeitadas")


@query
def consolidated_cost_files(t: Inputs) -> DataFrame:
    return ledger.consolidated_cost(t.costs, forms_as_files(t, "cost_forms", schemas.COST_FORM, work_folder(t)), FORECAST_YEAR)


@query
def receipts_forecast_files(t: Inputs) -> DataFrame:
    forms = forms_as_files(t, "receipt_forms", schemas.RECEIPT_FORM, work_folder(t))
    return ledger.receipts_with_forecast(t.receipts, forms, LEDGER_AS_OF, datetime(2024, 1, 31, 12, 0), SINCE)


@query
def rejected_lines(t: Inputs) -> DataFrame:
    """The lines of the receipt forms that were kept aside."""
    root = work_folder(t)
    forms_as_files(t, "receipt_forms", schemas.RECEIPT_FORM, root)
    return t.spark.read.parquet(f"{root}/receipt_forms_rejeitadas").select("linha")


@query
def last_access_newest_first(t: Inputs) -> DataFrame:
    """The place of each row in the ordered result, equal days counting as one place."""
    tables = t.catalog
    ordered = access.last_access_flags(t.access_log, tables, PROJECT, FLAG_USERS, FLAG_PREFIXES, newest_first=True)
    kept = stored(ordered.select("dataset_id", "table_id", "access_date", F.monotonically_increasing_id().alias("at")))
    days = kept.groupBy("access_date").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    # One entry for each day, in the order of the rows; a day is unbroken if it ends before the next begins.
    order = days.agg(F.array_sort(F.collect_set(F.struct("first", "last", "access_date"))).alias("days"))
    placed = F.expr(
        "transform(days, (x, i) -> struct(x.access_date, i + 1L as place,"
        " i = size(days) - 1 or x.last < days[least(i + 1, size(days) - 1)].first as unbroken))"
    )
    return kept.drop("at").join(order.select(F.inline(placed)), "access_date")


def bucket_count(t: Inputs) -> int:
    return int(t.spark.conf.get("spark.sql.shuffle.partitions"))


@query
def merge_history_bucketed(t: Inputs) -> DataFrame:
    """The merges of ``merge_history_twice`` into a table that lies in buckets of the merge key."""
    path, name, n = work_folder(t), f"history_{uuid.uuid4().hex}", bucket_count(t)
    merges.store_history(t.history(), name, path, n)
    for moments in (AS_OF, monitor.restated_moments(AS_OF), AS_OF):
        merges.merge_stored_history(t.spark, t.details, name, path, moments, PROJECT, n)
    return t.spark.table(name).select(*schemas.HISTORY.names)


@query
def merge_active_bucketed(t: Inputs) -> DataFrame:
    """The merges of ``merge_active_twice`` into a table that lies in buckets of the merge key."""
    path, name, n = work_folder(t), f"monitor_{uuid.uuid4().hex}", bucket_count(t)
    merges.store_monitor(t.monitor(), name, path, n)
    for days in ([AS_OF], monitor.restated_moments(AS_OF)):
        source = monitor.monitor_source(t.job_log, t.snapshot, days)
        merges.merge_stored_monitor(t.spark, source, name, path, days, n)
    return t.spark.table(name)


@query
def access_flags_stored(t: Inputs) -> DataFrame:
    """Flags from stored access days: the log before its last day, then that day, then that day again."""
    path = f"{work_folder(t)}/access"
    last = t.access_log.agg(F.max("access_date")).first()[0]
    late = F.coalesce(F.col("access_date") >= F.lit(last), F.lit(False))
    for rows in (t.access_log.filter(~late), t.access_log.filter(late), t.access_log.filter(late)):
        access_state.add_access(t.spark, rows, path, FLAG_USERS, FLAG_PREFIXES)
    state = read_stored(t.spark, path, schemas.ACCESS_DAYS)
    return access_state.flags_of(state, t.catalog, PROJECT)


@query
def account_balance_by_year(t: Inputs) -> DataFrame:
    """The balance from a table by year: without the receipts and costs that came late, then the reopened years alone."""
    path, since = f"{work_folder(t)}/saldo", datetime(1997, 6, 30)
    late = F.coalesce(F.col("process_time") > dates.datetime_lit(since), F.lit(False))
    options = {"forecast_year": FORECAST_YEAR, "by": ["conta"], "policy": POLICY}
    early = [df.filter(~late) for df in (t.receipts, t.costs, t.balances)]
    balance_years.refresh_balance(
        t.spark, path, early[0], t.receipt_forms, early[1], t.cost_forms, early[2], LEDGER_AS_OF, **options
    )
    years = balance_years.reopened_years(
        t.receipts, t.costs, t.balances, t.receipt_forms, since, LEDGER_AS_OF, LEDGER_AS_OF
    )
    balance_years.refresh_balance(
        t.spark, path, t.receipts, t.receipt_forms, t.costs, t.cost_forms, t.balances, LEDGER_AS_OF,
        [FORECAST_YEAR, *years], **options,
    )
    return t.spark.read.parquet(path).drop(balance_years.YEAR_OF)


@query
def corrections_written(t: Inputs) -> DataFrame:
    """Corrections written back to a table that is stored by size. Once, as the first rule tests what it corrects: after
    it, the second rule would hold for such a row."""
    path = f"{work_folder(t)}/part"
    t.part.select("p_partkey", "p_name", "p_type", "p_size").write.partitionBy("p_size").parquet(path)
    write_corrections(t.spark, path, "p_size", "p_type", part_rules())
    return t.spark.read.parquet(path)
