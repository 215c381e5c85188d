"""Column names and types of every input and stored output, as Spark schemas.

Names and order are fixed values: they are the interface of the tables.
"""

from __future__ import annotations

from pyspark.sql import types as T


STRING, DOUBLE, INT, LONG = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()
BOOLEAN, DATE = T.BooleanType(), T.DateType()
INSTANT, CLOCK = T.TimestampType(), T.TimestampNTZType()


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


TARGET = _table(project_id=STRING, dataset_id=STRING, table_id=STRING)

# Ledger inputs. One table per source year; ``ano_fonte`` carries the year.
COST = _table(
    tipo_custo=STRING,
    custo=STRING,
    valor_custo=DOUBLE,
    dt_mes_base=DATE,
    dt_custo=DATE,
    process_time=INSTANT,
)
CREDIT = _table(
    tipo_custo_credito=STRING,
    custo_credito=STRING,
    dt_credito=DATE,
    dt_mes_base=DATE,
    valor_credito_parc=DOUBLE,
    process_time=INSTANT,
)
RECEIPT = _table(
    descricao=STRING,
    dt_recebido=DATE,
    dt_mes_base=DATE,
    valor_recebido=DOUBLE,
    process_time=INSTANT,
)
BANK_BALANCE = _table(
    descricao=STRING,
    dt_recebido=DATE,
    dt_mes_base=DATE,
    saldo=DOUBLE,
    process_time=INSTANT,
)
RECEIPT_FORM = _table(
    descricao=STRING,
    dt_recebido=DATE,
    dt_mes_base=DATE,
    valor_recebido=DOUBLE,
)
COST_FORM = _table(
    data_base_bq=DATE,
    custo=STRING,
    tipo_custo=STRING,
    dt_custo_bq=DATE,
    valor_custo=DOUBLE,
    ano_base=INT,
    mes_base_ordem=INT,
    mes_base=STRING,
    pendente=STRING,
)

# Monitoring inputs.
JOB_LOG = _table(
    statement_type=STRING,
    user_email=STRING,
    job_id=STRING,
    job_type=STRING,
    start_time=INSTANT,
    end_time=INSTANT,
    query=STRING,
    state=STRING,
    total_bytes_billed=LONG,
    total_slot_ms=LONG,
    transferred_bytes=LONG,
    parent_job_id=STRING,
    destination_table=TARGET,
)
CATALOG = _table(
    project_id=STRING,
    dataset_id=STRING,
    table_id=STRING,
    row_count=LONG,
    size_bytes=LONG,
    creation_time=LONG,
    last_modified_time=LONG,
    type=INT,
)
SCHEMATA = _table(
    schema_name=STRING,
)
ACCESS_LOG = _table(
    table_id=STRING,
    dataset_id=STRING,
    access_date=DATE,
    user_email=STRING,
)
TABLE_COSTS = _table(
    project_id=STRING,
    dataset_id=STRING,
    table_id=STRING,
    yearly_cost=DOUBLE,
)

# Stored outputs of the monitoring run.
DETAILS = _table(
    project_id=STRING,
    dataset_id=STRING,
    table_id=STRING,
    row_count=DOUBLE,
    pre_cost_storage=DOUBLE,
    size_tb=DOUBLE,
    pre_cost_us_dol=DOUBLE,
    data_ult_modificacao=DATE,
    hora_ult_modificacao=STRING,
    data_acesso=DATE,
    flag_user_sa_bio=BOOLEAN,
    flag_user_nominal=BOOLEAN,
    flag_sem_acesso=BOOLEAN,
    data_hora_execucao_job=CLOCK,
    executor_job=STRING,
    cost_us_dol=DOUBLE,
)
HISTORY = _table(
    project_id=STRING,
    dataset_id=STRING,
    table_id=STRING,
    data_acesso=DATE,
    flag_user_sa_bio=BOOLEAN,
    flag_user_nominal=BOOLEAN,
    flag_sem_acesso=BOOLEAN,
    data_ult_modificacao=CLOCK,
    executor_job=STRING,
    data_hora_execucao_job=CLOCK,
    size_tb=DOUBLE,
    custo_query=DOUBLE,
    custo_storage=DOUBLE,
    qtde_execucao=LONG,
    status=STRING,
    data_carga=CLOCK,
)
DAILY_RUNS = _table(
    project_id=STRING,
    dataset_id=STRING,
    table_id=STRING,
    runs=LONG,
    cost=T.DecimalType(38, 6),
    first_run=CLOCK,
    last_run=CLOCK,
    executor=INT,
    day=DATE,
)
# Last user and yearly cost of each table, as the snapshot shows them.
#: Days of access as words of bits (``plans.access_state``).
ACCESS_DAYS = _table(dataset_id=STRING, table_id=STRING, kind=STRING, bucket=LONG, days=LONG)

TABLE_FACTS = _table(
    project_id=STRING,
    dataset_id=STRING,
    table_id=STRING,
    access_date=DATE,
    user_email=STRING,
    tipo_user=STRING,
    yearly_cost=DOUBLE,
)
SNAPSHOT = _table(
    access_date=DATE,
    user_email=STRING,
    tipo_user=STRING,
    project_id=STRING,
    dataset_id=STRING,
    table_id=STRING,
    data_ult_modificacao=CLOCK,
    size_tb=STRING,
    custo_query=STRING,
    custo_storage=STRING,
    custo_ano_bee=STRING,
    data_carga=DATE,
)
MONITOR = _table(
    project_id=STRING,
    dataset_id=STRING,
    table_id=STRING,
    data_ult_modificacao=CLOCK,
    access_date=DATE,
    size_tb=STRING,
    custo_ano_bee=STRING,
    qtde_execucao=LONG,
    custo_hist=STRING,
    pri_data_hora_execucao_job=CLOCK,
    ulti_data_hora_execucao_job=CLOCK,
    custo_query_execucao_job=STRING,
    executor_job_dia=STRING,
    qtde_execucao_dia=LONG,
    custo_dia=STRING,
    pri_data_hora_execucao_job_dia=CLOCK,
    ulti_data_hora_execucao_job_dia=CLOCK,
    custo_query_execucao_dia=STRING,
    data_carga=DATE,
)


BALANCE = _table(
    dt_mes_base=DATE,
    valor_recebido=DOUBLE,
    valor_recebido_prev=DOUBLE,
    valor_custo_prev=DOUBLE,
    valor_custo_real=DOUBLE,
    saldo_prev=DOUBLE,
    saldo_real=DOUBLE,
)


def conform(df, schema: T.StructType):
    """Select ``schema``'s columns in order, cast to its types; missing ones raise."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema])
