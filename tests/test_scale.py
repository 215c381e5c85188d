"""Plans under skew: one key with a third of the rows must not meet in one task."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from helpers import counted
from ledgermill import schemas
from ledgermill.operators.joins import left_join_many
from ledgermill.operators.latest import latest_by, latest_ties
from ledgermill.plans import access, balance, jobs, ledger
from ledgermill.workloads.inputs import ROLES

SF = "/root/testdata/sf0.001"


def plan_of(df, mode: str = "simple") -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


@pytest.fixture
def small_skew(conf):
    """Lets a test-sized table count as skewed."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="32KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="16",
    )


def hot(spark, n=120_000):
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997)
    rows = spark.range(0, n, 1, 16)
    return rows.select(key.alias("k"), F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))


def test_hot_key_is_split_in_the_many_join(spark, small_skew):
    left = spark.range(1200).select(F.col("id").alias("k"), F.lit("x").alias("l"))
    right = hot(spark)
    got = left_join_many(left, right, ["k"])
    assert got.count() == left.join(right, ["k"], "left").count()
    sums = got.agg(F.sum("v"), F.count("v"), F.countDistinct("k"))
    sums.collect()
    joined = got.select(F.hash("k", "v", "pad", "l").alias("h"))
    joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_split_for_ties(spark, small_skew):
    df = hot(spark).withColumn("day", F.when(F.col("k") == 0, 9).otherwise(F.col("v") % 9))
    got = latest_ties(df, ["k"], "day")
    got.collect()
    assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    assert got.filter("k = 0").count() == df.filter("k = 0").count()


def test_top_row_choice_is_limited_before_the_shuffle(spark):
    plan = plan_of(latest_by(hot(spark), ["k"], [F.desc("v")]))
    limit, exchange = plan.rindex("WindowGroupLimit"), plan.index("Exchange hashpartitioning")
    assert exchange < limit and "Partial" in plan[limit:]


def test_access_flags_are_one_hash_aggregate(spark):
    log = spark.createDataFrame([], schemas.ACCESS_LOG)
    tables = spark.createDataFrame([], "table_id string")
    plan = plan_of(access.last_access_flags(log, tables, "p", [], ["service"]))
    assert "SortAggregate" not in plan and "Window" not in plan and "collect_list" not in plan


def test_date_bounds_reach_the_scan(spark):
    log = ROLES["job_log"].read(spark, SF)
    plan = plan_of(jobs.job_costs(log, "2024-01-31", 10))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    assert "GreaterThanOrEqual(ts,2024-01-21T03:00)" in pushed


def test_scans_read_only_the_needed_columns(spark):
    plan = plan_of(ledger.credit_month(ROLES["credits"].read(spark, SF)), "formatted")
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {
        "l_partkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_shipdate",
    }


def test_month_totals_need_no_join(spark):
    roles = {n: ROLES[n].read(spark, SF) for n in ("receipts", "receipt_forms", "costs", "cost_forms", "balances")}
    plan = plan_of(
        balance.monthly_flows(
            roles["receipts"], roles["receipt_forms"], roles["costs"], roles["cost_forms"],
            roles["balances"], "1998-06-01", 1998,
        )
    )
    assert "Join" not in plan and "Window" not in plan


@pytest.mark.parametrize("parts", [1, 13])
def test_partitioning_does_not_change_the_balance(spark, conf, parts):
    conf(spark__sql__shuffle__partitions=str(parts))

    def read(name):
        return ROLES[name].read(spark, SF).repartition(parts, F.rand(parts))

    def result(read_one):
        return balance.monthly_flows(
            read_one("receipts"), read_one("receipt_forms"), read_one("costs"), read_one("cost_forms"),
            read_one("balances"), "1998-06-01", 1998,
        )

    assert counted(result(read)) == counted(result(lambda n: ROLES[n].read(spark, SF)))
