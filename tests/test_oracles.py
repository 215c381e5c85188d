"""Every driver query against its DuckDB SQL, and the shape of its plan."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry
from compare import connect, differences

SF = "/root/testdata/sf0.001"
# The training-data operators have tests of their own.
QUERIES = entry.QUERIES
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def duck():
    con = connect(SF)
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql_and_plans_well(spark, duck, name):
    df = QUERIES[name](spark, SF)
    only_spark, only_duck = differences(df, duck, ORACLES[name])
    assert not only_spark and not only_duck, (only_spark[:3], only_duck[:3])

    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("simple")
    plan = text.getvalue()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Scan ExistingRDD"):
        if bad == "Scan ExistingRDD" and name.endswith("_balance"):
            continue  # the policy table, one row per reported month
        assert bad not in plan, bad
    # One task may only see scalar aggregates.
    single = [line for line in plan.splitlines() if "SinglePartition" in line]
    aggregates = re.findall(r"collect_set\(|partial_count", plan)
    assert not single or aggregates


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["conta", "dt_mes_base"]
