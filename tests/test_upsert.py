"""The upsert against DuckDB's MERGE INTO."""

import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from helpers import counted
from ledgermill.operators.upsert import upsert

DDL = "k1 string, k2 int, v int, kept int, status string"


def random_table(rng, n, unique):
    out, seen = [], set()
    for _ in range(n):
        key = (rng.choice(["a", "b", "c", None]), rng.choice([*range(8), None]))
        if unique and key in seen and None not in key:
            continue
        seen.add(key)
        out.append((*key, rng.randrange(100), rng.randrange(100), rng.choice(["novo", "atualizado"])))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_equals_merge_into(spark, seed):
    rng = random.Random(seed)
    target, source = random_table(rng, 60, False), random_table(rng, 25, True)
    con = duckdb.connect()
    for name, data in (("t", target), ("s", source)):
        con.execute(f"create table {name} (k1 varchar, k2 int, v int, kept int, status varchar)")
        con.executemany(f"insert into {name} values (?, ?, ?, ?, ?)", data)
    con.execute(
        """merge into t using s on t.k1 = s.k1 and t.k2 = s.k2
           when matched and t.status = 'novo' then update set v = s.v, status = 'atualizado'
           when not matched then insert values (s.k1, s.k2, s.v, s.kept, s.status)"""
    )
    want = Counter(con.execute("select * from t").fetchall())
    got = upsert(
        spark.createDataFrame(target, DDL),
        spark.createDataFrame(source, DDL),
        ["k1", "k2"],
        update_when=F.col("status") == "novo",
        set_cols=["k1", "k2", "v"],
        overrides={"status": F.lit("atualizado")},
    )
    assert counted(got) == want


def test_two_source_rows_for_one_update_raise(spark):
    target = spark.createDataFrame([("a", 1, 1, 1, "novo")], DDL)
    source = spark.createDataFrame([("a", 1, 2, 2, "novo"), ("a", 1, 3, 3, "novo")], DDL)
    with pytest.raises(Exception, match="several source rows"):
        upsert(target, source, ["k1", "k2"]).collect()
    blocked = upsert(target, source, ["k1", "k2"], update_when=F.col("status") == "x")
    assert counted(blocked) == Counter([("a", 1, 1, 1, "novo")])


def test_unmatched_source_copies_are_all_inserted(spark):
    target = spark.createDataFrame([], DDL)
    source = spark.createDataFrame([("a", 1, 2, 2, "novo")] * 2, DDL)
    assert counted(upsert(target, source, ["k1", "k2"])) == Counter({("a", 1, 2, 2, "novo"): 2})


def test_keys_may_be_expressions(spark):
    target = spark.createDataFrame([("a", 11, 1, 1, "x")], DDL)
    source = spark.createDataFrame([("a", 19, 2, 2, "y"), ("a", 21, 3, 3, "z")], DDL)
    got = upsert(target, source, ["k1", "k2 div 10"])
    assert counted(got) == Counter([("a", 19, 2, 2, "y"), ("a", 21, 3, 3, "z")])


def test_second_merge_changes_only_the_status(spark):
    def merge(table):
        return upsert(
            table, source, ["k1", "k2"], update_when=F.col("status") == "novo",
            overrides={"status": F.lit("atualizado")},
        )

    source = spark.createDataFrame([("a", i, i, i, "novo") for i in range(5)], DDL)
    first = merge(spark.createDataFrame([], DDL))
    second = merge(first)
    assert counted(first) == counted(source)
    assert counted(second) == Counter(("a", i, i, i, "atualizado") for i in range(5))
    assert counted(merge(second)) == counted(second)
