import random
from collections import Counter, defaultdict
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import counted, rows
from ledgermill.operators import numbering
from ledgermill.operators.aggregates import mean_cost, money_sum, paid_runs, pivot_sum, run_stats
from ledgermill.operators.corrections import apply_corrections
from ledgermill.operators.joins import anti_null_aware, left_join_many
from ledgermill.operators.latest import latest_by, latest_ties
from ledgermill.operators.numbering import expand_copies, rank_in_group, running_total


def test_latest_by_takes_ties_in_order_and_nulls_last(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "z"), ("a", 2, "y"), ("b", None, "n"), ("b", 1, "m"), (None, 5, "q")],
        "k string, t int, v string",
    )
    got = latest_by(df, ["k"], [F.desc("t")], [F.asc("v")])
    assert counted(got) == Counter([("a", 2, "y"), ("b", 1, "m"), (None, 5, "q")])


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_latest_ties_keeps_every_row_of_the_last_value(spark, conf, broadcast):
    conf(
        spark__sql__autoBroadcastJoinThreshold=broadcast,
        spark__sql__adaptive__autoBroadcastJoinThreshold=broadcast,
    )
    df = spark.createDataFrame(
        [("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", None, 4), ("b", None, 5), (None, 1, 6), (None, 0, 7)],
        "k string, t int, v int",
    )
    got = {r[2] for r in rows(latest_ties(df, ["k"], "t"))}
    assert got == {2, 3, 4, 5, 6}


def skewed(seed: int, n: int) -> list[tuple]:
    """A third of the rows under one key and day, a third of those full copies."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        if i % 3 == 0:
            row = ("hot", 7, 5.0, "same") if i % 9 == 0 else ("hot", 7, rng.random(), f"r{i}")
        else:
            row = (rng.choice("abcd") if i % 50 else None, rng.randrange(20), rng.random(), f"r{i}")
        out.append(row)
    return out


def brute_rank(data):
    groups = defaultdict(list)
    for row in data:
        groups[row[0]].append(row)
    out = Counter()
    for members in groups.values():
        members.sort(key=lambda r: (-r[1], -r[2], r[3]))
        out.update((*r, i) for i, r in enumerate(members, 1))
    return out


def order():
    return [F.desc("day"), F.desc("v"), F.asc("name")]


@pytest.mark.parametrize("broadcast, chunk", [("10MB", 100_000), ("-1", 100)])
def test_rank_in_group_equals_row_number(spark, conf, broadcast, chunk):
    conf(
        spark__sql__autoBroadcastJoinThreshold=broadcast,
        spark__sql__adaptive__autoBroadcastJoinThreshold=broadcast,
    )
    data = skewed(1, 6000)
    df = spark.createDataFrame(data, "k string, day int, v double, name string")
    assert counted(rank_in_group(df, ["k"], order(), "place", chunk)) == brute_rank(data)


def test_running_total_slices_stay_small_under_one_hot_key(spark, monkeypatch):
    seen = []
    original = numbering.stored
    monkeypatch.setattr(numbering, "stored", lambda df: seen.append(original(df)) or seen[-1])
    df = spark.createDataFrame(
        [("hot" if i % 3 else "cold", i) for i in range(60_000)], "k string, i int"
    ).withColumn("n", F.lit(2).cast("long"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = running_total(df, ["k"], [F.asc("i")], "n", "before")
        ok = got.withColumn("place", F.expr("if(k='hot', i - floor(i/3) - 1, floor(i/3))"))
        assert ok.filter("before != 2 * place").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    biggest = seen[0].groupBy("k", "_slice").count().agg(F.max("count")).first()[0]
    assert biggest < 60_000 / 8 * 2


def test_expand_copies_cuts_large_counts(spark):
    df = spark.createDataFrame([("a", 1), ("b", 25), ("c", 10)], "k string, n bigint")
    want = [("a", 0), *[("b", i) for i in range(25)], *[("c", i) for i in range(10)]]
    assert sorted(rows(expand_copies(df, "n", "i", chunk=10), "k", "i")) == want


@pytest.mark.parametrize(
    "left, right, want",
    [
        ([1, 2, None], [2], [1]),
        ([1, 2, None], [2, None], []),
        ([1, None], [], [1, None]),
        ([1, None], [None], []),
        ([1, 1, 2], [2, 2], [1, 1]),
    ],
)
def test_anti_null_aware_follows_not_in(spark, left, right, want):
    a = spark.createDataFrame([(x,) for x in left], "x int")
    b = spark.createDataFrame([(x,) for x in right], "x int")
    assert Counter(r[0] for r in rows(anti_null_aware(a, b, "x"))) == Counter(want)
    a.createOrReplaceTempView("a_side")
    b.createOrReplaceTempView("b_side")
    plain = spark.sql("select x from a_side where x not in (select x from b_side)")
    assert Counter(r[0] for r in rows(plain)) == Counter(want)


def test_anti_null_aware_by_day(spark):
    a = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (3, None), (3, 5), (4, None)], "day int, x int")
    b = spark.createDataFrame([(1, 1), (2, None), (3, 9)], "day int, x int")
    assert sorted(rows(anti_null_aware(a, b, "x", by="day")), key=str) == [(1, 2), (3, 5), (4, None)]


def test_left_join_many_is_a_left_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n"), (3, "c")], "k int, l string")
    right = spark.createDataFrame([(1, 10)] * 5 + [(3, 30), (None, 99)], "k int, r int")
    assert counted(left_join_many(left, right, ["k"])) == counted(left.join(right, ["k"], "left"))


def test_money_sum_is_exact(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(1e9,)], "x double").repartition(7)
    assert df.agg(money_sum(F.col("x"))).first()[0] == 1000000001.0


def test_money_sum_keeps_thirds(spark):
    df = spark.createDataFrame([(100 / 3,)] * 3, "x double")
    assert df.agg(money_sum(F.col("x"))).first()[0] == pytest.approx(100, abs=1e-5)


def test_pivot_sum_gives_zero_for_other_tags(spark):
    df = spark.createDataFrame([("a", "real", 1.5), ("a", "prev", 2.0), ("b", "real", 3.0)], "k string, s string, v double")
    got = pivot_sum(df, ["k"], "s", "v", {"real": "r", "prev": "p"})
    assert sorted(rows(got, "k", "r", "p")) == [("a", 1.5, 2.0), ("b", 3.0, 0.0)]


def test_run_stats_round_before_the_sum(spark):
    at = [datetime(2024, 1, 1, h) for h in range(4)]
    df = spark.createDataFrame(
        [("a", at[0], 0.004, "p"), ("a", at[1], 0.006, "p"), ("a", at[1], 0.016, "q"), ("a", at[2], 0.0, "p")],
        "k string, at timestamp_ntz, cost double, who string",
    )
    runs = paid_runs(df, ["k"], "at", "cost", payload=["who"])
    assert sorted(rows(runs, "at", "cost", "who")) == [(at[0], 0.004, "p"), (at[1], 0.016, "q")]
    stats = run_stats(runs, ["k"], "at", "cost").first()
    assert tuple(stats) == ("a", at[0], at[1], 0.02, 2)


def test_mean_cost_of_no_runs_is_null(spark):
    df = spark.createDataFrame([(None, None)], "c double, n bigint")
    assert df.select(mean_cost(F.col("c"), F.col("n"))).first()[0] is None


def test_corrections_apply_the_first_rule(spark):
    df = spark.createDataFrame(
        [("2020-03-04", "loja azul", "x"), ("2021-01-01", "curso 12", "x"), ("2021-01-01", None, "x")],
        "day string, name string, kind string",
    )
    rules = [
        ((F.col("day") == "2020-03-04") & (F.col("name") == "loja azul"), "casa"),
        (F.regexp_extract("name", r"^([a-z]+ \d+)$", 1) == "curso 12", "escola"),
    ]
    assert [r[2] for r in rows(apply_corrections(df, "kind", rules))] == ["casa", "escola", "x"]
    assert apply_corrections(df, "kind", []) is df
