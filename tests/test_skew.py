"""Skew-aware joins and rankings against their plain forms."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.operators import skew
from ledgerlens.operators.skew import _heavy_keys, distinct_set, ordered_rank, skew_join


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(1)
    left = [(rng.choice(["hot", "hot", "hot", None, f"k{i % 40}"]), i) for i in range(900)]
    right = [(rng.choice(["hot", "hot", f"k{i % 50}"]), i) for i in range(200)]
    return spark.createDataFrame(left, "k string, a int"), spark.createDataFrame(right, "k string, b int")


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def bag(df):
    return sorted(map(str, df.select("k", "a", "b").collect()))


@pytest.mark.parametrize("how,spread", [("inner", None), ("left", None), ("inner", ["b"])])
def test_same_rows_as_a_plain_join(sides, no_broadcast, how, spread):
    left, right = sides
    joined = skew_join(left, right, ["k"], how, left_spread=["a"], right_spread=spread)
    assert bag(joined) == bag(left.join(right, "k", how))


def test_heavy_keys_are_few_and_split(spark, sides):
    heavy = {r["_k_k"]: r["_splits"] for r in _heavy_keys(sides[0], ["k"], 8, False).collect()}
    assert set(heavy) == {"hot", None} and heavy["hot"] >= 4


def test_left_join_cannot_split_the_right_side(sides):
    with pytest.raises(ValueError):
        skew_join(*sides, ["k"], "left", left_spread=["a"], right_spread=["b"])


@pytest.mark.parametrize("group_rows", [0, 1_000_000])
def test_ordered_rank(sides, monkeypatch, group_rows):
    monkeypatch.setattr(skew, "GROUP_ROWS", group_rows)
    left, _ = sides
    w = Window.partitionBy("k").orderBy("a")
    want = sorted(map(tuple, left.select("k", "a", F.row_number().over(w)).na.fill("-").collect()))
    got = ordered_rank(left, ["k"], [F.asc("a")], "n").select("k", "a", "n").na.fill("-")
    assert sorted(map(tuple, got.collect())) == want
    top = ordered_rank(left, ["k"], [F.asc("a")], "n", 2).select("k", "a", "n").na.fill("-")
    assert sorted(map(tuple, top.collect())) == [r for r in want if r[2] <= 2]


def test_distinct_set(spark):
    df = spark.createDataFrame([("x", "b"), ("x", "a"), ("x", "b"), ("x", None), ("y", None)], "k string, v string")
    assert [tuple(r) for r in distinct_set(df, ["k"], "v", "s").collect()] == [("x", ["a", "b"])]
