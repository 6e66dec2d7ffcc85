"""Outer joins against Spark's own, and that hot keys are split."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from loanscope.operators import joins
from loanscope.plans import enrich, staging
from loanscope.session import configure
from tests import samples


def frame(spark, rows, columns):
    return spark.createDataFrame(rows, columns)


def keyed(spark, seed, name, rows=60, keys=12):
    rng = random.Random(seed)
    hot = rows // 3
    values = [("K0", i) for i in range(hot)]
    values += [(rng.choice([None, *(f"K{k}" for k in range(keys))]), hot + i) for i in range(rows - hot)]
    return frame(spark, values, f"k string, {name} int")


def bag(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_left_join_equals_plain(spark, seed):
    left, right = keyed(spark, seed, "a"), keyed(spark, seed + 100, "b", keys=20).where("k is null or k <> 'K5'")
    assert bag(joins.left_join(left, right, "k")) == bag(left.join(right, "k", "left"))


def test_left_join_with_condition(spark):
    left, right = keyed(spark, 5, "a"), keyed(spark, 6, "b")
    matchable = F.col("a") % 3 != 0
    want = left.alias("l").join(
        right.alias("r"), F.expr("l.k = r.k and l.a % 3 <> 0"), "left"
    ).select("l.k", "a", "b")
    assert bag(joins.left_join(left, right, "k", matchable=matchable)) == bag(want)


@pytest.mark.parametrize("seed", range(2))
def test_full_join_equals_plain(spark, seed):
    sides = {name: keyed(spark, seed + i, name, rows=24).where("k is not null") for i, name in enumerate("abc")}
    a, b, c = sides.values()
    want = a.join(b, "k", "full").join(c, "k", "full")
    assert bag(joins.full_join(sides, "k")) == bag(want)


def test_empty_sides(spark):
    left, empty = keyed(spark, 1, "a"), frame(spark, [], "k string, b int")
    assert bag(joins.left_join(left, empty, "k")) == bag(left.join(empty, "k", "left"))
    assert joins.left_join(empty, left, "k").count() == 0


def test_presence(spark):
    sides = {"x": frame(spark, [("a",), ("a",), (None,)], "k string"), "y": frame(spark, [("b",), ("a",)], "k string")}
    assert bag(joins.key_presence(sides, "k")) == [("a", True, True), ("b", False, True)]


@pytest.mark.parametrize("hot_side", ["left", "right"])
def test_hot_key_is_split(spark, hot_side):
    """A key with most rows of either side: the join reads it in several skew partitions."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    configure(spark)
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        def side(name, rows, hot):
            key = F.when(F.lit(hot) & (F.col("id") % 3 == 0), F.lit("hot")).otherwise(F.concat(F.lit("K"), "id"))
            return spark.range(0, rows, 1, 16).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias(name))

        left, right = side("a", 30000, hot_side == "left"), side("b", 30000, hot_side == "right")
        one = frame(spark, [("hot", "x")], "k string, v string")
        if hot_side == "left":
            right = right.unionAll(one)
        else:
            left = left.unionAll(one)
        joined = joins.left_join(left, right, "k")
        execution = joined._jdf.queryExecution()
        rows = execution.toRdd().count()
        assert "skew=true" in execution.executedPlan().toString()
        assert rows == left.join(right, "k", "left").count()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_rows_are_dealt_only_with_hot_keys(spark, monkeypatch):
    left, right = keyed(spark, 1, "a"), keyed(spark, 2, "b")
    plans = {}
    for most in (10**6, 5):
        monkeypatch.setattr(joins, "HOT_ROWS", most)
        plans[most] = joins.left_join(left, right, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "_seed" not in plans[10**6] and "_seed" in plans[5]


PLANS = {
    "customers_with_demographics": (enrich.customers_with_demographics, ("customer_sales", "customer_dob", "customer_gender", "customer_income")),
    "demographics": (staging.demographics, ("customer_dob", "customer_gender", "customer_income")),
    "credit_with_customer": (enrich.credit_with_customer, ("credit_data", "customer_sales", "customer_gender")),
    "credit_with_nps": (enrich.credit_with_nps, ("credit_data", "customer_sales", "customer_income")),
}
IDS = {"credit_data": "loan_id", "customer_dob": "Loan Id "}


@pytest.mark.parametrize(("name", "hot"), [(name, hot) for name, (_, inputs) in PLANS.items() for hot in inputs])
def test_hot_key_is_split_in_chains(spark, monkeypatch, name, hot):
    """A loan with a third of one input's rows ends in several partitions; undealt, as a control, in one."""
    def rows(table):
        key, n = IDS.get(table, "Loan Id"), 360 if table == hot else 240
        told = {"customer_sales": "sale_id", "credit_data": "customer_age"}.get(table)
        ids = ["hot"] * (n // 3 if table == hot else 1)
        ids += [f"L{i}" for i in range(n - len(ids))]
        return [{key: name, **({told: i} if told else {})} for i, name in enumerate(ids)]

    tables = ("credit_data", "customer_sales", "customer_dob", "customer_gender", "customer_income")
    raw = samples.raw_tables(spark, nps_data=[{"Loan Id": "hot", "Submission ID": 1}], **{t: rows(t) for t in tables})
    build = PLANS[name][0]
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "32",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        found = {}
        for most in (10**6, 20):
            monkeypatch.setattr(joins, "HOT_ROWS", most)
            placed = build(raw).where("loan_id = 'hot'").select("*", F.spark_partition_id().alias("place")).toPandas()
            columns = [c for c in placed.columns if c != "place"]
            found[most] = (placed.place.nunique(), sorted(map(str, placed[columns].itertuples(index=False, name=None))))
        assert found[10**6][0] == 1 and found[20][0] >= 2
        assert found[10**6][1] == found[20][1] and len(found[20][1]) == 120
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
