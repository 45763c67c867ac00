import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strutwise.operators import selection as S
from strutwise.operators import spatial


def test_bits_keep_the_order(spark):
    values = [-math.inf, -1e300, -2.5, -5e-324, -0.0, 0.0, 5e-324, 1.0, 1.0000000000000002, 3e8, math.inf]
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v double").repartition(3)
    got = rows.withColumn("bits", S.order_bits("v")).withColumn("back", S.from_order_bits("bits")).orderBy("k").collect()
    bits = [r.bits for r in got]
    assert bits == sorted(bits) and bits[4] == bits[5] and len(set(bits)) == len(bits) - 1
    assert [r.back for r in got] == [v + 0.0 for v in values]


@pytest.mark.parametrize("kind", ["wide", "ties", "one"])
def test_order_values_and_quantiles(spark, kind):
    rng = np.random.default_rng(3)
    make = {"wide": lambda: float(rng.normal() * 10.0 ** rng.integers(-200, 200)), "ties": lambda: float(rng.integers(0, 4)), "one": lambda: 7.25}[kind]
    rows = [(g, make() if rng.random() > 0.1 else None) for g in ["a", None, "c"] for _ in range({"a": 200, None: 51, "c": 2}[g])] + [("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    shares = [0.0, 0.1, 0.5, 0.95, 1.0]
    got = {r.g: r for r in S.linear_quantiles(df, "v", shares, ["g"]).collect()}
    for g in {g for g, v in rows if v is not None}:
        own = np.array([v for k, v in rows if k == g and v is not None])
        assert got[g].n == len(own) and np.allclose(got[g]["at"], np.quantile(own, shares), rtol=1e-12, atol=0)
    assert "empty" not in got
    known = df.where("v is not null").select("g", S.order_bits("v").alias("bits"))
    ranks = spark.createDataFrame([("a", 0), ("a", 17), ("c", 99)], "g string, rank long")
    own = sorted(v for k, v in rows if k == "a" and v is not None)
    picked = {(r.g, r.rank): r for r in S.order_values(known, ranks, ["g"]).withColumn("v", S.from_order_bits("bits")).collect()}
    assert set(picked) == {("a", 0), ("a", 17)} and picked["a", 17].v == own[17]
    assert picked["a", 17].left == 17 - own.index(own[17]) and picked["a", 17].equal == own.count(own[17])


def test_quantiles_without_groups_and_of_nothing(spark):
    df = spark.range(0, 101).select(F.col("id").cast("double").alias("v"))
    assert [round(x, 9) for x in S.linear_quantiles(df, "v", [0.25, 0.995], []).first()["at"]] == [25.0, 99.5]
    assert S.linear_quantiles(df.limit(0), "v", [0.5], []).count() == 0
    assert spatial.quantiles(df.withColumn("v", F.lit(None).cast("double")), "v", (0.5,)).collect() == [(0, None)]


def test_medians_of_finite_values(spark):
    df = spark.createDataFrame([("a", 1.0, math.nan), ("a", 3.0, math.inf), ("b", None, 2.0), (None, 5.0, None)], "k string, x double, y double")
    assert {r.k: (r.median_x, r.median_y) for r in spatial.medians(df, "k", ["x", "y"]).collect()} == {"a": (2.0, None), "b": (None, 2.0), None: (5.0, None)}
