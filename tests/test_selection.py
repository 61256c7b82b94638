"""Radix selection against sorted lists."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens.operators import selection as S


def _frames(rng):
    wide = [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(301)]
    return {"wide": wide, "near": [1 + i * 2 ** -52 for i in range(200)], "same": [7.25] * 500, "one": [3.5],
            "signs": [-0.0, 0.0, -1.5, 1.5, -1e-320, 1e-320], "few": [rng.choice([1.0, 2.0, 2.5]) for _ in range(900)],
            "ends": [math.inf, -math.inf, math.nan, 0.0, 1.0]}


def test_ranks(spark):
    frames = _frames(random.Random(1))
    rows = [(k, v) for k, vs in frames.items() for v in vs] + [(None, 1.0), ("one", None), ("nothing", None)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    wanted = {f"r{i}": F.floor(F.lit(i / 10) * (F.col("n") - 1)) for i in range(11)}
    got = {r.k: r for r in S.select_ranks(df, "v", "k", wanted).collect()}
    assert set(got) == set(frames)
    for k, vs in frames.items():
        order = sorted(vs, key=lambda x: (math.isnan(x), x))
        for i in range(11):
            want = order[math.floor(i / 10 * (len(vs) - 1))]
            assert got[k][f"r{i}"] == want or math.isnan(want) and math.isnan(got[k][f"r{i}"]), (k, i)


def test_whole_numbers(spark):
    vs = [2 ** 62 + i * 3 for i in range(-50, 50)] + [-2 ** 63, 2 ** 63 - 1, 0]
    df = spark.createDataFrame([("a", v) for v in vs], "k string, v long")
    r = S.select_ranks(df, "v", "k", {"m": F.floor(F.col("n") / 2), "lo": F.lit(0), "hi": F.col("n") - 1}).first()
    assert (r.m, r.lo, r.hi, r.n) == (sorted(vs)[len(vs) // 2], -2 ** 63, 2 ** 63 - 1, len(vs))


@pytest.mark.parametrize("bits", [5, 12])
def test_quantiles(spark, monkeypatch, bits):
    monkeypatch.setattr(S, "DIGIT_BITS", bits)
    rng = random.Random(4)
    rows = [(rng.choice("ab"), rng.gauss(50, 20)) for _ in range(2000)] + [("a", 50.0)] * 3000
    got = {r.k: (r.q0, r.q1, r.q2) for r in S.quantiles(spark.createDataFrame(rows, "k string, v double"), "v", "k", (0.1, 0.5, 0.99)).collect()}
    for k in "ab":
        assert got[k] == pytest.approx(tuple(np.percentile([v for x, v in rows if x == k], [10, 50, 99])), abs=1e-12)


def test_plan_has_no_window_and_empty_input(spark):
    empty = spark.createDataFrame([], "k string, v double")
    assert S.quantiles(empty, "v", "k", (0.5,)).count() == 0
    df = spark.createDataFrame([("a", float(i)) for i in range(50)], "k string, v double")
    assert "Window" not in S.quantiles(df, "v", "k", (0.5,))._jdf.queryExecution().toString()


def test_rows_of_a_key_stay_where_they_are(spark, monkeypatch):
    """A key with all rows is no task's: with few keys nothing is shuffled, with many the hot ones are not."""
    base = spark.range(4000).selectExpr("if(id % 2 = 0, -1, id) k", "cast(id as double) v", "id u")
    sizes = base.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    asked = sizes.select("k", F.array(F.lit(0).cast("long")).alias("prefixes")).checkpoint()
    monkeypatch.setattr(S, "_number", lambda values, column: F.col("u"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = S._near(base, asked, sizes.checkpoint(), 2001)
        plan = few._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
        many = S._near(base, asked, sizes.checkpoint(), S.SENT_KEYS + 1)
        assert many._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, few.collect())) and few.count() == 4000
    monkeypatch.undo()
    one = base.select("k", "v")
    want = {r.k: (r.n, r.q0) for r in S.quantiles(one, "v", "k", (0.5,)).collect()}
    monkeypatch.setattr(S, "SENT_KEYS", 10)
    assert {r.k: (r.n, r.q0) for r in S.quantiles(one, "v", "k", (0.5,)).collect()} == want and want[-1] == (2000, 1999.0)
