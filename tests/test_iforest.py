"""Isolation forest invariants: planted outliers rank first; the flag rate
follows the contamination; scoring is reproducible."""

import numpy as np
from pyspark.sql import functions as F

from roadlens.operators import iforest as I


def _data(spark, n=3000, planted=20, seed=3):
    rng = np.random.default_rng(seed)
    X = rng.normal(0, 1, size=(n, 3))
    X[:planted] += rng.choice([-1, 1], size=(planted, 3)) * 8
    rows = [(int(i), float(a), float(b), float(c)) for i, (a, b, c) in enumerate(X)]
    return spark.createDataFrame(rows, "id long, f1 double, f2 double, f3 double")


def test_planted_outliers_rank_first(spark):
    df = _data(spark)
    out = I.detect(df, ["f1", "f2", "f3"], "id")
    worst = [r.id for r in out.orderBy("anomaly_score").limit(20).collect()]
    assert sum(1 for i in worst if i < 20) >= 18


def test_flag_rate(spark):
    df = _data(spark, planted=0)
    out = I.detect(df, ["f1", "f2", "f3"], "id", contamination=0.1)
    rate = out.agg(F.avg(F.col("is_anomaly").cast("double"))).collect()[0][0]
    assert 0.08 <= rate <= 0.12


def test_reproducible(spark):
    df = _data(spark, n=800)
    a = sorted((r.id, round(r.anomaly_score, 12)) for r in I.detect(df, ["f1", "f2", "f3"], "id").collect())
    b = sorted((r.id, round(r.anomaly_score, 12)) for r in I.detect(df, ["f1", "f2", "f3"], "id").collect())
    assert a == b
