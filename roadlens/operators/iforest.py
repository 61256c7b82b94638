"""Isolation forest on Spark: fit, score, flag.

Fit: each row joins the sample of tree t when a hash of (row key, t) falls
under a threshold sized for about twice the sample; every tree then keeps the
``max_samples`` rows with the smallest hashes.  A row is tested against all
trees by a JVM-side ``filter`` over ``sequence(0, trees-1)``, so only sampled
(row, tree) pairs are materialised (about trees x 2 x samples rows, whatever
the table size).  Trees grow in ``applyInPandas`` per tree id (one group is
one bounded sample), and come back as a node table of at most
trees x (2^(depth+1)) rows, which is the only thing broadcast for scoring.

Score: a pandas UDF over the features walks all trees level by level with NumPy over each
Arrow batch.  As in the usual definition, s(x) = 2^(-E[h(x)] / c(n)); the
decision value is (-s) - offset, offset being the contamination quantile of
the training scores, and a row is an anomaly when the decision value is < 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens import fixed_values as fv

NODE_SCHEMA = ("tree_id long, node_id long, feature int, threshold double, left long, right long, "
               "size long, depth int, leaf boolean")
_HASH_RANGE = 1 << 62


def _c(n: float) -> float:
    """Average path length of an unsuccessful search in a binary tree of n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def _grow(tree_id: int, X: np.ndarray, max_depth: int, seed: int) -> list[tuple]:
    rng = np.random.default_rng([seed, tree_id])
    nodes: list[tuple] = []
    stack = [(0, np.arange(len(X)), 0)]
    next_id = 1
    while stack:
        node_id, idx, depth = stack.pop()
        sub = X[idx]
        if depth >= max_depth or len(idx) <= 1:
            nodes.append((tree_id, node_id, -1, 0.0, -1, -1, len(idx), depth, True))
            continue
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if usable.size == 0:
            nodes.append((tree_id, node_id, -1, 0.0, -1, -1, len(idx), depth, True))
            continue
        f = int(rng.choice(usable))
        thr = float(rng.uniform(lo[f], hi[f]))
        left, right = next_id, next_id + 1
        next_id += 2
        nodes.append((tree_id, node_id, f, thr, left, right, len(idx), depth, False))
        mask = sub[:, f] < thr
        stack.append((left, idx[mask], depth + 1))
        stack.append((right, idx[~mask], depth + 1))
    return nodes


def fit(df: DataFrame, features: list[str], key: str, trees: int = fv.IFOREST_TREES,
        max_samples: int = fv.IFOREST_SAMPLE, seed: int = fv.SEED, n_rows: int | None = None) -> DataFrame:
    """Grow the forest; returns the node table (trees x at most 2^(d+1) rows)."""
    from roadlens.session import ship_package
    ship_package(df.sparkSession)
    n = n_rows if n_rows is not None else df.count()
    psi = min(max_samples, n)
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    rate = min(1.0, 2.0 * psi / max(n, 1))
    # About 2 psi rows per tree, also of 1e15 rows: the range leaves thousands of hashes for them.
    limit = max(int(rate * _HASH_RANGE), 1)
    h = lambda t: F.pmod(F.xxhash64(F.col(key), t, F.lit(seed)), F.lit(_HASH_RANGE))
    picked = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: h(t) < F.lit(limit))
    cand = (df.select(key, *features, F.explode(picked).alias("tree_id"))
              .withColumn("__h", h(F.col("tree_id"))))
    from pyspark.sql import Window
    w = Window.partitionBy("tree_id").orderBy("__h", key)
    sample = cand.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= psi)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tid = int(pdf["tree_id"].iloc[0])
        X = pdf.sort_values(["__h", key])[features].to_numpy(dtype=float)
        return pd.DataFrame(_grow(tid, X, max_depth, seed),
                            columns=["tree_id", "node_id", "feature", "threshold", "left", "right",
                                     "size", "depth", "leaf"])

    nodes = sample.groupBy("tree_id").applyInPandas(grow, NODE_SCHEMA)
    return nodes.withColumn("psi", F.lit(psi))


def _tree_arrays(nodes_pdf: pd.DataFrame):
    trees = []
    for _, g in nodes_pdf.groupby("tree_id"):
        g = g.sort_values("node_id")
        m = int(g["node_id"].max()) + 1
        feat = np.full(m, -1, dtype=np.int64)
        thr = np.zeros(m)
        left = np.full(m, -1, dtype=np.int64)
        right = np.full(m, -1, dtype=np.int64)
        leafval = np.zeros(m)
        ids = g["node_id"].to_numpy()
        feat[ids] = g["feature"].to_numpy()
        thr[ids] = g["threshold"].to_numpy()
        left[ids] = g["left"].to_numpy()
        right[ids] = g["right"].to_numpy()
        leafval[ids] = g["depth"].to_numpy() + np.array([_c(s) for s in g["size"].to_numpy()])
        trees.append((feat, thr, left, right, leafval))
    return trees


def score(df: DataFrame, nodes, features: list[str]) -> DataFrame:
    """Adds ``score_samples`` (= -s(x), higher is more normal).  ``nodes`` is
    the node table (DataFrame or its pandas copy).  Only the features go
    through Python, Arrow batch by batch."""
    spark = df.sparkSession
    from roadlens.session import ship_package
    ship_package(spark)
    # The node table is the model: at most trees x 2 x max_samples rows, whatever the data size.
    pdf = nodes if isinstance(nodes, pd.DataFrame) else nodes.toPandas()
    if pdf.empty:                                        # fitted on an empty table
        return df.withColumn("score_samples", F.lit(-0.5))
    psi = int(pdf["psi"].iloc[0])
    bc = spark.sparkContext.broadcast(pdf)
    cn = _c(psi)

    @F.pandas_udf("double")
    def samples(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        trees = _tree_arrays(bc.value)
        for columns in batches:
            X = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            rows = np.arange(len(X))
            total = np.zeros(len(X))
            for feat, thr, left, right, leafval in trees:
                node = np.zeros(len(X), dtype=np.int64)
                while True:
                    f = feat[node]
                    inner = f >= 0
                    if not inner.any():
                        break
                    go_left = X[rows, np.where(inner, f, 0)] < thr[node]
                    node = np.where(inner, np.where(go_left, left[node], right[node]), node)
                total += leafval[node]
            yield pd.Series(-np.power(2.0, -(total / len(trees)) / cn) if cn > 0 else np.full(len(X), -0.5))

    return df.withColumn("score_samples", samples(*[F.col(f).cast("double") for f in features]))


def detect(df: DataFrame, features: list[str], key: str, contamination: float = fv.IFOREST_CONTAMINATION,
           trees: int = fv.IFOREST_TREES, max_samples: int = fv.IFOREST_SAMPLE, seed: int = fv.SEED) -> DataFrame:
    """Fit on ``df`` and flag it: adds anomaly_score (decision value) and is_anomaly."""
    from roadlens.session import written
    nodes = fit(df, features, key, trees, max_samples, seed).toPandas()
    # Scores are read twice (offset, then flags): materialise them once, in files that are read in splits.
    scored = written(score(df, nodes, features), "forest-scores")
    # Offset: the exact contamination quantile of the training scores, one row.
    from roadlens.operators.selection import quantiles
    off = quantiles(scored.withColumn("__all", F.lit(0)), "score_samples", "__all", (contamination,)).select(F.col("q0").alias("__off"))
    return (scored.crossJoin(F.broadcast(off))
                  .withColumn("anomaly_score", F.col("score_samples") - F.col("__off"))
                  .withColumn("is_anomaly", F.col("anomaly_score") < 0)
                  .drop("__off"))
