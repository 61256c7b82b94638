"""Exact order statistics of a key's values by radix selection, whatever the share of the rows that a key has.

Values become 64-bit numbers of the same order.  A round counts, per key and
wanted rank, the values that agree with the digits found so far by their next
DIGIT_BITS bits (an aggregation with map-side combining: 2**DIGIT_BITS rows per
key, rank and task at most), and the counts name the next digit.  A rank is
settled as soon as its bin holds one value only, which for real data is after
two or three rounds and after 64 / DIGIT_BITS at the latest.  No task ever sorts
or holds the values of a key, and nothing is approximate.

Defined cases: null keys and values are left out; NaN counts as the greatest
value, -0.0 as 0.0; repeated values and keys of one row are exact; an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGIT_BITS = 12
#: Keys whose few prefixes are sent to all tasks; of more keys, only those with more than one row in HOT_SHARE are.
SENT_KEYS = 100_000
HOT_SHARE = 1000


def _ordered_bits():
    @F.pandas_udf("long")
    def bits(values: pd.Series) -> pd.Series:
        """The bits of a double as a signed number of the same order."""
        x = values.to_numpy(dtype=np.float64) + 0.0
        b = np.where(np.isnan(x), np.float64(np.nan), x).view(np.int64)
        return pd.Series(np.where(b < 0, b ^ np.int64(0x7FFFFFFFFFFFFFFF), b))
    return bits


def _number(values: DataFrame, column: str) -> Column:
    """A 64-bit number in the order of a column's values."""
    if isinstance(values.schema[column].dataType, T.IntegralType):
        return F.col(column).cast("long")
    return _ordered_bits()(F.col(column).cast("double"))


def _near(base: DataFrame, asked: DataFrame, sizes: DataFrame, keys: int) -> DataFrame:
    """The rows of the asked keys with their prefixes.  A key may have any share of the rows, so its rows stay where
    they are: the prefixes go to them.  Only the rows of rare keys, if there are very many keys, are shuffled."""
    if keys <= SENT_KEYS:
        return base.join(F.broadcast(asked), "k")
    total = sizes.agg(F.sum("n")).first()[0]
    hot = F.broadcast(sizes.where(F.col("n") > total // HOT_SHARE).select("k"))
    return (base.join(F.broadcast(asked.join(hot, "k", "left_semi")), "k")
            .unionByName(base.join(hot, "k", "left_anti").join(asked, "k")))


def select_ranks(df: DataFrame, value: str, key: str, wanted: dict[str, Column]) -> DataFrame:
    """Per key: n, min, max, and a column per entry of ``wanted``: the value of that rank (0 is the least).

    A rank is an expression over ``n``, the key's number of values."""
    from roadlens.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    base = df.select(F.col(key).alias("k"), F.col(value).alias("v")).where("k is not null and v is not null")
    # Two narrow columns, written once: every round reads them, none computes them again.
    base = base.select("k", "v", _number(base, "v").alias("u")).checkpoint(eager=True)
    sizes = base.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("min"), F.max("v").alias("max"))
    names = list(wanted)
    ranks = F.array(*[F.struct(F.lit(i).alias("i"), wanted[c].cast("long").alias("left")) for i, c in enumerate(names)])
    sizes = sizes.checkpoint(eager=True)
    keys = sizes.count()
    open_ = sizes.select("k", F.inline(ranks)).withColumn("prefix", F.lit(0).cast("long"))
    settled, shift = None, 64
    while shift > 0:
        bits = min(DIGIT_BITS, shift)
        shift -= bits
        done = shift + bits                                   # bits below the digits found so far
        asked = open_.groupBy("k").agg(F.collect_set("prefix").alias("prefixes"))
        # A row belongs to at most one of the prefixes of its key.
        prefix = F.shiftright("u", done) if done < 64 else F.lit(0).cast("long")
        near = _near(base, asked, sizes, keys).withColumn("prefix", prefix).where(F.array_contains("prefixes", F.col("prefix")))
        digit = F.shiftright("u", shift) if done == 64 else F.shiftright("u", shift).bitwiseAND((1 << bits) - 1)
        bins = near.groupBy("k", "prefix", digit.alias("digit")).agg(
            F.count(F.lit(1)).alias("c"), F.min("u").alias("lo"), F.max("u").alias("hi"), F.min("v").alias("value"))
        # The bins of a prefix in one array (2**DIGIT_BITS at most), read from the least digit on.
        rows = bins.groupBy("k", "prefix").agg(F.sort_array(F.collect_list(F.struct("digit", "c", "lo", "hi", "value"))).alias("bins"))
        start = F.struct(F.col("left").alias("left"), F.lit(-1).alias("at"))
        walked = F.aggregate(F.transform("bins", lambda b, i: F.struct(b["c"].alias("c"), i.alias("i"))), start, lambda a, b: F.when(
            a["at"] >= 0, a).when(a["left"] < b["c"], F.struct(a["left"].alias("left"), b["i"].alias("at")))
            .otherwise(F.struct((a["left"] - b["c"]).alias("left"), a["at"].alias("at"))))
        found = (open_.join(rows, ["k", "prefix"]).withColumn("w", walked)
                 .select("k", "i", F.col("w.left").alias("left"), F.get("bins", F.col("w.at")).alias("b")))
        found = found.checkpoint(eager=True)                  # a row per key and rank
        ready = found.where("b.lo = b.hi").select("k", "i", F.col("b.value").alias("value"))
        settled = ready if settled is None else settled.unionByName(ready)
        open_ = found.where("b.lo <> b.hi").select("k", "i", "left", F.shiftright("b.lo", shift).alias("prefix"))
        if open_.isEmpty():
            break
    values = settled.groupBy("k").agg(*[F.max(F.when(F.col("i") == i, F.col("value"))).alias(c) for i, c in enumerate(names)])
    return sizes.join(values, "k").withColumnRenamed("k", key)


def quantiles(df: DataFrame, value: str, key: str, qs: tuple[float, ...]) -> DataFrame:
    """Per key: n, min, max and ``q0``, ``q1``, ...: quantiles by linear interpolation between neighbours."""
    wanted = {}
    for i, q in enumerate(qs):
        place = F.lit(float(q)) * (F.col("n") - 1)
        wanted[f"a{i}"] = F.floor(place)
        wanted[f"z{i}"] = F.least(F.floor(place) + 1, F.col("n") - 1)
    out = select_ranks(df, value, key, wanted)
    cols = []
    for i, q in enumerate(qs):
        place = F.lit(float(q)) * (F.col("n") - 1)
        cols.append((F.col(f"a{i}") + (place - F.floor(place)) * (F.col(f"z{i}") - F.col(f"a{i}"))).alias(f"q{i}"))
    return out.select(key, "n", "min", "max", *cols)
