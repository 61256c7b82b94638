"""Fuzzy best-match lookup of street names against a reference list
(Ratcliff-Obershelp ratio, as Python's difflib computes it).

Plan shape:
  * distinct texts first, on both sides; each pair of texts is scored once;
  * only pairs that can reach the threshold t meet, by lossless filters in the
    JVM.  The matched characters M never exceed the overlap of the two character
    multisets, so a pair of lengths la, lb needs an overlap of at least
    o = ceil(t (la + lb) / 2).  In any fixed order of the tokens, two multisets
    that overlap by o share at least two tokens among each one's first
    length - o + 2.  Tokens are ordered by how few texts have them, and every
    text is found under the pairs of tokens of that prefix, for each length of
    a partner: the join is on both lengths and both tokens.  A pair of texts
    passes under the first two tokens that it shares only, and with its whole
    overlap: each pair comes out once, and there is nothing to make distinct;
  * the remaining pairs are scored by a pandas UDF (difflib), the best per name
    is an aggregation (greatest ratio, then earliest position), and the result
    joins back to the rows.
Frequent pairs of tokens are split by Spark's skew join; there is no cap.
A name whose best ratio is below the threshold keeps its own text.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens import fixed_values as fv


def _ratio_udf():
    """The exact ratio of each pair."""
    @F.pandas_udf("double")
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")
    return ratio


def length_band(la, t: float) -> tuple:
    lo = F.ceil(la * F.lit(t / (2.0 - t)))
    hi = F.floor(la * F.lit((2.0 - t) / t))
    return lo, hi


def _tokens(text):
    """A string's character multiset as tokens: (character, occurrence number)."""
    chars = F.array_sort(F.split(text, ""))
    # Equal characters are neighbours now; a token's number is its distance from the first of them.
    return F.transform(chars, lambda c, i: F.struct(c.alias("c"), (i - F.array_position(chars, c).cast("int")).alias("k")))


def _ranked(texts: DataFrame) -> DataFrame:
    """(side, s, len, ranks) of texts (side, s): their tokens as numbers, the rarest first.

    The table of tokens is as large as the alphabet times the most a text repeats a character."""
    tokens = texts.select("side", "s", F.explode(_tokens(F.col("s"))).alias("t")).select("side", "s", "t.c", "t.k")
    order = Window.orderBy("n", "c", "k")
    ranks = tokens.groupBy("c", "k").agg(F.count(F.lit(1)).alias("n")).select("c", "k", F.row_number().over(order).alias("rank"))
    return (tokens.join(ranks, ["c", "k"]).groupBy("side", "s").agg(F.sort_array(F.collect_list("rank")).alias("ranks"))
            .withColumn("len", F.length("s")))


def _signed(side: DataFrame, own: str, other: str, lengths: DataFrame, t: float) -> DataFrame:
    """A row per length of a possible partner and per pair of the prefix's tokens (x, y).

    ``lengths``: one row, the lengths that the other side has.  If one shared token is enough, y is 0."""
    lo, hi = length_band(F.col(own), t)
    near = side.crossJoin(F.broadcast(lengths)).withColumn(
        other, F.explode(F.filter("lengths", lambda n: (n >= lo) & (n <= hi)))).drop("lengths")
    need = F.ceil((F.col(own) + F.col(other)) * F.lit(t / 2.0) - F.lit(1e-9)).cast("int")
    near = near.withColumn("need", F.greatest(need, F.lit(1)))
    size = F.greatest(F.col(own) - F.col("need") + F.least(F.col("need"), F.lit(2)), F.lit(0)).cast("int")
    near = near.withColumn("prefix", F.slice("ranks", 1, size))
    single = F.transform("prefix", lambda x: F.struct(x.alias("x"), F.lit(0).alias("y")))
    pairs = F.flatten(F.transform("prefix", lambda x, i: F.transform(
        F.slice("prefix", i + 2, F.size("prefix")), lambda y: F.struct(x.alias("x"), y.alias("y")))))
    return near.select(*side.columns, other, "need", F.inline(F.when(F.col("need") < 2, single).otherwise(pairs)))


def candidate_pairs(names: DataFrame, refs: DataFrame, threshold: float) -> DataFrame:
    """(a, b): the pairs of different texts of ``names`` (column a) and ``refs`` (b), neither empty, whose lengths and
    overlap can reach the threshold; each pair once."""
    texts = names.select(F.lit("a").alias("side"), F.col("a").alias("s")).unionByName(refs.select(F.lit("b").alias("side"), F.col("b").alias("s")))
    ranked = _ranked(texts.distinct()).checkpoint(eager=True)
    a = ranked.where("side = 'a'").select(F.col("s").alias("a"), F.col("len").alias("la"), "ranks")
    b = ranked.where("side = 'b'").select(F.col("s").alias("b"), F.col("len").alias("lb"), "ranks")
    sa = _signed(a, "la", "lb", b.agg(F.collect_set("lb").alias("lengths")), threshold).withColumnRenamed("ranks", "ra")
    sb = _signed(b, "lb", "la", a.agg(F.collect_set("la").alias("lengths")), threshold).withColumnRenamed("ranks", "rb").drop("need")
    shared = F.array_intersect("ra", "rb")                        # in the order of the tokens
    same = [sa[c] == sb[c] for c in ("la", "lb", "x", "y")]
    first = (F.size(shared) >= F.col("need")) & (F.get(shared, F.lit(0)) == sa["x"]) & (
        (sa["y"] == 0) | (F.get(shared, F.lit(1)) == sa["y"]))
    return sa.join(sb, [*same, first]).select("a", "b")


def best_matches(names: DataFrame, refs: DataFrame, name_col: str = "name", ref_col: str = "ref_name",
                 pos_col: str = "ref_pos", threshold: float = fv.FUZZY_THRESHOLD,
                 lower: bool = True) -> DataFrame:
    """For each distinct name: the best reference (if its ratio reaches the
    threshold), its ratio, and the output text (reference or the name).
    ``pos_col`` orders the references; of equal ratios the earliest wins."""
    from roadlens.session import checkpoint_dir, ship_package
    checkpoint_dir(names.sparkSession)
    ship_package(names.sparkSession)
    norm = F.lower if lower else (lambda c: c)
    # Read by two steps below: written once (distinct names, far smaller than the rows).
    all_names = (names.select(F.col(name_col).alias("name")).filter(F.col("name").isNotNull()).distinct()
                 .withColumn("a", norm(F.col("name"))).checkpoint(eager=True))
    # Of references equal but for case, the earliest.
    texts = (refs.select(norm(F.col(ref_col)).alias("b"), F.struct(F.col(pos_col).alias("pos"), F.col(ref_col).alias("ref")).alias("p"))
             .filter(F.length("b") > 0).groupBy("b").agg(F.min("p").alias("p")))
    pairs = candidate_pairs(all_names.select("a").filter(F.length("a") > 0), texts, threshold)
    scored = pairs.withColumn("ratio", _ratio_udf()(F.col("a"), F.col("b"))).filter(F.col("ratio") >= threshold)
    best = (scored.join(texts, "b").groupBy("a")
                  .agg(F.min(F.struct((-F.col("ratio")).alias("neg"), "p.pos", "p.ref")).alias("m")))
    out = all_names.join(best, "a", "left")
    return out.select("name", F.col("m.ref").alias("best_ref"), (-F.col("m.neg")).alias("ratio"),
                      F.coalesce(F.col("m.ref"), F.col("name")).alias("matched"))


def apply_matches(df: DataFrame, cols: list[str], refs: DataFrame, threshold: float = fv.FUZZY_THRESHOLD,
                  lower: bool = True) -> DataFrame:
    """Replace each listed column by its best reference (or keep it); '' stays ''."""
    from roadlens.session import checkpoint_dir
    # The names of all columns in one pass: a union would run what is behind ``df`` once per column.
    names = df.select(F.explode(F.array(*cols)).alias("name"))
    # The mapping (one row per distinct name) is joined once per column: write
    # it once; its exact size then lets the planner broadcast it when small.
    checkpoint_dir(df.sparkSession)
    m = best_matches(names, refs, threshold=threshold, lower=lower).select("name", "matched") \
        .checkpoint(eager=True)
    out = df
    for c in cols:
        mc = m.select(F.col("name").alias(f"__n_{c}"), F.col("matched").alias(f"__m_{c}"))
        out = (out.join(mc, out[c] == mc[f"__n_{c}"], "left")
                  .withColumn(c, F.coalesce(F.col(f"__m_{c}"), F.col(c)))
                  .drop(f"__n_{c}", f"__m_{c}"))
    return out


def positional_replace(bad: DataFrame, good: DataFrame, threshold: float = fv.FUZZY_THRESHOLD) -> DataFrame:
    """Line-file variant: case-sensitive, every bad line (row_id, line) gets the
    best good line if its ratio reaches the threshold, else stays; output in
    row order."""
    refs = good.select(F.col("line").alias("ref_name"), F.col("row_id").alias("ref_pos"))
    m = best_matches(bad.select(F.col("line").alias("name")), refs, threshold=threshold, lower=False)
    return (bad.join(m.select(F.col("name").alias("line"), "matched", "ratio"), "line", "left")
               .select("row_id", F.col("line").alias("original"),
                       F.coalesce(F.col("matched"), F.col("line")).alias("output"), "ratio")
               .orderBy("row_id"))
