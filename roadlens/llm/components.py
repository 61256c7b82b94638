"""Connected components of a graph that may hold very large stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import discard, join_by_class, stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b), root being the least node that it reaches.

    Large-star and small-star steps alternate until the links are stars around
    their least nodes.  A step needs each node's least neighbour: an aggregate
    with map-side combining, joined back with hot nodes broadcast, so no task
    gets the neighbours of a node together.  Every step is written to the
    shared folder, which cuts the lineage.
    """
    def ordered(df):
        return df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def with_least(pairs, least):
        total = pairs.count()
        mins = pairs.groupBy("a").agg(F.min("b").alias("least"), F.count(F.lit(1)).alias("n"))
        return join_by_class(pairs, mins, "a", "n", total).withColumn("least", least)

    links = stored(ordered(links), "links")
    state = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = stored(ordered(with_least(both, F.least("least", "a")).where("b > a")
                               .select(F.col("b").alias("a"), F.col("least").alias("b"))), "links")
        small = with_least(large, F.col("least"))
        new = stored(ordered(small.select(F.col("b").alias("a"), F.col("least").alias("b"))
                             .unionByName(small.select("a", F.col("least").alias("b")))), "links")
        discard(links)
        discard(large)
        links, before = new, state
        state = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before or not state[0]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
