"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadlens.session import checkpoint_dir, ship_package

#: A word: a run of characters other than space and the five ASCII controls tab to return.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"

#: Rows that one task of a keyed step is given at most, on average.
ROWS_PER_TASK = 250_000
#: A key is hot from one row in so many of the whole table; so there are at most that many hot keys.
HOT_SHARE = 1000
#: Rows that a hot key has at least.
LEAST_HOT = 1000


def let(value: Column, body) -> Column:
    """``body(x)`` with ``x`` bound to ``value``, which is evaluated once however often ``x`` is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers."""
    ship_package(spark)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    This cuts the lineage: a lost executor costs the tasks it ran, and no step
    below is computed again.  The folder goes when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/roadlens-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _fs_path(spark, path, lambda fs, p: fs.deleteOnExit(p))
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table that :func:`stored` wrote and that nothing reads any more."""
    path = getattr(df, "stored_path", None)
    if path:
        _fs_path(df.sparkSession, path, lambda fs, p: fs.delete(p, True))


def _fs_path(spark: SparkSession, path: str, act) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    act(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p)


def tasks_for(rows: int, per_task: int = ROWS_PER_TASK) -> int:
    """Tasks for a keyed step over ``rows`` rows: in proportion, and at least two per core of a small cluster."""
    return max(12, -(-rows // per_task))


def join_by_class(rows: DataFrame, classes: DataFrame, key: str, size: str, total: int, how: str = "inner") -> DataFrame:
    """Join ``rows`` with ``classes``, which has one row per key and the number of its rows in ``size``.

    Keys with more than one row in HOT_SHARE of all ``total`` rows, of which
    there can be HOT_SHARE at most, are joined by broadcast; the rest shuffles
    on the key.  So no task receives a hot key's rows together.
    """
    limit = max(total // HOT_SHARE, LEAST_HOT)
    hot = classes.where(F.col(size) > limit)
    keys = [r[0] for r in hot.select(key).collect()]      # HOT_SHARE keys at most
    if not keys:
        return rows.join(classes, key, how)
    is_hot = F.coalesce(F.col(key).isin(keys), F.lit(False))
    return (rows.where(is_hot).join(F.broadcast(hot), key, how)
            .unionByName(rows.where(~is_hot).join(classes.where(F.col(size) <= limit), key, how)))


def gapless(df: DataFrame, group: str, order: list[str], name: str, total: int) -> DataFrame:
    """Number the rows of each ``group`` (never null) from 0 without gaps, in column ``name``.

    A group may hold any share of the rows, so it is numbered in buckets: rows
    are dealt by a hash of ``order``, each bucket is numbered on its own, and
    the small table of bucket counts gives every bucket its first number.
    """
    n = tasks_for(total, 100_000)
    dealt = df.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(n)).cast("int"))
    counts = dealt.groupBy(group, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(group, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy(group, "_b").orderBy(*order)
    numbered = dealt.withColumn("_k", F.row_number().over(within) - 1)
    return (numbered.join(first.hint("shuffle_merge"), [group, "_b"])
            .withColumn(name, (F.col("_first") + F.col("_k")).cast("long"))
            .drop("_first", "_k", "_b"))


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs that nothing refers to any more.

    Spark does so when the driver's garbage is collected, which in a driver
    that does little may be long after; disks would keep every step until then.
    """
    import gc
    import time

    for _ in range(2):              # what one collection frees may have held more
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)             # the cleaner works beside
