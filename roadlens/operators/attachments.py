"""Attachments: expand multi-valued columns, records with and without files,
suffix matching of returned names, first files per record, nested uploads.

The suffix match is an equi-join on (record, suffix): every suffix of a
returned name is one row, so no pair of names in a record is ever formed
unless one ends with the other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens import fixed_values as fv
from roadlens.functions.text import content_type


def explode_attachments(df: DataFrame, col: str = "attachments", key: str = "record_id") -> DataFrame:
    """A multi-valued column of structs (file_name, content) to one row per file."""
    return df.select(key, F.inline(F.col(col)))


def records_with_files(records: DataFrame, files: DataFrame, key: str = "record_id") -> DataFrame:
    return records.select(key).distinct().join(files.select(key), key, "left_semi")


def records_without_files(records: DataFrame, files: DataFrame, key: str = "record_id") -> DataFrame:
    return records.select(key).distinct().join(files.select(key), key, "left_anti")


def suffix_matches(local: DataFrame, returned: DataFrame, key: str = "record_id",
                   name: str = "file_name", returned_name: str = "returned_name") -> DataFrame:
    """For every local file, the returned entries of the same record whose
    name ends with the local name; a file with no match keeps one row of NULLs.

    A returned name gives a suffix per length that the record's local names
    have, no more, and suffixes meet local names by equality."""
    cut = suffixes_of_lengths(local, returned, key, name, returned_name)
    hits = cut.withColumnRenamed(key, "__k")
    cond = (F.col(key) == F.col("__k")) & (F.col(name) == F.col("__suffix"))
    return local.join(hits, cond, "left").drop("__k", "__suffix")


def suffixes_of_lengths(local: DataFrame, returned: DataFrame, key: str, name: str, returned_name: str) -> DataFrame:
    """The returned rows, each once per length of a local name of its record that its own name has, with that suffix
    (``__suffix``)."""
    lengths = local.groupBy(key).agg(F.collect_set(F.length(name)).alias("__lengths"))
    n = F.length(F.col(returned_name))
    return (returned.join(lengths, key)
            .withColumn("__length", F.explode(F.filter("__lengths", lambda x: x <= n)))
            .withColumn("__suffix", F.substring(F.col(returned_name), n - F.col("__length") + 1, F.col("__length")))
            .drop("__lengths", "__length"))


def first_files(files: DataFrame, k: int = fv.MAX_FILES_PER_RECORD, key: str = "record_id",
                order: str = "file_name", salt_buckets: int = 64) -> DataFrame:
    """At most k files per record, smallest names first.

    Two stages keep a hot record from landing in one task: rank within
    (record, hash bucket of the name) and keep k per bucket, then rank the
    at most k x buckets survivors per record.  The k smallest overall are
    always among the k smallest of their bucket, so the result is exact."""
    from pyspark.sql import Window
    salted = files.withColumn("__b", F.pmod(F.xxhash64(F.col(order)), F.lit(salt_buckets)))
    w1 = Window.partitionBy(key, "__b").orderBy(order)
    pre = salted.withColumn("__r", F.row_number().over(w1)).filter(F.col("__r") <= k)
    w2 = Window.partitionBy(key).orderBy(order)
    # Filtering on the bare row_number lets Spark cut each window group at k.
    return (pre.withColumn("__r2", F.row_number().over(w2)).filter(F.col("__r2") <= k)
               .withColumn("file_rank", F.col("__r2").cast("bigint")).drop("__b", "__r", "__r2"))


def uploads_per_record(files: DataFrame, key: str = "record_id") -> DataFrame:
    """Per record: file count and the (name, content type) list sorted by name.
    Input is already capped at k files per record, so each list is bounded."""
    item = F.struct(F.col("file_name").alias("filename"), content_type("file_name").alias("contentType"))
    return (files.groupBy(key)
                 .agg(F.count(F.lit(1)).alias("n_files"),
                      F.to_json(F.array_sort(F.collect_list(item))).alias("uploads")))


def upload_results(files: DataFrame, returned: DataFrame, key: str = "record_id") -> DataFrame:
    """Per record: the uploaded files with content type and BIN_ID, the list of returned entries whose name ends
    with the file's (empty without any), by name.  Files are capped per record, and an entry matches by suffix, so
    the lists are bounded by a record's own entries."""
    hits = suffix_matches(files.select(key, "file_name"), returned, key)
    entry = F.struct(F.col("bin_id"), F.col("returned_name").alias("file_name"))
    per_file = hits.groupBy(key, "file_name").agg(
        F.array_sort(F.collect_list(F.when(F.col("bin_id").isNotNull(), entry))).alias("BIN_ID"))
    item = F.struct(F.col("file_name").alias("filename"), content_type("file_name").alias("contentType"), F.col("BIN_ID"))
    return per_file.groupBy(key).agg(F.to_json(F.array_sort(F.collect_list(item))).alias("uploads"))
