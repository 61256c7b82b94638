"""File sources: inventory CSV and JSON exports, reference name lists,
positional line files, attachment folders, and source precedence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens import fixed_values as fv


def read_inventory_csv(spark: SparkSession, paths, columns=None, multi_line: bool = False) -> DataFrame:
    """CSV with a header, every column read as STRING (coercion comes later);
    the usual spellings of a missing value are read as NULL.

    Nothing is inferred, and files are split: only ``multi_line`` (line ends
    inside quotes) takes a whole file in one task."""
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    else:
        reader = reader.option("inferSchema", False)
    df = reader.csv(paths)
    return df.select(*[F.when(~F.col(f"`{c}`").isin(fv.MISSING_TOKENS), F.col(f"`{c}`")).alias(c) for c in df.columns])


def read_export_json(spark: SparkSession, paths, schema: T.StructType | None = None,
                     shape: str | None = None) -> DataFrame:
    """JSON export: documents (lists of records, or objects holding a ``records`` list, any number in a file) or JSON
    Lines (one record per line); see :mod:`roadlens.sources.json_records`.

    Anything that is no record fails the read and names the file; ``read_export_with_rejects`` returns it instead.
    Values are read as text; coercion comes later."""
    records, rejects = read_export_with_rejects(spark, paths, schema, shape)
    bad = rejects.select("file", F.substring("text", 1, 200).alias("text")).head(1)
    if bad:
        raise ValueError(f"{bad[0]['file']} has text that is no record: {bad[0]['text']!r}")
    return records


def read_export_with_rejects(spark: SparkSession, paths, schema: T.StructType | None = None,
                             shape: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The good records of a JSON export, and (file, text, size) of every span that is none."""
    from roadlens.sources.json_records import records_and_rejects
    return records_and_rejects(spark, paths, schema, shape)


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs to top-level columns with dotted names (json_normalize)."""
    def walk(dtype, parts):
        for f in dtype.fields:
            here = parts + [f.name]
            if isinstance(f.dataType, T.StructType):
                yield from walk(f.dataType, here)
            else:
                yield F.col(".".join(f"`{p}`" for p in here)).alias(sep.join(here))
    return df.select(*walk(df.schema, []))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the cluster's Hadoop file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def extract(spark: SparkSession, json_path: str | None = None, table_path: str | None = None,
            csv_path: str | None = None, prefer_json: bool = True) -> DataFrame:
    """Source precedence: JSON export (unless turned off), else a table, else
    the CSV; error when none exists."""
    order = []
    if prefer_json and json_path:
        order.append(("json", json_path))
    if table_path:
        order.append(("table", table_path))
    if csv_path:
        order.append(("csv", csv_path))
    for kind, path in order:
        if path_exists(spark, path):
            if kind == "json":
                return read_export_json(spark, path)
            if kind == "table":
                return spark.read.parquet(path)
            return read_inventory_csv(spark, path)
    raise FileNotFoundError("No table, JSON export or CSV found")


def read_reference_names(spark: SparkSession, paths) -> DataFrame:
    """Reference street names: stripped lines, empty and 'n/a' dropped, files
    concatenated.  Keeps the position (file order, then line) for tie-breaks."""
    from roadlens.functions.coerce import PY_WHITESPACE
    paths = [paths] if isinstance(paths, str) else list(paths)
    frames = []
    for i, p in enumerate(paths):
        frames.append(read_positional_lines(spark, p, first_id=0, blank="")
                      .withColumn("file_pos", F.lit(i)))
    df = frames[0]
    for f in frames[1:]:
        df = df.unionByName(f)
    s = F.btrim(F.col("line"), F.lit(PY_WHITESPACE))
    return (df.select(F.col("file_pos"), F.col("row_id").alias("line_pos"), s.alias("ref_name"))
              .filter((F.col("ref_name") != "") & (F.lower("ref_name") != "n/a")))


def read_positional_lines(spark: SparkSession, path: str, first_id: int = fv.POSITIONAL_FIRST_ID,
                          blank: str = "N/A") -> DataFrame:
    """Lines with their position: row ids count from ``first_id`` by file name,
    then line; a blank line becomes ``blank``.

    Lines of one split of a file are read in order, so their running id tells
    their place in the split; a table of the splits (a row each) gives the
    place of a split's first line."""
    from pyspark.sql import Window
    from roadlens.functions.coerce import PY_WHITESPACE
    split = ["file", "start"]
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id"))
    before = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    splits = (lines.groupBy(*split).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
              .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    s = F.btrim(F.col("value"), F.lit(PY_WHITESPACE))
    return (lines.join(splits, split)
            .select((F.col("before") + F.col("id") - F.col("first") + F.lit(first_id)).alias("row_id"),
                    F.when(s == "", F.lit(blank)).otherwise(s).alias("line")))


def read_attachment_folder(spark: SparkSession, base: str, glob: str = "*") -> DataFrame:
    """One row per file under ``base/<record_id>/``: record id from the path."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", True).load(base))
    rid = F.regexp_extract(F.col("path"), r"/([^/]+)/[^/]+$", 1)
    name = F.regexp_extract(F.col("path"), r"/([^/]+)$", 1)
    return files.select(rid.alias("record_id"), name.alias("file_name"),
                        F.col("content"), F.col("length"))
