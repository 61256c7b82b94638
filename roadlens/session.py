"""SparkSession construction and checkpoint-folder handling."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC wall clock (the oracle is UTC-naive),
# ANSI semantics, adaptive execution with partition coalescing and skew
# splitting, and no UI server.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A generated method above HotSpot's 8000-byte JIT limit runs interpreted; at this
    # limit such a subtree falls back to per-operator code that the JIT compiles.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Wide records as JSON texts repeat their field names: zstd finds that, snappy hardly does.
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoint files go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "roadlens",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Return a session with the engine defaults.

    On a cluster ``master`` is left unset so spark-submit decides; tests and
    the bench pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def limit_methods(spark: SparkSession) -> None:
    """The method limit of BASE_CONF for a session that was built elsewhere (spark-submit, a notebook), whose default
    lets methods through that HotSpot never compiles.  A lower limit stays.  Likewise its codec of files: the default
    is replaced, another choice stays."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(key)) > int(BASE_CONF[key]):
        spark.conf.set(key, BASE_CONF[key])
    key = "spark.sql.parquet.compression.codec"
    if spark.conf.get(key) == "snappy":
        spark.conf.set(key, BASE_CONF[key])


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder in that setting and it is used as is,
    scheme included.  Only a local master may leave it unset (tests): a fresh
    scratch folder is made then.  Elsewhere an unset folder is an error,
    because a machine-local one would lose tables with its machine.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="roadlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables; what is written there goes when the
    driver's JVM ends."""
    base = checkpoint_dir(spark).rstrip("/")
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(f"{base}/{name.split('/')[0]}")
    top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(top)
    return f"{base}/{name}"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """What is run inside gives its shuffle files back when it ends, not when the driver next collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: what reads it several times runs the joins behind it
    once, and a file is read in splits, however large the partition was that it comes from.  ``options``: the writer's."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``roadlens`` importable in the Python workers (pandas UDFs and
    grouped-map functions refer to its modules).

    The package is zipped once per driver process and added with
    ``addPyFile``; Spark serves it to every executor, so nothing relies on a
    path that only the driver machine has.  Under spark-submit --py-files it
    is already there and this is a cheap no-op per context."""
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import zipfile

    import roadlens
    root = os.path.dirname(os.path.abspath(roadlens.__file__))
    parent = os.path.dirname(root)
    out = os.path.join(tempfile.mkdtemp(prefix="roadlens-pkg-"), "roadlens.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, parent))
    sc.addPyFile(out)
    _SHIPPED.add(key)
