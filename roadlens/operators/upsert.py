"""Keyed upsert: latest row per key, merge into a target table, counts, and
a versioned table in key buckets: a write stores the buckets it touches and
never overwrites what is being read.

Latest-per-key is an aggregation, not a window: ``max(struct(order..., row))``
is combined map-side, so a key holding a third of all rows costs one row per
partition before the shuffle instead of one sorted partition of that size.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` tuple per key (ties broken by the
    remaining columns, so the choice is deterministic)."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
                      *[F.col(c).alias(f"r{i}") for i, c in enumerate(rest)])
    agg = df.groupBy(*keys).agg(F.max(packed).alias("__w"))
    out = [F.col(k) for k in keys]
    out += [F.col(f"__w.o{i}").alias(c) for i, c in enumerate(order)]
    out += [F.col(f"__w.r{i}").alias(c) for i, c in enumerate(rest)]
    return agg.select(*out).select(*df.columns)


def merge(target: DataFrame, source: DataFrame, key: str, order: list[str],
          as_of: dt.datetime | None = None, audit: bool = True) -> DataFrame:
    """Insert-or-overwrite by key: the latest source row per key replaces the
    target row (all fields that the source has); target-only keys are kept, and
    so are the values of columns that only the target has.  ``op`` is insert,
    update or keep; created_at survives updates, updated_at is the merge time
    for every written row.  Columns: the source's, then the target's others."""
    as_of = as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    src = latest_per_key(source, key, order)
    payload = [c for c in source.columns if c not in ((key, "created_at", "updated_at", "op") if audit else (key, "op"))]
    t_cols = target.columns
    t = target.select(key, *[F.col(c).alias(f"t__{c}") for c in t_cols if c != key],
                      F.lit(True).alias("__t"))
    s = src.select(key, *[F.col(c).alias(f"s__{c}") for c in payload], F.lit(True).alias("__s"))
    j = t.join(s, key, "full_outer")
    in_s = F.col("__s").isNotNull()
    in_t = F.col("__t").isNotNull()
    cols = [F.col(key)]
    for c in payload:
        t_val = F.col(f"t__{c}") if c in t_cols else F.lit(None)
        cols.append(F.when(in_s, F.col(f"s__{c}")).otherwise(t_val).alias(c))
    audited = ("created_at", "updated_at") if audit else ()
    cols += [F.col(f"t__{c}").alias(c) for c in t_cols if c not in (key, "op", *payload, *audited)]
    cols.append(F.when(in_s & in_t, "update").when(in_s, "insert").otherwise("keep").alias("op"))
    if audit:
        now = F.lit(as_of).cast("timestamp_ntz")
        created = F.col("t__created_at") if "created_at" in t_cols else F.lit(None).cast("timestamp_ntz")
        updated = F.col("t__updated_at") if "updated_at" in t_cols else F.lit(None).cast("timestamp_ntz")
        cols.append(F.when(in_t, F.coalesce(created, now)).otherwise(now).alias("created_at"))
        cols.append(F.when(in_s, now).otherwise(F.coalesce(updated, now)).alias("updated_at"))
    return j.select(*cols)


def merge_counts(merged: DataFrame) -> DataFrame:
    """Rows written by the merge, split into inserted and updated (one row)."""
    return merged.agg(F.count_if(F.col("op") != "keep").alias("upserted"),
                      F.count_if(F.col("op") == "insert").alias("inserted"),
                      F.count_if(F.col("op") == "update").alias("updated"))


#: Key buckets of a table unless it says otherwise; a bucket is what an upsert rewrites at least, by one task.
BUCKETS = 32


class VersionedTable:
    """A Parquet table in buckets of its key's hash, as ``base/version=N/bucket_of_<buckets>=B``.

    A version holds only the buckets that its write touched; the others stay where older versions left them, and the
    table is the newest copy of each bucket.  A version counts once it is complete, so a merge may read while it
    writes, readers see all of a write or nothing, and a failed job leaves the table as it was."""

    def __init__(self, spark: SparkSession, base: str, key: str | None = None, buckets: int = BUCKETS):
        self.spark = spark
        self.base = base.rstrip("/")
        self.key = key
        self.buckets = buckets
        self.column = f"bucket_of_{buckets}"

    def _path(self, *parts: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.base, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, *parts: str) -> list[str]:
        fs, p = self._fs(), self._path(*parts)
        return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []

    def versions(self) -> list[int]:
        fs = self._fs()
        return sorted(int(n.split("=", 1)[1]) for n in self._names()
                      if n.startswith("version=") and fs.exists(self._path(n, "_SUCCESS")))

    def current(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def holdings(self, version: int) -> list[int]:
        """The buckets that a version wrote."""
        names = [n.split("=", 1) for n in self._names(f"version={version}") if n.startswith("bucket_of_")]
        if any(n != self.column for n, _ in names):
            raise ValueError(f"{self.base} has other buckets than {self.buckets}")
        return sorted(int(b) for _, b in names)

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int") if self.key else F.lit(0)

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets of some rows: as many numbers as the table has buckets, at most."""
        return [r[0] for r in rows.select(self._bucket().alias("b")).distinct().collect()]

    def read(self, buckets: list[int] | None = None) -> DataFrame | None:
        """The current rows (of some buckets only); None before the first write.  ``op`` tells what the last version
        did, so rows of buckets that it left alone are kept ones."""
        vs = self.versions()
        if not vs:
            return None
        newest = {b: v for v in vs for b in self.holdings(v)}
        paths = [f"{self.base}/version={v}/{self.column}={b}" for b, v in sorted(newest.items())
                 if buckets is None or b in buckets]
        # A leaf folder read by its own path has no partition columns.  Without any, all folders give the columns.
        out = self.spark.read.option("mergeSchema", "true").parquet(*(paths or [
            f"{self.base}/version={v}/{self.column}={b}" for b, v in newest.items()] or [f"{self.base}/version={vs[-1]}"]))
        if "op" in out.columns:
            last = F.col("_metadata.file_path").contains(f"/version={vs[-1]}/")
            out = out.withColumn("op", F.when(last, F.col("op")).otherwise("keep"))
        return out if paths else out.limit(0)

    def write(self, df: DataFrame) -> int:
        """The rows of ``df`` replace the buckets that they fall into, as the next version."""
        v = (self.current() or 0) + 1
        out = df.withColumn(self.column, self._bucket())
        if self.key:
            out = out.repartition(self.column)
        out.write.mode("overwrite").partitionBy(self.column).parquet(f"{self.base}/version={v}")
        if v == 1 and not self.holdings(v):          # an empty table has its columns at least
            df.limit(0).write.mode("overwrite").parquet(f"{self.base}/version={v}")
        return v

    def retain(self, keep: int) -> None:
        """Delete what only versions before the newest ``keep`` need (readers of an older version must be done; a
        long-running stream keeps a few)."""
        vs = self.versions()
        if keep < 1 or len(vs) <= keep:
            return
        fs, seen = self._fs(), set()
        for v in reversed(vs[:len(vs) - keep + 1]):
            held = self.holdings(v)
            old = [b for b in held if b in seen]
            seen.update(held)
            if v != vs[-keep]:
                if len(old) == len(held) and seen:
                    fs.delete(self._path(f"version={v}"), True)
                else:
                    for b in old:
                        fs.delete(self._path(f"version={v}", f"{self.column}={b}"), True)

    def upsert(self, source: DataFrame, key: str, order: list[str],
               as_of: dt.datetime | None = None, drop: tuple[str, ...] = ()) -> tuple[int, DataFrame]:
        """Merge ``source`` into the buckets that its keys fall into and write these as the next version.  Returns the
        new version and its counts (computed from what was written).  ``drop``: columns that only order the source."""
        self.key = key
        source = latest_per_key(source, key, order).drop(*drop)
        order = [c for c in order if c not in drop] or [c for c in source.columns if c != key][:1]
        cur = self.read(self.touched(source))
        if cur is None:
            cur = self.spark.createDataFrame([], source.schema).withColumns({
                "created_at": F.lit(None).cast("timestamp_ntz"),
                "updated_at": F.lit(None).cast("timestamp_ntz")})
        else:
            cur = cur.drop("op")
        v = self.write(merge(cur, source, key, order, as_of))
        if not self.holdings(v):                     # nothing came
            return v, merge_counts(self.spark.createDataFrame([], "op string"))
        return v, merge_counts(self.spark.read.parquet(f"{self.base}/version={v}"))
