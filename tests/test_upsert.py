"""Keyed upsert: latest per key, merge operations, idempotence, versioned table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from roadlens.operators import upsert as U

SCHEMA = "record_id string, ts int, seq int, v string"


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, 1, "x"), ("a", 3, 0, "y"), ("a", 3, 1, "z"), ("b", 2, 0, "w")], SCHEMA)
    got = {r.record_id: r.v for r in U.latest_per_key(df, "record_id", ["ts", "seq"]).collect()}
    assert got == {"a": "z", "b": "w"}


def test_merge_ops(spark):
    t = spark.createDataFrame([("a", 1, 0, "old"), ("c", 1, 0, "keep")], SCHEMA)
    s = spark.createDataFrame([("a", 2, 0, "new"), ("b", 1, 0, "ins"), ("b", 2, 0, "ins2")], SCHEMA)
    m = {r.record_id: (r.v, r.op) for r in U.merge(t, s, "record_id", ["ts", "seq"], audit=False).collect()}
    assert m == {"a": ("new", "update"), "b": ("ins2", "insert"), "c": ("keep", "keep")}
    counts = U.merge_counts(U.merge(t, s, "record_id", ["ts", "seq"], audit=False)).collect()[0]
    assert (counts.upserted, counts.inserted, counts.updated) == (2, 1, 1)


def test_versioned_upsert_idempotent(spark, tmp_dir):
    table = U.VersionedTable(spark, f"{tmp_dir}/devices")
    batch = spark.createDataFrame([("a", 1, 0, "x"), ("b", 1, 0, "y")], SCHEMA)
    t1 = dt.datetime(2024, 1, 1)
    t2 = dt.datetime(2024, 1, 2)
    v1, c1 = table.upsert(batch, "record_id", ["ts", "seq"], as_of=t1)
    first = {r.record_id: r for r in table.read().collect()}
    v2, c2 = table.upsert(batch, "record_id", ["ts", "seq"], as_of=t2)
    second = {r.record_id: r for r in table.read().collect()}
    assert (v1, v2) == (1, 2)
    assert c1.collect()[0].inserted == 2 and c2.collect()[0].updated == 2
    for k in first:
        a, b = first[k].asDict(), second[k].asDict()
        assert a["created_at"] == b["created_at"] == t1
        assert b["updated_at"] == t2
        for col in ("ts", "seq", "v"):
            assert a[col] == b[col]
    # the previous version is still readable until retention drops it
    assert spark.read.parquet(f"{tmp_dir}/devices/version=1").count() == 2
    table.retain(1)
    assert table.versions() == [2] and table.read().count() == 2
    _ = F


def _files(base):
    import pathlib
    return {str(p): (p.stat().st_mtime_ns, p.stat().st_size) for p in pathlib.Path(base).rglob("*.parquet")}


def test_upsert_touches_few_buckets(spark, tmp_dir):
    """Ten keys rewrite their buckets only; the rest keep their files; the table is that of a full merge."""
    base = f"{tmp_dir}/t"
    table = U.VersionedTable(spark, base, buckets=64)
    rows = [(f"k{i}", 1, 0, f"v{i}") for i in range(3000)]
    table.upsert(spark.createDataFrame(rows, SCHEMA), "record_id", ["ts", "seq"], as_of=dt.datetime(2024, 1, 1))
    before = _files(base)
    few = spark.createDataFrame([(f"k{i}", 2, 0, "new") for i in range(8)] + [("x1", 1, 0, "a"), ("x2", 1, 0, "b")], SCHEMA)
    v, counts = table.upsert(few, "record_id", ["ts", "seq"], as_of=dt.datetime(2024, 1, 2))
    assert tuple(counts.first()) == (10, 2, 8)
    assert 0 < len(table.holdings(v)) <= 10 and len(table.holdings(1)) == 64
    after = _files(base)
    assert all(after[p] == t for p, t in before.items())                       # nothing old was touched
    got = {r.record_id: (r.v, r.op) for r in table.read().collect()}
    want = {k: (x, "keep") for k, _, _, x in rows} | {f"k{i}": ("new", "update") for i in range(8)} | {"x1": ("a", "insert"), "x2": ("b", "insert")}
    assert got == want
    # A version that is not complete is not seen; the next write replaces it.
    spark.createDataFrame([("k1", 9, 0, "half")], SCHEMA).write.parquet(f"{base}/version={v + 1}/bucket_of_64=0")
    assert table.current() == v and {r.record_id: (r.v, r.op) for r in table.read().collect()} == want
    nothing = table.upsert(few.limit(0), "record_id", ["ts", "seq"])
    assert nothing[0] == v + 1 and tuple(nothing[1].first()) == (0, 0, 0) and table.read().count() == 3002
    table.retain(1)
    assert table.read().count() == 3002 and len(_files(base)) <= 64 + 1
    wider = few.withColumn("more", F.lit(7))
    table.upsert(wider, "record_id", ["ts", "seq"])
    assert {r.record_id: r.more for r in table.read().collect() if r.more} == {r.record_id: 7 for r in few.collect()}
    with pytest.raises(ValueError):
        U.VersionedTable(spark, base, buckets=8).read()


def test_versioned_table_of_nothing(spark, tmp_dir):
    table = U.VersionedTable(spark, f"{tmp_dir}/empty")
    assert table.read() is None
    v, counts = table.upsert(spark.createDataFrame([], SCHEMA), "record_id", ["ts", "seq"])
    assert v == 1 and tuple(counts.first()) == (0, 0, 0) and table.read().count() == 0
    table.upsert(spark.createDataFrame([("a", 1, 0, "x")], SCHEMA), "record_id", ["ts", "seq"])
    assert [r.v for r in table.read().collect()] == ["x"]
