"""Hot keys: one key holding a third of all rows goes through the skew-safe
paths (partial aggregation, salted ranking, slotted lookup) with exact results."""

from pyspark.sql import functions as F

from roadlens.operators import attachments as A
from roadlens.operators import upsert as U
from roadlens.streaming import stream as S


def _hot(spark, n=30000):
    # a third of the rows share key 'hot'; the rest spread over many keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string")))
         .alias("record_id"),
        (F.col("id") * 7919 % 100003).alias("ts"), F.col("id").alias("seq"),
        F.concat(F.lit("v"), F.col("id").cast("string")).alias("v"))


def test_latest_per_key_hot_key(spark):
    df = _hot(spark)
    got = {r.record_id: (r.ts, r.seq) for r in U.latest_per_key(df, "record_id", ["ts", "seq"]).collect()}
    want = {r.record_id: (r.ts, r.seq) for r in df.groupBy("record_id").agg(
        F.max(F.struct("ts", "seq")).alias("m")).select("record_id", "m.ts", "m.seq").collect()}
    assert got == want and got["hot"] == max((r.ts, r.seq) for r in df.filter("record_id = 'hot'").collect())
    plan = U.latest_per_key(df, "record_id", ["ts", "seq"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan          # an aggregation with a partial step, not a sorted window


def test_first_files_hot_record(spark):
    files = _hot(spark).select("record_id", F.col("v").alias("file_name"))
    got = sorted(r.file_name for r in A.first_files(files, k=8).filter("record_id = 'hot'").collect())
    want = sorted(r.file_name for r in files.filter("record_id = 'hot'").orderBy("file_name").limit(8).collect())
    assert got == want


def test_lookup_hot_location(spark):
    ev = spark.range(6000).select(
        F.col("id").alias("event_id"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_interval(secs=F.col("id") * 7)).alias("ts"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("l"), (F.col("id") % 50).cast("string")))
         .alias("location"),
        F.lit(1.0).alias("volume"), F.lit(30.0).alias("average_speed"), F.lit(50.0).alias("speed_limit"))
    e = S.enrich(ev).drop("processed_at")
    lk = ev.select(F.col("event_id").alias("lookup_id"), "location",
                   (F.col("ts") + F.make_interval(secs=F.lit(100))).alias("at"))
    got = {r.lookup_id: r.event_id for r in S.lookup_live(e, lk).collect()}
    rows = [(r.location, r.ts, r.event_id) for r in ev.collect()]
    import datetime as dt
    by = {}
    for loc, ts, eid in rows:
        by.setdefault(loc, []).append((ts, eid))
    for r in lk.filter("location = 'hot'").collect():
        live = [(ts, eid) for ts, eid in by["hot"] if ts <= r.at and ts + dt.timedelta(seconds=300) > r.at]
        assert got[r.lookup_id] == max(live)[1]
