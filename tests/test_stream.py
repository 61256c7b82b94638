"""Streaming: the stream's latest-metric table equals the batch result; the
slotted live lookup equals a brute-force scan."""

import datetime as dt
import time
import uuid

import pytest
from pyspark.sql import functions as F

from roadlens.session import scratch_path
from roadlens.sources import tables as T
from roadlens.streaming import stream as S

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch(spark):
    events = T.read_table(spark, SF, "events")
    src = (spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
           .option("pathGlobFilter", "events.parquet").parquet(SF))
    run = uuid.uuid4().hex[:8]
    q, table = S.start_metric_stream(spark, spark.sql(T.TRAFFIC_EVENTS_SQL, events=src),
                                     scratch_path(spark, f"t-{run}"), scratch_path(spark, f"c-{run}"))
    q.awaitTermination()
    cols = ["location", "event_id", "ts", "volume", "average_speed", "congestion_level", "expires_at"]
    streamed = sorted(tuple(r) for r in table.read().select(*cols).collect())
    batch = sorted(tuple(r) for r in S.latest_metrics(S.enrich(T.traffic_events(spark, SF))).select(*cols).collect())
    assert streamed == batch and len(batch) > 0


def test_replayed_batch_is_idempotent(spark):
    e = S.enrich(T.traffic_events(spark, SF)).drop("processed_at")
    once = S.merge_latest(None, e)
    twice = S.merge_latest(once, e)
    cols = ["location", "event_id", "ts"]
    assert sorted(once.select(cols).collect()) == sorted(twice.select(cols).collect())


def test_enrich_defaults(spark):
    raw = spark.createDataFrame([
        ('{"event_id": 1, "location": null, "volume": 5, "average_speed": 20}',),
        ('{"event_id": 2, "location": "x", "speed": 45, "speed_limit": 50}',),
        ('not json',)], "value string")
    rows = S.enrich(S.parse_messages(raw)).orderBy("event_id").collect()
    assert [(r.location, r.average_speed, r.congestion_level) for r in rows] == [
        ("unknown", 20.0, "high"), ("x", 45.0, "low")]


def test_lookup_live_vs_brute_force(spark):
    e = S.enrich(T.traffic_events(spark, SF)).drop("processed_at")
    lk = T.traffic_events(spark, SF).select(
        F.col("event_id").alias("lookup_id"), "location",
        (F.col("ts") + F.make_interval(secs=(F.col("event_id") % 11) * 40)).alias("at"))
    got = {r.lookup_id: r.event_id for r in S.lookup_live(e, lk).collect()}
    ev = [(r.location, r.ts, r.event_id) for r in e.select("location", "ts", "event_id").collect()]
    by_loc = {}
    for loc, ts, eid in ev:
        by_loc.setdefault(loc, []).append((ts, eid))
    for r in lk.collect():
        live = [(ts, eid) for ts, eid in by_loc.get(r.location, [])
                if ts <= r.at and ts + dt.timedelta(seconds=300) > r.at]
        want = max(live)[1] if live else None
        assert got[r.lookup_id] == want


def _messages(n, start=0):
    import json
    out = []
    for i in range(start, start + n):
        m = json.dumps({"event_id": str(i), "ts": f"2024-05-01 10:{i % 60:02d}:{i * 7 % 60:02d}", "location": f"l{i % 5}", "volume": i, "average_speed": 40})
        out.append({0: "{broken " + m, 1: "null", 2: "[1]"}.get(i % 9, m))
    return out


def test_rejects_and_restarts(spark, tmp_dir):
    """A stream that is stopped after any batch, or fails inside one, and started again gives the table of one batch
    over all messages; read = parsed + rejected, each once."""
    import os

    import pytest
    os.makedirs(f"{tmp_dir}/in")
    parts = [_messages(40, 40 * i) for i in range(4)]

    def put(i):
        open(f"{tmp_dir}/in/part-{i}.txt", "w").write("\n".join(parts[i]))

    def run():
        raw = spark.readStream.option("maxFilesPerTrigger", 1).text(f"{tmp_dir}/in")
        q, table = S.start_message_stream(spark, raw, f"{tmp_dir}/t", f"{tmp_dir}/r", f"{tmp_dir}/c")
        q.awaitTermination()
        return table

    put(0)
    run()
    put(1)
    put(2)
    write = S.VersionedTable.write
    calls = []

    def failing(self, df):
        out = write(self, df)
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("lost after the table was written")
        return out
    S.VersionedTable.write = failing
    try:
        with pytest.raises(Exception):
            run()
    finally:
        S.VersionedTable.write = write
    run()
    put(3)
    table = run()
    raw = spark.createDataFrame([(m,) for p in parts for m in p], "value string")
    cols = ["location", "event_id", "ts", "volume", "expires_at"]
    events = S.parse_messages(raw).withColumn("ts", F.col("ts").try_cast("timestamp_ntz"))
    want = sorted(tuple(r) for r in S.latest_metrics(S.enrich(events)).select(*cols).collect())
    assert sorted(tuple(r) for r in table.read().select(*cols).collect()) == want and len(want) == 5
    counts = [tuple(r)[1:] for r in S.stream_counts(spark, f"{tmp_dir}/r").orderBy("batch").collect()]
    assert len(counts) == 4 and all(n == p + r for n, p, r in counts) and sum(n for n, _, _ in counts) == 160
    bad = sorted(r.value for r in S.stream_rejects(spark, f"{tmp_dir}/r").collect())
    assert bad == sorted(m for p in parts for m in p if not m.startswith('{"')) and len(bad) > 40


def test_suffixes_are_few(spark):
    """A returned name gives as many rows as its record has lengths of local names, and matches as a full scan does."""
    from roadlens.operators import attachments as A
    local = [("a", "x.pdf"), ("a", "photo.jpg"), ("a", "y.pdf"), ("b", ""), ("c", "only"), ("a", None)]
    returned = [("a", "1-x.pdf", 1), ("a", "x.pdf", 2), ("a", "zz-photo.jpg", 3), ("b", "any", 4), ("a", "pdf", 5), ("d", "q", 6), ("a", None, 7)]
    lo = spark.createDataFrame(local, "record_id string, file_name string")
    re_ = spark.createDataFrame(returned, "record_id string, returned_name string, bin_id int")
    got = sorted((tuple(r) for r in A.suffix_matches(lo, re_).select("record_id", "file_name", "bin_id").collect()), key=str)
    want = []
    for k, n in local:
        ids = [b for k2, x, b in returned if k == k2 and n is not None and x is not None and x.endswith(n)]
        want += [(k, n, b) for b in ids or [None]]
    assert got == sorted(want, key=str)
    assert A.suffixes_of_lengths(lo, re_, "record_id", "file_name", "returned_name").count() <= len(returned) * 2


def _event_files(spark, folder, n=5):
    """The events in n files, in the order of their times, with one event that is late within the delay."""
    events = T.traffic_events(spark, SF)
    rows = events.orderBy("ts", "event_id").limit(4000).collect()
    size = -(-len(rows) // n)
    parts = [rows[i * size:(i + 1) * size] for i in range(n)]
    parts[1].append(parts[0].pop())                           # comes a file later than it should
    for i, part in enumerate(parts):
        # Read in the order of their modification times.
        spark.createDataFrame(part, events.schema).coalesce(1).write.mode("append").parquet(f"{folder}/part={i}")
        time.sleep(1.1)
    return events.schema, rows


@pytest.mark.parametrize("when", ["before", "after"])
def test_state_stream_goes_on_from_its_checkpoint(spark, tmp_dir, monkeypatch, when):
    """Stopped in a batch, before or after its rows were merged, and started again: the table of a batch run; and
    windows that the watermark has passed are no longer in the state."""
    schema, rows = _event_files(spark, f"{tmp_dir}/in")
    merged, calls = S._fold, []

    def failing(table, batch):
        calls.append(1)
        if len(calls) == 3 and when == "before":
            raise RuntimeError("lost")
        merged(table, batch)
        if len(calls) == 3:
            raise RuntimeError("lost")

    monkeypatch.setattr(S, "_fold", failing)

    def run():
        src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/in/part=*")
        return S.start_state_stream(spark, src, f"{tmp_dir}/table", f"{tmp_dir}/ckpt")

    q, _ = run()
    with pytest.raises(Exception, match="lost"):
        q.awaitTermination()
    q, table = run()
    q.awaitTermination()
    cols = ["location", "event_id", "ts", "volume", "average_speed", "congestion_level", "expires_at"]
    got = sorted(tuple(r) for r in table.read().select(*cols).collect())
    batch = S.latest_metrics(S.enrich(spark.createDataFrame(rows, schema)))
    assert got == sorted(tuple(r) for r in batch.select(*cols).collect()) and len(calls) > 5
    state = spark.read.format("statestore").load(f"{tmp_dir}/ckpt").select("key.*").toDF("window", "location").collect()
    ends = [r.window.end for r in state]
    last = max(r.ts for r in rows)
    groups = {(r.location, r.ts.replace(second=0, minute=r.ts.minute // 5 * 5)) for r in rows}
    assert 0 < len(state) < len(groups) and all(e > last - dt.timedelta(seconds=300) for e in ends)


def test_state_stream_cases(spark):
    """As a batch: no time, no window; repeated events count once; an empty table."""
    schema = "event_id string, ts timestamp_ntz, location string, volume double"
    t = dt.datetime(2024, 1, 1, 0, 0, 10)
    df = spark.createDataFrame([("a", t, "x", 1.0), ("b", t, "x", 2.0), ("b", t, "x", 2.0), ("c", None, "x", 3.0), (None, t, None, 4.0)], schema)
    got = {(r.location, r.event_id, r.volume) for r in S.latest_in_windows(df).collect()}
    assert got == {("x", "b", 2.0), (None, None, 4.0)}
    assert S.latest_in_windows(df.limit(0)).count() == 0


def test_a_message_is_parsed_once(spark):
    """The filter on the parsed message repeats neither the parsing nor what the text is made of."""
    made = spark.createDataFrame([("1",), (None,), ("x",)], "a string").select(
        F.when(F.col("a") == "x", F.lit("no json")).otherwise(
            F.to_json(F.struct(F.regexp_replace("a", "1", "one").alias("event_id")))).alias("value"))
    parsed = S.parse_messages(made)
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1
    assert sorted(str(r.event_id) for r in parsed.collect()) == ["None", "one"]
    assert [r.value for r in S.rejected_messages(made).collect()] == ["no json"]
