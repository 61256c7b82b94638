"""Event stream: enrich each message, keep the latest metric per location with
a 300 s time to live, and look the live value up.

The stream is stateless per message (``select``); the per-location state is
a table merged in ``foreachBatch``: each micro-batch is reduced to one row
per location (partial aggregation), unioned with the current rows of the key
buckets it touches and reduced again, and these buckets are written as the
next table version; the others stay as they are.  Ordering is by
(event time, event id), so a replayed batch leaves the table unchanged and
the at-least-once source becomes an idempotent sink.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens import fixed_values as fv
from roadlens.functions import derive as D
from roadlens.operators.upsert import VersionedTable, latest_per_key

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Message schema: the consumer's keys plus the producer's names (speed, timestamp).  Fields are read
# as text and cast one by one, so that a bad field is a missing one and not a lost message.
MESSAGE_FIELDS = {"event_id": "string", "ts": "timestamp_ntz", "timestamp": "timestamp_ntz", "location": "string",
                  "volume": "double", "average_speed": "double", "speed": "double", "speed_limit": "double"}
_MESSAGE_TEXT = T.StructType([T.StructField(n, T.StringType()) for n in (*MESSAGE_FIELDS, "_corrupt_record")])


def _parsed(raw: DataFrame, value_col: str) -> DataFrame:
    text = F.col(value_col).cast("string")
    parsed = F.from_json(text, _MESSAGE_TEXT, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    # An array of one, exploded: a filter on the message stays above it.  Pushed below, it would parse the text again
    # and repeat every expression that the text is made of, at each place that uses one.
    return raw.select(text.alias("__text"), F.explode(F.array(parsed)).alias("m"))


def _readable() -> Column:
    return F.col("m").isNotNull() & F.col("m._corrupt_record").isNull()


def parse_messages(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON payloads to columns: event_id as text, ``ts`` from ``ts`` or the producer's ``timestamp``, numbers; a
    value that cannot be read is null.  Text that is no JSON object goes to :func:`rejected_messages`."""
    m = _parsed(raw, value_col).filter(_readable())
    cols = {n: F.col(f"m.{n}") if t == "string" else F.col(f"m.{n}").try_cast(t) for n, t in MESSAGE_FIELDS.items()}
    cols["ts"] = F.coalesce(cols["ts"], cols.pop("timestamp"))
    return m.select(*[c.alias(n) for n, c in cols.items()])


def rejected_messages(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """The payloads that :func:`parse_messages` leaves out, as text."""
    return _parsed(raw, value_col).filter(~F.coalesce(_readable(), F.lit(False))).select(F.col("__text").alias("value"))


def enrich(events: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """location ('unknown' when absent), volume and speed (0 when absent),
    congestion high/medium/low from speed vs limit (limit 50 when absent)."""
    speed = F.coalesce(F.col("average_speed").cast("double"),
                       F.col("speed").cast("double") if "speed" in events.columns else F.lit(None),
                       F.lit(0.0))
    limit = F.coalesce(F.col("speed_limit").cast("double"), F.lit(float(fv.STREAM_DEFAULT_SPEED_LIMIT)))
    out = events.select(
        *[c for c in ("event_id", "ts") if c in events.columns],
        F.coalesce(F.col("location"), F.lit("unknown")).alias("location"),
        F.coalesce(F.col("volume").cast("double"), F.lit(0.0)).alias("volume"),
        speed.alias("average_speed"),
        D.congestion_by_speed(speed, limit, ("high", "medium", "low")).alias("congestion_level"),
        (processed_at if processed_at is not None else F.current_timestamp()).alias("processed_at"))
    return out


def latest_metrics(enriched: DataFrame, ttl_seconds: int = fv.METRIC_TTL_SECONDS) -> DataFrame:
    """One row per location: the metric of its latest event, with expiry."""
    latest = latest_per_key(enriched, "location", ["ts", "event_id"])
    return latest.withColumn("expires_at", F.col("ts") + F.make_interval(secs=F.lit(ttl_seconds)))


def merge_latest(current: DataFrame | None, batch: DataFrame,
                 ttl_seconds: int = fv.METRIC_TTL_SECONDS) -> DataFrame:
    """Fold a batch of enriched events into the latest-metric table."""
    fresh = latest_metrics(batch, ttl_seconds)
    if current is None:
        return fresh
    both = current.select(*fresh.columns).unionByName(fresh)
    return latest_per_key(both.drop("expires_at"), "location", ["ts", "event_id"]) \
        .withColumn("expires_at", F.col("ts") + F.make_interval(secs=F.lit(ttl_seconds)))


def live_metrics(table: DataFrame, as_of, location: str | None = None) -> DataFrame:
    """Metrics still alive at ``as_of`` (optionally for one location)."""
    t = F.lit(as_of).cast("timestamp_ntz") if not isinstance(as_of, Column) else as_of
    out = table.filter(F.col("expires_at") > t)
    return out.filter(F.col("location") == location) if location is not None else out


def point_in_time(enriched: DataFrame, as_of: dt.datetime,
                  ttl_seconds: int = fv.METRIC_TTL_SECONDS) -> DataFrame:
    """The latest-metric table as it stood at ``as_of``, restricted to live rows."""
    t = F.lit(as_of).cast("timestamp_ntz")
    return live_metrics(latest_metrics(enriched.filter(F.col("ts") <= t), ttl_seconds), t)


def lookup_live(enriched: DataFrame, lookups: DataFrame, key: str = "lookup_id", at: str = "at",
                ttl_seconds: int = fv.METRIC_TTL_SECONDS) -> DataFrame:
    """For many (location, at) lookups: the latest metric of the location with
    ts <= at, if it has not expired (ts + ttl > at); otherwise no match.

    A live metric lies in (at - ttl, at], so events go to their own ttl-wide
    time slot and the next one, and lookups to theirs.  Within a (location,
    slot) both are read in time order and the last event is carried forward:
    the work is linear in events and lookups, however busy a location is.
    ``key`` identifies a lookup (unique)."""
    from pyspark.sql import Window

    def slot(c):
        return F.floor(F.unix_micros(F.col(c).cast("timestamp")) / F.lit(ttl_seconds * 1_000_000))

    metrics = [c for c in enriched.columns if c != "location"]
    ev = enriched.select("location", F.explode(F.array(slot("ts"), slot("ts") + 1)).alias("__slot"),
                         F.col("ts").alias("__t"), F.lit(0).alias("__kind"), F.col("event_id").alias("__order"),
                         F.struct(*metrics).alias("m"))
    asked = F.struct(*[F.col(c) for c in lookups.columns])
    lk = lookups.select("location", slot(at).alias("__slot"), F.col(at).alias("__t"), F.lit(1).alias("__kind"), asked.alias("q"))
    w = (Window.partitionBy("location", "__slot").orderBy("__t", "__kind", "__order")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    both = ev.unionByName(lk, allowMissingColumns=True).withColumn("m", F.last("m", ignorenulls=True).over(w))
    ttl = F.make_interval(secs=F.lit(ttl_seconds))
    live = F.when(F.col("m.ts") + ttl > F.col("__t"), F.col("m"))
    out = both.filter(F.col("__kind") == 1).select("q", live.alias("m"))
    return out.select("q.*", *[F.col(f"m.{c}").alias(c) for c in metrics], (F.col("m.ts") + ttl).alias("expires_at"))


def _fold(table: VersionedTable, enriched: DataFrame) -> None:
    """Merge a batch into the table's buckets that it touches."""
    fresh = latest_per_key(enriched, "location", ["ts", "event_id"]).persist()       # a row per location, read twice
    try:
        table.write(merge_latest(table.read(table.touched(fresh)), fresh))
    finally:
        fresh.unpersist()


def start_metric_stream(spark: SparkSession, source: DataFrame, table_path: str, checkpoint: str,
                        available_now: bool = True, processing_time: str | None = None,
                        keep_versions: int = 3):
    """Run enrich -> latest-metric merge as a streaming query.

    ``source`` is a streaming DataFrame of events (file or Kafka source parsed
    with :func:`parse_messages`).  Offsets live in ``checkpoint``; each batch
    writes the next version of the table at ``table_path``."""
    table = VersionedTable(spark, table_path, "location")

    def fold(batch: DataFrame, batch_id: int) -> None:
        _fold(table, enrich(batch, F.current_timestamp()))
        table.retain(keep_versions)   # one version per batch: keep the newest few

    w = source.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start(), table


def latest_in_windows(enriched: DataFrame, ttl_seconds: int = fv.METRIC_TTL_SECONDS,
                      delay_seconds: int = fv.METRIC_TTL_SECONDS) -> DataFrame:
    """The latest event of every location in each window of ``ttl_seconds``, under a watermark of ``delay_seconds``.

    On a stream this is its state: one row per location and window, and a window leaves the state as soon as the
    watermark has passed its end, so the state holds what may still change, however many locations there ever were.
    Events without a time have no window and are left out.  An event that is older than the watermark's window is
    late and left out; with a delay of a time to live or more its metric has expired by then."""
    rest = [c for c in enriched.columns if c != "location"]
    timed = enriched.withColumn("__at", F.col("ts").cast("timestamp")).withWatermark("__at", f"{delay_seconds} seconds")
    latest = timed.groupBy(F.window("__at", f"{ttl_seconds} seconds").alias("__window"), "location").agg(
        F.max_by(F.struct(*rest), F.struct("ts", "event_id")).alias("__m"))
    return latest.select("location", "__m.*")


def start_state_stream(spark: SparkSession, source: DataFrame, table_path: str, checkpoint: str,
                       delay_seconds: int = fv.METRIC_TTL_SECONDS, available_now: bool = True,
                       processing_time: str | None = None, keep_versions: int = 3):
    """The latest-metric stream with its state in RocksDB, snapshots of which lie in ``checkpoint``.

    Update mode: a batch hands on the locations and windows that it changed only, and these are merged into the table
    by location, event time and id.  A query that stopped anywhere goes on from its checkpoint: a batch that was not
    committed is run again from the state before it, and merging its rows again changes nothing."""
    table = VersionedTable(spark, table_path, "location")

    def fold(batch: DataFrame, batch_id: int) -> None:
        _fold(table, batch)
        table.retain(keep_versions)

    w = (latest_in_windows(enrich(source, F.current_timestamp()), delay_seconds=delay_seconds)
         .writeStream.outputMode("update").foreachBatch(fold).option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)                      # a query keeps the settings it was started with
    try:
        return w.start(), table
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def start_message_stream(spark: SparkSession, raw: DataFrame, table_path: str, rejects_path: str, checkpoint: str,
                         available_now: bool = True, processing_time: str | None = None, keep_versions: int = 3,
                         value_col: str = "value"):
    """From raw messages to the latest-metric table, the unreadable ones to ``rejects_path``.

    ``raw`` is a streaming DataFrame of JSON texts (``value_col``).  A batch has three outputs, each repeatable: its
    rejects and its counts are written over the folder of the batch id, and its metrics are merged by location, event
    time and id.  So a batch that is run again after a failure, at whatever point, leaves what it would have left."""
    table = VersionedTable(spark, table_path, "location")

    def fold(batch: DataFrame, batch_id: int) -> None:
        held = batch.select(value_col).persist()              # read three times
        try:
            rejected_messages(held, value_col).write.mode("overwrite").parquet(f"{rejects_path}/rejects/batch={batch_id}")
            good = parse_messages(held, value_col)
            counts = held.agg(F.count(F.lit(1)).alias("n_read")).crossJoin(good.agg(F.count(F.lit(1)).alias("n_parsed")))
            counts.coalesce(1).write.mode("overwrite").parquet(f"{rejects_path}/counts/batch={batch_id}")
            events = good.withColumn("ts", F.col("ts").try_cast("timestamp_ntz"))
            _fold(table, enrich(events, F.current_timestamp()))
            table.retain(keep_versions)
        finally:
            held.unpersist()

    w = raw.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start(), table


def stream_rejects(spark: SparkSession, rejects_path: str) -> DataFrame:
    """(batch, value): what a message stream could not read."""
    return spark.read.schema("value string, batch long").option("basePath", f"{rejects_path}/rejects").parquet(f"{rejects_path}/rejects")


def stream_counts(spark: SparkSession, rejects_path: str) -> DataFrame:
    """(batch, n_read, n_parsed, n_rejected) of every batch of a message stream."""
    read = spark.read.option("basePath", f"{rejects_path}/counts").parquet(f"{rejects_path}/counts")
    rejected = stream_rejects(spark, rejects_path).groupBy("batch").agg(F.count(F.lit(1)).alias("n_rejected"))
    return (read.select(F.col("batch").cast("long").alias("batch"), "n_read", "n_parsed").join(rejected, "batch", "left")
            .na.fill(0, ["n_rejected"]))
