"""Stream queries: enrichment (batch twin), latest metric per location,
point-in-time live lookup, and the same latest-metric table produced by a
real Structured Streaming run over the event file."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from roadlens.plans.registry import register, with_views
from roadlens.session import scratch_path
from roadlens.sources import tables as T
from roadlens.streaming import stream as S

AS_OF = dt.datetime(2024, 1, 20, 12, 0, 0)

ENRICH_SQL = """
SELECT event_id, ts, coalesce(location, 'unknown') AS location,
  coalesce(CAST(volume AS DOUBLE), CAST(0.0 AS DOUBLE)) AS volume,
  coalesce(average_speed, CAST(0.0 AS DOUBLE)) AS average_speed,
  CASE WHEN coalesce(average_speed, 0.0) < coalesce(CAST(speed_limit AS DOUBLE), CAST(50.0 AS DOUBLE)) * CAST(0.7 AS DOUBLE) THEN 'high'
       WHEN coalesce(average_speed, 0.0) < coalesce(CAST(speed_limit AS DOUBLE), CAST(50.0 AS DOUBLE)) * CAST(0.9 AS DOUBLE) THEN 'medium'
       ELSE 'low' END AS congestion_level
FROM traffic_events"""

LATEST_SQL = f"""
WITH e AS ({ENRICH_SQL} {{where}})
SELECT location, event_id, ts, volume, average_speed, congestion_level, ts + INTERVAL 300 SECOND AS expires_at
FROM (SELECT *, row_number() OVER (PARTITION BY location ORDER BY ts DESC, event_id DESC) AS rn FROM e) x
WHERE rn = 1"""

OUT = ["location", "event_id", "ts", "volume", "average_speed", "congestion_level", "expires_at"]


@register("stream_enrich", ("R1", "R4", "F22", "P12"), with_views(ENRICH_SQL, "traffic_events"))
def q_stream_enrich(spark, sf):
    return S.enrich(T.traffic_events(spark, sf)).drop("processed_at")


@register("latest_metric", ("K5", "R2", "R3"), with_views(LATEST_SQL.format(where=""), "traffic_events"))
def q_latest_metric(spark, sf):
    return S.latest_metrics(S.enrich(T.traffic_events(spark, sf))).select(*OUT)


LOOKUP_SQL = f"""
WITH e AS ({ENRICH_SQL}),
lk AS (SELECT event_id AS lookup_id, location, ts + to_seconds(CAST((event_id % 7) * 60 AS BIGINT)) AS at FROM traffic_events),
c AS (SELECT lk.lookup_id, lk.location, lk.at, e.event_id, e.ts, e.volume, e.average_speed, e.congestion_level,
        row_number() OVER (PARTITION BY lk.lookup_id ORDER BY e.ts DESC, e.event_id DESC) AS rn
      FROM lk JOIN e ON lk.location = e.location AND e.ts <= lk.at AND e.ts + INTERVAL 300 SECOND > lk.at)
SELECT lk.lookup_id, lk.location, lk.at, c.event_id, c.ts, c.volume, c.average_speed, c.congestion_level,
  c.ts + INTERVAL 300 SECOND AS expires_at
FROM lk LEFT JOIN c ON lk.lookup_id = c.lookup_id AND c.rn = 1"""


@register("live_lookup", ("K6", "R3"), with_views(LOOKUP_SQL, "traffic_events"))
def q_live_lookup(spark, sf):
    e = T.traffic_events(spark, sf)
    lookups = e.select(F.col("event_id").alias("lookup_id"), "location",
                       (F.col("ts") + F.make_interval(secs=(F.col("event_id") % 7) * 60)).alias("at"))
    enriched = S.enrich(e).drop("processed_at")
    return S.lookup_live(enriched, lookups).select(
        "lookup_id", "location", "at", "event_id", "ts", "volume", "average_speed", "congestion_level", "expires_at")


@register("stream_latest_metric", ("S7", "R2", "R6", "K5"), with_views(LATEST_SQL.format(where=""), "traffic_events"))
def q_stream_latest_metric(spark, sf):
    """Runs the streaming job (file source, availableNow) to completion and
    returns the table it wrote."""
    events = T.read_table(spark, sf, "events")
    src = (spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
           .option("pathGlobFilter", "events.parquet").parquet(sf))
    stream = spark.sql(T.TRAFFIC_EVENTS_SQL, events=src)
    run = uuid.uuid4().hex[:12]
    q, table = S.start_metric_stream(spark, stream, scratch_path(spark, f"latest-{run}"),
                                     scratch_path(spark, f"latest-{run}-ckpt"))
    q.awaitTermination()
    return table.read().select(*OUT)


@register("stream_state_metric", ("R2", "R3", "R6", "K5"), with_views(LATEST_SQL.format(where=""), "traffic_events"))
def q_stream_state_metric(spark, sf):
    """The same table by the stream that keeps its state in RocksDB under a watermark."""
    events = T.read_table(spark, sf, "events")
    src = (spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
           .option("pathGlobFilter", "events.parquet").parquet(sf))
    run = uuid.uuid4().hex[:12]
    q, table = S.start_state_stream(spark, spark.sql(T.TRAFFIC_EVENTS_SQL, events=src), scratch_path(spark, f"state-{run}"),
                                    scratch_path(spark, f"state-{run}-ckpt"))
    q.awaitTermination()
    return table.read().select(*OUT)


@register("stream_rejects", ("S7", "N7", "R6"), with_views("""
SELECT 'read' AS kind, CAST(count(*) AS BIGINT) AS n FROM traffic_events
UNION ALL SELECT 'parsed', count(*) FILTER (WHERE event_id % 50 <> 0) FROM traffic_events
UNION ALL SELECT 'rejected', count(*) FILTER (WHERE event_id % 50 = 0) FROM traffic_events
UNION ALL SELECT 'locations', count(DISTINCT coalesce(location, 'unknown')) FILTER (WHERE event_id % 50 <> 0) FROM traffic_events
""", "traffic_events"))
def q_stream_rejects(spark, sf):
    """Events as JSON messages, every 50th of them broken, through the streaming job: what it read, parsed and
    rejected (from its reject sink), and the locations of its table."""
    run = uuid.uuid4().hex[:12]
    source, rejects = scratch_path(spark, f"messages-{run}"), scratch_path(spark, f"rejects-{run}")
    e = T.traffic_events(spark, sf)
    message = F.to_json(F.struct("event_id", "ts", "location", "volume", "average_speed", "speed_limit"))
    e.select(F.when(F.col("event_id") % 50 == 0, F.concat(F.lit("{broken "), message)).otherwise(message).alias("value")).write.text(source)
    q, table = S.start_message_stream(spark, spark.readStream.option("maxFilesPerTrigger", 4).text(source),
                                      scratch_path(spark, f"message-table-{run}"), rejects, scratch_path(spark, f"messages-{run}-ckpt"))
    q.awaitTermination()
    counts = S.stream_counts(spark, rejects).agg(F.sum("n_read").alias("read"), F.sum("n_parsed").alias("parsed"))
    out = counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("n")) for c in ("read", "parsed")])))
    return (out.unionByName(S.stream_rejects(spark, rejects).select(F.lit("rejected").alias("kind"), F.count(F.lit(1)).alias("n")))
            .unionByName(table.read().select(F.lit("locations").alias("kind"), F.count(F.lit(1)).alias("n"))))
