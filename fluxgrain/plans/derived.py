"""Queries on points that are computed outside: judged, stored, published, shown before a formula is stored; the warnings of partitions, the ends of repeats, and what decoders are given."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxgrain.functions import formula
from fluxgrain.operators import decode, maintenance
from fluxgrain.plans.checks import at
from fluxgrain.plans.register import registry
from fluxgrain.sources import store
from fluxgrain.sources.telemetry import from_events, from_events_sql

QUERIES, ORACLES, query = registry()
T = from_events_sql(7)
TAKEN = f"""(SELECT organization_id, device_id, metric_key, time, arg_max(value, raw_message_id) AS value FROM (SELECT device_id % 3 AS organization_id, device_id, raw_message_id, metric_key, date_trunc('hour', time) AS time, value FROM {T}
  WHERE device_id <> 6 AND value IS NOT NULL AND raw_message_id % 37 > 0) GROUP BY ALL)"""


def taken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by the hour, so that many replace one another; some of another organisation, one device switched off."""
    p, i = from_events(spark, sf_dir, 7), F.col("raw_message_id")
    devices = p.select("device_id", (F.col("device_id") % 3).alias("organization_id"), F.when(F.col("device_id") == 6, "INACTIVE").otherwise("ACTIVE").alias("status")).distinct()
    rows = p.select(i.alias("position"), F.when(i % 37 == 0, 9).otherwise(F.col("device_id") % 3).alias("organization_id"), "device_id", "metric_key", F.date_trunc("hour", "time").alias("time"), "value")
    return store.written(maintenance.derived_points(rows, devices, at("2024-03-01 00:00:00")))


@query("derived_rows", f"SELECT device_id, metric_key, time, organization_id, value, 0 AS quality, 16 AS flags, TIMESTAMP '2024-03-01 00:00:00' AS received_at FROM {TAKEN}")
def derived_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that are upserted: of one device, metric and instant the last given."""
    rows, _, _, _ = maintenance.stored_derived(taken(spark, sf_dir), at("2024-03-01 00:00:00"))
    stored = rows.limit(0)
    return maintenance.upsert(stored, rows.withColumn("flags", F.col("flags").cast("int")), order="received_at").select("device_id", "metric_key", "time", "organization_id", "value", F.col("quality").cast("int").alias("quality"), "flags", "received_at")


@query(
    "derived_messages",
    f"""WITH m AS (SELECT organization_id, device_id, time AS measured_at, count(*) AS n_metrics, max(value) AS top, md5('derived:' || device_id || ':' || strftime(time, '%Y-%m-%dT%H:%M:%SZ') || ':' || string_agg(metric_key, ',' ORDER BY metric_key)) AS h FROM {TAKEN} GROUP BY 1, 2, 3)
SELECT organization_id, device_id, measured_at, n_metrics::INTEGER AS n_metrics, top, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-3' || substr(h, 14, 3) || '-' || substr('89ab', 1 + (('0x' || substr(h, 17, 1))::INTEGER % 4), 1) || substr(h, 18, 3) || '-' || substr(h, 21) AS message_id FROM m""",
)
def derived_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message for each device and instant, with the id that a repeat would have too."""
    _, messages, _, _ = maintenance.stored_derived(taken(spark, sf_dir), at("2024-03-01 00:00:00"))
    return messages.select("organization_id", "device_id", "measured_at", F.size("metrics").alias("n_metrics"), F.array_max(F.col("metrics.value")).alias("top"), "message_id")


@query(
    "derived_dirty",
    f"""SELECT device_id, metric_key, 'dirty' AS kind, time AS at_time, NULL::DOUBLE AS value FROM {TAKEN} WHERE time < TIMESTAMP '2024-01-10 00:00:00'
UNION ALL SELECT device_id, metric_key, 'latest', time, value FROM {TAKEN} QUALIFY time = max(time) OVER (PARTITION BY device_id)""",
)
def derived_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minutes to be rolled up anew, and what becomes of the devices' last values."""
    _, _, latest, dirty = maintenance.stored_derived(taken(spark, sf_dir), at("2024-03-01 00:00:00"), at("2024-01-10 00:00:00"))
    return dirty.select("device_id", "metric_key", F.lit("dirty").alias("kind"), F.col("start").alias("at_time"), F.lit(None).cast("double").alias("value")).unionByName(latest.select("device_id", "metric_key", F.lit("latest").alias("kind"), F.col("time").alias("at_time"), "value"))


SPAN = "time >= TIMESTAMP '2024-01-10 00:00:00' AND time < TIMESTAMP '2024-01-11 00:00:00'"


@query(
    "formula_preview",
    f"""WITH p AS (SELECT device_id, time, max(value) AS v FROM {T} WHERE metric_key = 'view' AND value IS NOT NULL GROUP BY 1, 2),
s AS (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY time) AS n FROM p WHERE {SPAN})
SELECT s.device_id, s.time, s.v + (count(w.v) + 1) AS value FROM s LEFT JOIN p w ON w.device_id = s.device_id AND w.time >= s.time - INTERVAL 12 HOUR AND w.time < s.time WHERE n <= 1440 AND s.v IS NOT NULL GROUP BY s.device_id, s.time, s.v""",
)
def formula_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a formula would give for all devices on one day, its window reaching back before that day."""
    series, _ = formula.preview(from_events(spark, sf_dir, 7), "view + rolling_count(view, 12h)", at("2024-01-10 00:00:00"), at("2024-01-11 00:00:00"))
    return series


@query(
    "partition_warnings",
    f"""SELECT 'telemetry' AS "table", 'DEFAULT_PARTITION_ROWS' AS reason, count(*) AS n_rows, '2024-03-01' AS day FROM {from_events_sql(None, 0.25)} WHERE strftime(time, '%Y-%m') NOT IN ('2024-01', '2024-03')""",
)
def partition_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One warning for rows of months without a partition; a table that was warned of today is left out."""
    rows = from_events(spark, sf_dir, None, 0.25).select(F.date_format("time", "yyyy-MM").alias("month"))
    there = spark.createDataFrame([("2024-01",), ("2024-03",)], "month string")
    now = at("2024-03-01 12:00:00")
    told = maintenance.misplaced(there, rows, "telemetry", now)
    again = maintenance.misplaced(there, rows, "telemetry", now, told.withColumn("day", F.date_sub("day", 1)))
    return again.withColumn("day", F.col("day").cast("string"))


E = from_events_sql()


@query(
    "reprocess_finished",
    f"""WITH o AS (SELECT device_id % 20 AS job_id, CASE WHEN raw_message_id % 17 > 0 THEN CASE raw_message_id % 5 WHEN 0 THEN 'INVALID' WHEN 1 THEN 'DUPLICATE' ELSE 'OK' END END AS status, raw_message_id % 13 = 0 AS replayed, raw_message_id % 3 > 0 OR device_id % 20 > 9 AS done FROM {E}),
c AS (SELECT job_id, count(*) AS total, count(*) FILTER (done AND status IS NOT NULL AND NOT replayed) AS processed, count(*) FILTER (done AND status = 'INVALID' AND NOT replayed) AS failed, count(*) FILTER (done AND (status IS NULL OR replayed)) AS skipped FROM o GROUP BY 1)
SELECT job_id, job_id % 3 AS organization_id, CASE WHEN job_id % 4 = 0 THEN 'CANCELLED' WHEN job_id % 5 = 1 THEN 'FAILED' ELSE 'COMPLETED' END AS status, total, processed, failed, skipped, CASE WHEN job_id % 5 = 1 THEN 'lost' END AS error FROM c WHERE job_id % 4 = 0 OR job_id % 5 = 1 OR processed + skipped >= total""",
)
def reprocess_finished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty repeats: those that are through, cancelled or failed, and what they counted; others go on."""
    p, i = from_events(spark, sf_dir), F.col("raw_message_id")
    rows = p.select((F.col("device_id") % 20).alias("job_id"), F.when(i % 17 > 0, F.when(i % 5 == 0, "INVALID").when(i % 5 == 1, "DUPLICATE").otherwise("OK")).alias("status"), (i % 13 == 0).alias("replayed"), ((i % 3 > 0) | (F.col("device_id") % 20 > 9)).alias("done"))
    job = F.col("job_id")
    jobs = rows.groupBy("job_id").agg(F.count("*").alias("total")).select("job_id", (job % 3).alias("organization_id"), F.lit(1).alias("source_id"), "total", (job % 4 == 0).alias("cancelled"), F.when(job % 5 == 1, "lost").alias("error"))
    out = maintenance.reprocess_finished(jobs, rows.where("done").drop("done"), at("2024-03-01 00:00:00"))
    return out.select("job_id", "organization_id", "status", "total", "processed", "failed", "skipped", "error")


@query(
    "decoder_inputs",
    f"""WITH p AS (SELECT raw_message_id, 't/' || device_id AS topic, received_at, CASE raw_message_id % 4 WHEN 0 THEN '{{"v":' || raw_message_id || '}}' WHEN 1 THEN '{{"v":' || raw_message_id WHEN 2 THEN 'v ' || raw_message_id ELSE chr(1) || raw_message_id END AS body FROM {E})
SELECT raw_message_id, topic, CASE WHEN raw_message_id % 4 = 0 THEN body ELSE base64(encode(body)) END AS payload, base64(encode(body)) AS base64, CASE raw_message_id % 4 WHEN 0 THEN 'JSON' WHEN 3 THEN 'BINARY' ELSE 'TEXT' END AS encoding, CASE WHEN raw_message_id % 4 IN (1, 2) THEN body END AS body,
  (raw_message_id % 2)::VARCHAR AS source_id, CASE WHEN raw_message_id % 2 = 1 THEN '5' END AS factor FROM p""",
)
def decoder_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a user's decoder is given of JSON, of what only looks like it, of text and of bytes."""
    p, i = from_events(spark, sf_dir), F.col("raw_message_id")
    text = i.cast("string")
    body = F.when(i % 4 == 0, F.concat(F.lit('{"v":'), text, F.lit("}"))).when(i % 4 == 1, F.concat(F.lit('{"v":'), text)).when(i % 4 == 2, F.concat(F.lit("v "), text)).otherwise(F.concat(F.char(F.lit(1)), text))
    rows = p.select("raw_message_id", F.concat(F.lit("t/"), F.col("device_id").cast("string")).alias("topic"), body.cast("binary").alias("payload"), "received_at", (i % 2).alias("source_id"), F.lit("HTTP").alias("source_type"))
    out = rows.select("raw_message_id", decode.decode_input(rows, F.when(i % 2 == 1, '{"factor":5}')).alias("j"))
    of = lambda path: F.get_json_object("j", path)
    return out.select("raw_message_id", of("$.topic").alias("topic"), of("$.payload").alias("payload"), of("$.payloadBase64").alias("base64"), of("$.payloadEncoding").alias("encoding"), of("$.payloadText").alias("body"), of("$.source.id").alias("source_id"), of("$.source.config.factor").alias("factor"))
