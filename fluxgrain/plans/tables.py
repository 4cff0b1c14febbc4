"""Queries on changes to stored tables, retention, archives and the statistics of user functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxgrain.operators import maintenance, metrics, scripts
from fluxgrain.plans.register import registry
from fluxgrain.sources import store
from fluxgrain.sources.telemetry import from_events, from_events_sql

QUERIES, ORACLES, query = registry()
T = from_events_sql()
NOW = "2024-02-01 00:00:00"
KEEP = "device_id, metric_key, time, organization_id, value, quality, flags, is_virtual, received_at, raw_message_id"


def at(text: str):
    return F.lit(text).cast("timestamp")


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points with times cut to hours, so that keys meet."""
    return from_events(spark, sf_dir, 5).withColumn("time", F.date_trunc("hour", "time"))


HOURLY = f"(SELECT * REPLACE (date_trunc('hour', time) AS time) FROM {from_events_sql(5)})"
SPLIT = f"h AS (SELECT * FROM {HOURLY}), s AS (SELECT * FROM h WHERE raw_message_id % 3 > 0 QUALIFY row_number() OVER (PARTITION BY device_id, metric_key, time ORDER BY raw_message_id) = 1), n AS (SELECT * FROM h WHERE raw_message_id % 3 = 0)"


def split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    h = hourly(spark, sf_dir)
    old = h.where("raw_message_id % 3 > 0")
    return maintenance.insert_ignore(old.limit(0), old), h.where("raw_message_id % 3 = 0")


@query("upsert_insert_ignore", f"WITH {SPLIT} SELECT {KEEP} FROM (SELECT *, 0 AS o FROM s UNION ALL SELECT *, 1 FROM n) QUALIFY row_number() OVER (PARTITION BY device_id, metric_key, time ORDER BY o, raw_message_id) = 1")
def upsert_insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintenance.insert_ignore(*split(spark, sf_dir))


@query("upsert_overwrite", f"WITH {SPLIT} SELECT {KEEP} FROM (SELECT *, 1 AS o FROM s UNION ALL SELECT *, 0 FROM n) QUALIFY row_number() OVER (PARTITION BY device_id, metric_key, time ORDER BY o, raw_message_id DESC) = 1")
def upsert_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintenance.upsert(*split(spark, sf_dir))


UNIQUE = f"(SELECT * FROM {HOURLY} QUALIFY row_number() OVER (PARTITION BY device_id, metric_key, time ORDER BY raw_message_id) = 1)"


def unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = hourly(spark, sf_dir)
    return maintenance.insert_ignore(h.limit(0), h)


@query(
    "remap_metric",
    f"""WITH u AS (SELECT * FROM {UNIQUE}) SELECT {KEEP} FROM u WHERE metric_key <> 'view' UNION ALL
SELECT {KEEP.replace('metric_key', "'click' AS metric_key").replace('flags', 'flags | 4 AS flags')} FROM u WHERE metric_key = 'view' AND NOT EXISTS (SELECT 1 FROM u c WHERE c.metric_key = 'click' AND c.device_id = u.device_id AND c.time = u.time)""",
)
def remap_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintenance.remap(unique(spark, sf_dir), "view", "click")


@query("remap_dirty", f"SELECT DISTINCT device_id, unnest(['view', 'click']) AS metric_key, date_trunc('minute', time) AS from_time, date_trunc('minute', time) + INTERVAL 1 MINUTE AS to_time, 'REMAP' AS reason FROM {UNIQUE} WHERE metric_key = 'view'")
def remap_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintenance.remap_dirty(unique(spark, sf_dir), "view", "click")


POLICIES = [(0, "ORG", None, 20), (1, "ORG", None, 10), (0, "METRIC", "view", 5), (0, "METRIC", "error", 0), (1, "METRIC", "click", 25), (1, "MODEL", "m-1", 3), (2, "METRIC", "purchase", 2)]
RETAINED = f"""p AS (SELECT *, CASE organization_id WHEN 0 THEN 20 WHEN 1 THEN 10 ELSE 365 END AS org, CASE WHEN organization_id = 0 AND metric_key = 'view' THEN 5 WHEN organization_id = 0 AND metric_key = 'error' THEN 0
  WHEN organization_id = 1 AND metric_key = 'click' THEN 25 WHEN organization_id = 2 AND metric_key = 'purchase' THEN 2 END AS metric, CASE WHEN organization_id = 1 AND device_id % 4 = 1 THEN 3 END AS model,
  epoch_us(TIMESTAMP '{NOW}') - epoch_us(time) AS age FROM {T}),
x AS (SELECT *, coalesce(metric > 0 AND age > metric * 86400000000::BIGINT, false) AS gone_metric, coalesce(model > 0 AND age > model * 86400000000::BIGINT, false) AS gone_model, age > org * 86400000000::BIGINT AS gone_org,
  coalesce(metric = 0 OR metric > org, false) OR coalesce(model = 0 OR model > org, false) AS exempt FROM p),
g AS (SELECT *, (coalesce(metric <= org, false) AND gone_metric) OR (coalesce(model <= org, false) AND gone_model) OR CASE WHEN exempt THEN gone_metric OR gone_model ELSE gone_org END AS gone FROM x)"""


def policies(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(POLICIES, "organization_id bigint, scope string, scope_ref string, retain_days int")


def models(p: DataFrame) -> DataFrame:
    return p.select("device_id", "organization_id").distinct().select("*", F.lit(None).cast("bigint").alias("model_id"), F.concat(F.lit("m-"), (F.col("device_id") % 4).cast("string")).alias("model_code"))


@query("retention_effective", f"WITH {RETAINED} SELECT {KEEP} FROM g WHERE NOT gone")
def retention_effective(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = from_events(spark, sf_dir)
    rows = maintenance.retention_days(p, policies(spark), models(p))
    return rows.where(~maintenance.expired(at(NOW))).select(*p.columns)


@query("retention_preview", f"WITH {RETAINED} SELECT organization_id, count(*) AS n_rows, count(*) FILTER (gone) AS n_expired, round((count(*) FILTER (gone) * 100 / count(*))::DECIMAL(12,6), 1)::DOUBLE AS percent FROM g GROUP BY ALL")
def retention_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = from_events(spark, sf_dir)
    return maintenance.retention_preview(p, policies(spark), at(NOW), models(p))


@query("archive_roundtrip", f"SELECT {KEEP} FROM {T}")
def archive_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All points written as an ordered archive, verified, and read back."""
    p = from_events(spark, sf_dir)
    path = store.scratch(spark, "archive")
    store.archive(p, path)
    if not store.verified(spark, p, path):
        raise RuntimeError("the archive does not hold what was written")
    return spark.read.parquet(path)


RUNS = f"(SELECT metric_key AS script_id, device_id % 3 AS version, time AS run_at, value AS elapsed_ms, raw_message_id % 9 = 0 AS failed, raw_message_id % 90 = 0 AS timed_out, raw_message_id % 1000 * 50 AS input_bytes FROM {from_events_sql(None, 240)})"


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, i = from_events(spark, sf_dir, None, 240), F.col("raw_message_id")
    return p.select(F.col("metric_key").alias("script_id"), (F.col("device_id") % 3).alias("version"), F.col("time").alias("run_at"), F.col("value").alias("elapsed_ms"), (i % 9 == 0).alias("failed"), (i % 90 == 0).alias("timed_out"), (i % 1000 * 50).alias("input_bytes"))


STATS = f"""m AS (SELECT script_id, version, date_trunc('minute', run_at) AS bucket, count(*) AS processed, count(*) FILTER (failed) AS errors, count(*) FILTER (timed_out) AS timeouts, sum(elapsed_ms::DECIMAL(18,6))::DOUBLE / count(*) AS avg_ms,
  quantile_disc(elapsed_ms, 0.95) AS p95_ms, max(elapsed_ms) AS max_ms, max(input_bytes) AS max_input FROM {RUNS} r GROUP BY ALL)"""
HOURS = """h AS (SELECT script_id, version, date_trunc('hour', bucket) AS bucket, sum(processed)::BIGINT AS processed, sum(errors)::BIGINT AS errors, sum(timeouts)::BIGINT AS timeouts,
  sum(avg_ms::DECIMAL(18,6) * processed::DECIMAL(12,0))::DOUBLE / sum(processed) AS avg_ms, max(p95_ms) AS p95_ms, max(max_ms) AS max_ms, max(max_input) AS max_input FROM m GROUP BY 1, 2, 3)"""


@query("script_stats_p95", f"WITH {STATS} SELECT * FROM m")
def script_stats_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scripts.minute_stats(runs(spark, sf_dir))


@query("script_hourly_union", f"WITH {STATS}, {HOURS} SELECT * FROM h")
def script_hourly_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours already rolled up, with those of minutes that are not."""
    m = scripts.minute_stats(runs(spark, sf_dir))
    rolled = scripts.merged_stats(m).where(F.hour("bucket") < 2)
    return scripts.hourly(rolled, m)


@query(
    "script_advice",
    f"""WITH {STATS}, l AS (SELECT script_id, arg_max(version, (bucket, version)) AS version FROM m GROUP BY 1),
a AS (SELECT script_id, version, max(p95_ms) AS p95_ms, max(max_input) AS max_input, sum(errors) AS errors, sum(processed) AS processed FROM m JOIN l USING (script_id, version) GROUP BY 1, 2),
h AS (SELECT *, list_filter([CASE WHEN max_input > 32768 THEN 'LARGE_INPUT' END, CASE WHEN script_id IN ('click', 'view') THEN 'LARGE_LOOP' END], lambda x: x IS NOT NULL) AS causes FROM a)
SELECT script_id, 'SLOW' AS type, floor(p95_ms * 10 + 0.5::DOUBLE) / 10 AS value, CASE WHEN len(causes) = 0 THEN 'CPU' ELSE array_to_string(causes, ',') END AS hints FROM h WHERE p95_ms > 20
UNION ALL SELECT script_id, 'ERROR_RATE', floor(errors * 1000.0::DOUBLE / processed + 0.5::DOUBLE) / 1000, '' FROM h WHERE errors * 10 >= processed""",
)
def script_advice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advice on scripts whose code loops in one of two ways, says so in other words only, or not at all."""
    m = scripts.minute_stats(runs(spark, sf_dir))
    source = F.when(F.col("script_id") == "click", "for (const x of xs) {}").when(F.col("script_id") == "view", "return m.map (f)").when(F.col("script_id") == "error", "// do what is forgotten; while5 = 1").otherwise("return 1")
    return scripts.advice(m, m.select("script_id", "version").distinct().withColumn("source", source)).select("script_id", "type", "value", F.array_join("hints", ",").alias("hints"))


@query("topk_errors_per_type", "SELECT event_id AS id, event_type AS script_id, ts AS occurred_at FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) <= 100")
def topk_errors_per_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = from_events(spark, sf_dir)
    return scripts.newest_errors(p.select(F.col("raw_message_id").alias("id"), F.col("metric_key").alias("script_id"), F.col("time").alias("occurred_at")))


RAW = f"(SELECT raw_message_id AS id, device_id % 7 AS source_id, device_id, received_at, CASE raw_message_id % 5 WHEN 0 THEN 'DUPLICATE' WHEN 1 THEN 'DECODE_ERROR' ELSE 'OK' END AS status FROM {T})"


@query("reprocess_targets", f"SELECT id, status FROM {RAW} WHERE source_id = 3 AND received_at >= TIMESTAMP '2024-01-05 00:00:00' AND received_at < TIMESTAMP '2024-01-25 00:00:00' AND id > 500 AND status <> 'DUPLICATE' AND status <> 'OK'")
def reprocess_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("raw_message_id") % 5
    raw = from_events(spark, sf_dir).select(F.col("raw_message_id").alias("id"), (F.col("device_id") % 7).alias("source_id"), "device_id", "received_at", F.when(m == 0, "DUPLICATE").when(m == 1, "DECODE_ERROR").otherwise("OK").alias("status"))
    return maintenance.reprocess_targets(raw, 3, at("2024-01-05 00:00:00"), at("2024-01-25 00:00:00"), True, after_id=500).select("id", "status")


@query(
    "dead_letters",
    f"""WITH o AS (SELECT DISTINCT device_id AS raw_message_id, 'DECODE' AS stage, 'ING_DECODE_FAILED' AS code, 1 AS attempts, TIMESTAMP '2023-12-01 00:00:00' AS first_at, TIMESTAMP '2023-12-02 00:00:00' AS last_at FROM {T} WHERE device_id % 2 = 0),
f AS (SELECT device_id AS raw_message_id, arg_max(metric_key, time) AS stage, arg_max(metric_key || '!', time) AS code, count(*) AS n, min(time) AS first_at, max(time) AS last_at FROM {T} GROUP BY 1)
SELECT coalesce(o.raw_message_id, f.raw_message_id) AS raw_message_id, coalesce(f.stage, o.stage) AS stage, coalesce(f.code, o.code) AS code, (coalesce(attempts, 0) + coalesce(n, 0))::INTEGER AS attempts, least(o.first_at, f.first_at) AS first_at, greatest(o.last_at, f.last_at) AS last_at
FROM o FULL JOIN f ON o.raw_message_id = f.raw_message_id""",
)
def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = from_events(spark, sf_dir)
    opened = p.where("device_id % 2 = 0").select(F.col("device_id").alias("raw_message_id")).distinct()
    opened = opened.select("*", F.lit("DECODE").alias("stage"), F.lit("ING_DECODE_FAILED").alias("code"), F.lit(1).alias("attempts"), at("2023-12-01 00:00:00").alias("first_at"), at("2023-12-02 00:00:00").alias("last_at"))
    failures = p.select(F.col("device_id").alias("raw_message_id"), F.col("metric_key").alias("stage"), F.concat("metric_key", F.lit("!")).alias("code"), F.col("time").alias("at"))
    return maintenance.dead_letters(opened, failures)


@query(
    "derived_point_validation",
    f"""WITH p AS (SELECT raw_message_id, device_id, CASE WHEN raw_message_id % 11 = 0 THEN 'Abc' WHEN raw_message_id % 13 = 0 THEN '9 bad key' ELSE metric_key END AS k,
  CASE WHEN raw_message_id % 31 <> 0 THEN time END AS t, CASE WHEN raw_message_id % 29 = 0 THEN NULL ELSE value END AS v, CASE WHEN raw_message_id % 37 = 0 THEN 9 ELSE device_id % 3 END AS org FROM {T})
SELECT raw_message_id, CASE WHEN t IS NOT NULL THEN date_trunc('millisecond', t) END AS time, CASE WHEN device_id % 10 = 7 OR org <> device_id % 3 THEN 'UNKNOWN_DEVICE' WHEN device_id % 10 IN (5, 6) THEN 'DEVICE_INACTIVE' WHEN NOT regexp_full_match(k, '[a-z][a-z0-9_]*') THEN 'INVALID_METRIC'
  WHEN v IS NULL THEN 'INVALID_VALUE' WHEN t IS NULL THEN 'INVALID_TIME' WHEN t > TIMESTAMP '2024-01-25 00:05:00' THEN 'FUTURE_TIME' END AS reason FROM p""",
)
def derived_point_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, i = from_events(spark, sf_dir), F.col("raw_message_id")
    last = F.col("device_id") % 10
    devices = p.where(last != 7).select("device_id", "organization_id", F.when(last == 5, "DELETED").when(last == 6, "Inactive").otherwise("ACTIVE").alias("status")).distinct()
    key = F.when(i % 11 == 0, "Abc").when(i % 13 == 0, "9 bad key").otherwise(F.col("metric_key"))
    value = F.when(i % 29 == 0, float("nan")).otherwise(F.col("value"))
    rows = p.select("raw_message_id", "device_id", key.alias("metric_key"), F.when(i % 31 != 0, F.col("time")).alias("time"), value.alias("value"), F.when(i % 37 == 0, 9).otherwise(F.col("organization_id")).alias("organization_id"))
    return maintenance.derived_points(rows, devices, at("2024-01-25 00:00:00")).select("raw_message_id", "time", "reason")


@query(
    "changed_keys",
    f"""WITH v AS (SELECT device_id || '/' || metric_key AS metric_key, max(value) FILTER (raw_message_id % 2 = 0) AS b, max(value) FILTER (raw_message_id % 2 = 1) AS a FROM {T} GROUP BY 1)
SELECT metric_key, CASE WHEN b IS NULL THEN 'ADDED' WHEN a IS NULL THEN 'REMOVED' ELSE 'CHANGED' END AS change FROM v WHERE a IS DISTINCT FROM b""",
)
def changed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = from_events(spark, sf_dir).withColumn("metric_key", F.concat(F.col("device_id").cast("string"), F.lit("/"), F.col("metric_key")))
    half = lambda k: p.where(F.col("raw_message_id") % 2 == k).groupBy("metric_key").agg(F.max("value").alias("value"))
    return scripts.changed_keys(half(0), half(1))


FORMULAS = [(1, "MODEL", 1), (2, "DEVICE", 4), (3, "SPACE", 0), (4, "MODEL", 0), (5, "DEVICE", 8)]


@query(
    "formulas_applicable",
    f"""WITH d AS (SELECT DISTINCT device_id, device_id % 3 AS model_id, device_id % 2 AS space_id FROM {T}), f(id, kind, target, rank) AS (VALUES (1, 'MODEL', 1, 0), (2, 'DEVICE', 4, 1), (3, 'SPACE', 0, 2), (4, 'MODEL', 0, 0), (5, 'DEVICE', 8, 1))
SELECT device_id, f.id AS formula_id, (row_number() OVER (PARTITION BY device_id ORDER BY rank, f.id))::INTEGER AS ordinal FROM d JOIN f ON target = CASE kind WHEN 'MODEL' THEN model_id WHEN 'DEVICE' THEN device_id ELSE space_id END""",
)
def formulas_applicable(spark: SparkSession, sf_dir: str) -> DataFrame:
    devices = from_events(spark, sf_dir).select("device_id").distinct().select("device_id", (F.col("device_id") % 3).alias("model_id"), (F.col("device_id") % 2).alias("space_id"))
    return metrics.applicable(devices, spark.createDataFrame(FORMULAS, "id bigint, target_type string, target_id bigint"))


@query("progress_percent", "SELECT o_orderkey, CASE WHEN o_custkey % 50 = 0 THEN 100.0::DOUBLE ELSE round((least(o_orderkey % 60, o_custkey % 50)::DOUBLE * 100 / (o_custkey % 50))::DECIMAL(20,8), 1)::DOUBLE END AS percent FROM orders")
def progress_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return o.select("o_orderkey", maintenance.progress_percent(F.col("o_orderkey") % 60, F.col("o_custkey") % 50).alias("percent"))


@query("missing_months", f"SELECT strftime(m, '%Y-%m') AS month FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-04-01', INTERVAL 1 MONTH)) AS m) WHERE strftime(m, '%Y-%m') NOT IN (SELECT strftime(time, '%Y-%m') FROM {T})")
def missing_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = from_events(spark, sf_dir)
    return maintenance.missing_months(p.select(F.date_format("time", "yyyy-MM").alias("month")), at("2024-01-15 00:00:00"))


@query("expired_days", f"SELECT DISTINCT strftime(time, '%Y-%m-%d') AS day FROM {T} WHERE time::DATE < DATE '2024-01-20' - 8")
def expired_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = from_events(spark, sf_dir)
    return maintenance.expired_days(p.select(F.date_format("time", "yyyy-MM-dd").alias("day")), at("2024-01-20 05:00:00"), 7)


@query("known_zones", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'Asia/Seoul' WHEN 1 THEN 'America/New_York' END AS zone FROM events")
def known_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("raw_message_id") % 4
    zone = F.when(m == 0, "Asia/Seoul").when(m == 1, "America/New_York").when(m == 2, "+09:00").otherwise("Mars/Base")
    return from_events(spark, sf_dir).select(F.col("raw_message_id").alias("event_id"), maintenance.known_zone(zone).alias("zone"))
