"""Queries on quality rules, stateful checks and derived values over the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxgrain.functions import formula
from fluxgrain.operators import quality, state
from fluxgrain.plans.register import registry
from fluxgrain.sources.telemetry import from_events, from_events_sql

QUERIES, ORACLES, query = registry()
T = from_events_sql()
NOW = "2024-01-30 00:00:00"


def at(text: str):
    return F.lit(text).cast("timestamp")


@query(
    "quality_codes",
    f"""WITH p AS (SELECT raw_message_id, CASE WHEN raw_message_id % 17 <> 0 THEN time END AS measured, received_at + CASE raw_message_id % 5 WHEN 1 THEN INTERVAL 8 DAY WHEN 2 THEN -INTERVAL 2 HOUR ELSE INTERVAL 0 HOUR END AS received, value, metric_key FROM {T}),
r AS (SELECT *, CASE WHEN measured IS NULL THEN 'MISSING' WHEN measured > received + INTERVAL 5 MINUTE THEN 'FUTURE' WHEN measured < received - INTERVAL 7 DAY THEN 'TOO_OLD' END AS reason FROM p),
t AS (SELECT *, CASE WHEN reason IS NULL THEN measured ELSE received END AS time FROM r)
SELECT raw_message_id, time, reason, time <= received - INTERVAL 1 HOUR AS late,
  CASE WHEN raw_message_id % 23 = 0 THEN 5 WHEN reason IS NOT NULL THEN 4 WHEN value < 5 OR value > 100 THEN 1 WHEN raw_message_id % 7 = 0 THEN 3 WHEN metric_key = 'signup' THEN 2 ELSE 0 END AS code FROM t""",
)
def quality_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = from_events(spark, sf_dir)
    m = F.col("raw_message_id") % 5
    received = F.col("received_at") + F.when(m == 1, F.expr("interval 192 hours")).when(m == 2, F.expr("interval -2 hours")).otherwise(F.expr("interval 0 hours"))
    rows = p.select("raw_message_id", "value", "metric_key", F.when(F.col("raw_message_id") % 17 != 0, F.col("time")).alias("measured"), received.alias("received"))
    time, reason = quality.measured_time(F.col("measured"), F.col("received"))
    code = quality.quality_code(F.col("raw_message_id") % 23 == 0, F.col("reason").isNotNull(), quality.out_of_range(F.col("value"), F.lit(5.0), F.lit(100.0)), F.col("raw_message_id") % 7 == 0, F.col("metric_key") == "signup")
    rows = rows.withColumns({"time": time, "reason": reason})
    return rows.select("raw_message_id", "time", "reason", quality.is_late(F.col("time"), F.col("received")).alias("late"), code.alias("code"))


ZONE = "CASE WHEN device_id % 2 = 0 THEN 'America/New_York' ELSE 'Asia/Seoul' END"
COUNTS = f"""c AS (SELECT device_id, CAST((time AT TIME ZONE 'UTC') AT TIME ZONE ({ZONE}) AS DATE) AS day, count(DISTINCT time) AS received, count(DISTINCT time) FILTER (flags & 1 <> 0) AS late,
  count(*) AS n_values, count(*) FILTER (quality = 1) AS out_of_range, count(*) FILTER (quality = 3) AS suspect FROM {T} WHERE flags & 2 = 0 GROUP BY ALL)"""


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = from_events(spark, sf_dir)
    zones = p.select("device_id").distinct().withColumn("timezone", F.when(F.col("device_id") % 2 == 0, "America/New_York").otherwise("Asia/Seoul"))
    return quality.daily_counts(p, zones).withColumn("day", F.col("day").cast("string"))


@query("daily_counts", f"WITH {COUNTS} SELECT * REPLACE (CAST(day AS VARCHAR) AS day) FROM c")
def daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(spark, sf_dir)


@query(
    "daily_score",
    f"""WITH {COUNTS}, i AS (SELECT *, CASE WHEN device_id % 3 > 0 THEN 21600 * (device_id % 3) END AS interval_sec FROM c),
e AS (SELECT *, coalesce(86400 // interval_sec, 0)::INTEGER AS expected FROM i),
s AS (SELECT *, CASE WHEN interval_sec IS NULL OR expected = 0 THEN 100 ELSE floor(least(received, expected) * 100.0::DOUBLE / expected + 0.5) END::INTEGER AS completeness,
  floor((received - late) * 100.0::DOUBLE / received + 0.5)::INTEGER AS timeliness, floor((n_values - out_of_range) * 100.0::DOUBLE / n_values + 0.5)::INTEGER AS validity, floor((n_values - suspect) * 100.0::DOUBLE / n_values + 0.5)::INTEGER AS stability FROM e)
SELECT * REPLACE (CAST(day AS VARCHAR) AS day), (CASE WHEN interval_sec IS NOT NULL THEN (completeness * 4 + (timeliness + validity + stability) * 2 + 5) // 10 ELSE ((timeliness + validity + stability) * 2 + 3) // 6 END)::INTEGER AS score FROM s""",
)
def daily_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = counts(spark, sf_dir).withColumn("interval_sec", F.when(F.col("device_id") % 3 > 0, 21600 * (F.col("device_id") % 3)))
    return quality.daily_score(c, F.col("interval_sec"))


DEFS = [("click", 0.0, 1.0, "NUMBER", False), ("view", 0.0, 0.5, "NUMBER", False), ("purchase", None, None, "TEXT", False), ("error", 0.0, 100000.0, None, True)]


@query(
    "suspect_flags",
    f"""WITH d(metric_key, lo, hi, stuck) AS (VALUES ('click', 0.0::DOUBLE, 1.0::DOUBLE, true), ('view', 0.0, 0.5, true), ('purchase', NULL, NULL, false), ('error', 0.0, 100000.0, false)),
p AS (SELECT t.*, lo, hi, stuck, max(CASE WHEN flags & 1 = 0 THEN time END) OVER (PARTITION BY device_id, t.metric_key ORDER BY received_at, raw_message_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top
  FROM {from_events_sql(5)} t LEFT JOIN d USING (metric_key)),
q AS (SELECT *, (flags & 1 = 0) AND (top IS NULL OR time > top) AS counts FROM p),
r AS (SELECT *, lag(value) OVER w AS prev, lag(time) OVER w AS prev_time FROM q WINDOW w AS (PARTITION BY device_id, metric_key, counts ORDER BY time, raw_message_id)),
s AS (SELECT *, sum(CASE WHEN prev = value THEN 0 ELSE 1 END) OVER (PARTITION BY device_id, metric_key, counts ORDER BY time, raw_message_id ROWS UNBOUNDED PRECEDING) AS island FROM r),
u AS (SELECT *, row_number() OVER (PARTITION BY device_id, metric_key, counts, island ORDER BY time, raw_message_id) AS run FROM s)
SELECT raw_message_id, counts AND (coalesce(stuck AND prev IS NOT NULL AND run >= 12, false) OR coalesce(hi > lo AND abs(value - prev) / greatest(1.0, ((epoch_us(time) // 1000) - (epoch_us(prev_time) // 1000)) / 60000.0::DOUBLE) > (hi - lo) * 0.1875::DOUBLE, false)) AS suspect FROM u""",
)
def suspect_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    defs = spark.createDataFrame(DEFS, "metric_key string, valid_min double, valid_max double, value_type string, state_type boolean")
    return quality.suspects(from_events(spark, sf_dir, 5), defs).select("raw_message_id", "suspect")


@query(
    "clock_skew_mean",
    f"""SELECT raw_message_id, sum(s) OVER w / count(*) OVER w / 1000.0::DOUBLE AS skew_sec FROM (SELECT *, ((epoch_us(time) // 1000) - (epoch_us(received_at) // 1000))::DOUBLE AS s, (epoch_us(received_at) // 1000) AS ms FROM {from_events_sql(5)})
WINDOW w AS (PARTITION BY device_id ORDER BY ms RANGE BETWEEN 3600000 PRECEDING AND CURRENT ROW)""",
)
def clock_skew_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = from_events(spark, sf_dir, 5).withColumn("measured_at", F.col("time"))
    return quality.skew_means(p).select("raw_message_id", "skew_sec")


@query(
    "clock_skew_events",
    f"""WITH RECURSIVE e AS (SELECT device_id, epoch_us(received_at) // 1000 AS ms, ((epoch_us(time) // 1000) - (epoch_us(received_at) // 1000))::DOUBLE AS s FROM {from_events_sql(5)}),
p AS (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY ms) AS n FROM (SELECT device_id, ms, sum(s) OVER w / count(*) OVER w / 1000.0::DOUBLE AS skew FROM e WINDOW w AS (PARTITION BY device_id ORDER BY ms RANGE BETWEEN 3600000 PRECEDING AND CURRENT ROW))),
r AS (SELECT device_id, n, ms, skew, CASE WHEN abs(skew) > 300 THEN ms END AS since, NULL::BIGINT AS began, false AS held, NULL::VARCHAR AS kind FROM p WHERE n = 1
  UNION ALL SELECT p.device_id, p.n, p.ms, p.skew, CASE WHEN abs(p.skew) > 300 THEN coalesce(r.since, p.ms) WHEN r.held AND abs(p.skew) > 120 THEN r.since END, coalesce(r.since, p.ms),
  CASE WHEN abs(p.skew) > 300 THEN r.held OR p.ms >= coalesce(r.since, p.ms) + 1800000 ELSE r.held AND abs(p.skew) > 120 END,
  CASE WHEN abs(p.skew) > 300 AND NOT r.held AND p.ms >= coalesce(r.since, p.ms) + 1800000 THEN 'SUSPECTED' WHEN r.held AND abs(p.skew) <= 120 THEN 'CLEARED' END
  FROM r JOIN p ON p.device_id = r.device_id AND p.n = r.n + 1)
SELECT device_id, kind, make_timestamp(ms * 1000) AS "at", make_timestamp(began * 1000) AS since, round(skew, 1) AS skew_sec FROM r WHERE kind IS NOT NULL""",
)
def clock_skew_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = from_events(spark, sf_dir, 5).withColumn("measured_at", F.col("time"))
    return quality.skew_events(p)


KEYED = "(SELECT raw_message_id AS message_id, organization_id, 'k' || (device_id % 40) || '-' || metric_key AS dedup_key, received_at, device_id, metric_key, time, value, flags FROM " + T + ")"


@query("dedup_10m", f"SELECT message_id, coalesce(epoch_us(received_at) - epoch_us(lag(received_at) OVER (PARTITION BY organization_id, dedup_key ORDER BY received_at, message_id)) <= 600000000, false) AS duplicate FROM {KEYED}")
def dedup_10m(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = from_events(spark, sf_dir).withColumn("message_id", F.col("raw_message_id")).withColumn("dedup_key", F.concat(F.lit("k"), (F.col("device_id") % 40).cast("string"), F.lit("-"), F.col("metric_key")))
    return state.duplicates(p).select("message_id", "duplicate")


@query(
    "on_change_store",
    f"""WITH RECURSIVE p AS (SELECT *, row_number() OVER (PARTITION BY device_id, metric_key ORDER BY received_at, raw_message_id) AS n FROM {from_events_sql(5)}),
r AS (SELECT device_id, metric_key, n, raw_message_id, time, value AS v, time AS latest, time AS stored, true AS kept, true AS change FROM p WHERE n = 1
  UNION ALL SELECT p.device_id, p.metric_key, p.n, p.raw_message_id, p.time, CASE WHEN p.time >= r.latest THEN p.value ELSE r.v END, greatest(p.time, r.latest),
  CASE WHEN (p.time >= r.latest AND p.value <> r.v) OR p.time < r.latest OR p.time - r.stored >= INTERVAL 1 HOUR THEN p.time ELSE r.stored END,
  (p.time >= r.latest AND p.value <> r.v) OR p.time < r.latest OR p.time - r.stored >= INTERVAL 1 HOUR, p.time >= r.latest AND p.value <> r.v
  FROM r JOIN p ON p.device_id = r.device_id AND p.metric_key = r.metric_key AND p.n = r.n + 1)
SELECT r.raw_message_id, CASE WHEN change THEN t.flags | 8 ELSE t.flags END AS flags FROM r JOIN {T} t USING (raw_message_id) WHERE kept""",
)
def on_change_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = from_events(spark, sf_dir, 5)
    return state.stored_on_change(p).select("raw_message_id", "flags")


@query(
    "gaps",
    f"""WITH p AS (SELECT device_id, received_at, max(received_at) OVER (PARTITION BY device_id ORDER BY received_at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM {T})
SELECT DISTINCT device_id, seen AS gap_start, received_at AS gap_end, floor((epoch_us(received_at) - epoch_us(seen)) / 1000000.0::DOUBLE / 14400)::INTEGER AS expected_count FROM p WHERE epoch_us(received_at) - epoch_us(seen) >= 3 * 14400 * 1000000::BIGINT""",
)
def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.gaps(from_events(spark, sf_dir), F.lit(14400))


@query(
    "offline_devices",
    f"SELECT device_id, max(received_at) AS last_seen, CASE WHEN epoch_us(TIMESTAMP '{NOW}') - epoch_us(max(received_at)) > 14400 * 3 * 1000000::BIGINT THEN 'OFFLINE' ELSE 'ONLINE' END AS connectivity FROM {T} WHERE received_at <= TIMESTAMP '{NOW}' GROUP BY device_id",
)
def offline_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = from_events(spark, sf_dir).where(F.col("received_at") <= at(NOW))
    return state.offline(p, at(NOW), F.lit(14400), F.lit(3.0))


@query("latest_state", f"SELECT device_id, metric_key, arg_max(value, (time, received_at, raw_message_id)) AS value, max(time) AS time, arg_max(quality, (time, received_at, raw_message_id)) AS quality FROM {T} GROUP BY ALL")
def latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.latest_values(from_events(spark, sf_dir))


@query("msg_count_24h", f"SELECT device_id, count(*) AS messages_24h FROM {T} WHERE received_at > TIMESTAMP '{NOW}' - INTERVAL 24 HOUR AND received_at <= TIMESTAMP '{NOW}' GROUP BY ALL")
def msg_count_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.messages_last_day(from_events(spark, sf_dir), at(NOW))


@query(
    "quota_first_seen",
    f"""WITH f AS (SELECT organization_id AS source_id, 'dev-' || device_id || '-' || metric_key AS external_id, min(received_at) AS seen_at FROM {from_events_sql(None, 240)} GROUP BY ALL),
n AS (SELECT *, row_number() OVER (PARTITION BY source_id, date_trunc('hour', seen_at) ORDER BY seen_at, external_id) AS n FROM f) SELECT source_id, external_id, seen_at, n <= 30 AS accepted, n = 31 AS alarm FROM n""",
)
def quota_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = from_events(spark, sf_dir, None, 240)
    first = p.groupBy(F.col("organization_id").alias("source_id"), F.concat_ws("-", F.lit("dev"), F.col("device_id").cast("string"), F.col("metric_key")).alias("external_id")).agg(F.min("received_at").alias("seen_at"))
    return state.registrations(first, 30)


@query("lag_level", f"SELECT lag_sec, CASE WHEN lag_sec > 300 THEN 'CRITICAL' WHEN lag_sec > 60 THEN 'WARNING' ELSE 'OK' END AS level FROM (SELECT max((epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(m)) / 1000000.0::DOUBLE) AS lag_sec FROM (SELECT device_id % 4 AS p, max(received_at) AS m FROM {T} GROUP BY 1))")
def lag_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.lag_level(from_events(spark, sf_dir).withColumn("partition", F.col("device_id") % 4), at("2024-02-01 00:00:00"))


FORMULAS = {"a": "view * 1.8 + 32 - click ^ 2", "b": "clamp(max(view, purchase), 5, 100) / (click - 1)", "c": "-(view - 2)^2 % 7", "d": "min(view, error, 50) + abs(purchase - error)"}
WIDE = f"""w AS (SELECT device_id, date_trunc('hour', time) AS time, max(CASE WHEN metric_key = 'view' THEN value END) AS view, max(CASE WHEN metric_key = 'click' THEN value END) AS click,
  max(CASE WHEN metric_key = 'purchase' THEN value END) AS purchase, max(CASE WHEN metric_key = 'error' THEN value END) AS error FROM {from_events_sql(5)} GROUP BY ALL)"""


@query(
    "formula_arithmetic",
    f"""WITH {WIDE}, r AS (SELECT device_id, time, 'a' AS metric_key, view * 1.8::DOUBLE + 32 - pow(click, 2) AS value FROM w
  UNION ALL SELECT device_id, time, 'b', CASE WHEN view IS NOT NULL AND purchase IS NOT NULL AND click <> 1 THEN greatest(5.0::DOUBLE, least(100.0::DOUBLE, greatest(view, purchase))) / (click - 1) END FROM w
  UNION ALL SELECT device_id, time, 'c', (-pow(view - 2, 2)) % 7 FROM w
  UNION ALL SELECT device_id, time, 'd', CASE WHEN view IS NOT NULL AND error IS NOT NULL AND purchase IS NOT NULL THEN least(view, error, 50.0::DOUBLE) + abs(purchase - error) END FROM w)
SELECT * FROM r WHERE value IS NOT NULL""",
)
def formula_arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = from_events(spark, sf_dir, 5).withColumn("time", F.date_trunc("hour", "time"))
    return formula.evaluate(p, FORMULAS)


@query(
    "formula_rolling",
    f"""WITH g AS (SELECT device_id, time, max(value) AS v, bool_or(flags & 1 = 1) AS late FROM {from_events_sql(5)} WHERE metric_key = 'view' GROUP BY ALL),
x AS (SELECT a.device_id, a.time, a.v::DECIMAL(18,6) AS v, b.v::DECIMAL(18,6) AS w FROM g a LEFT JOIN g b ON NOT a.late AND NOT b.late AND a.device_id = b.device_id AND b.time >= a.time - INTERVAL 6 HOUR AND b.time < a.time),
y AS (SELECT device_id, time, v, v + coalesce(sum(w), 0) AS total, 1 + count(w) AS n, least(v, min(w)) AS low, greatest(v, max(w)) AS high FROM x GROUP BY device_id, time, v)
SELECT device_id, time, unnest(['mean', 'sum', 'count', 'low', 'high']) AS metric_key, unnest([total::DOUBLE / n, total::DOUBLE, n::DOUBLE, low::DOUBLE, high::DOUBLE]) AS value FROM y""",
)
def formula_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"mean": "rolling_mean", "sum": "rolling_sum", "count": "rolling_count", "low": "rolling_min", "high": "rolling_max"}
    return formula.evaluate(from_events(spark, sf_dir, 5), {k: f"{f}(view, 6h)" for k, f in names.items()})


@query(
    "recent_window_values",
    f"""SELECT raw_message_id, list(value) FILTER (flags & 1 = 0) OVER w AS recent FROM {from_events_sql(5)} WINDOW w AS (PARTITION BY device_id, metric_key ORDER BY epoch_us(time) RANGE BETWEEN 21600000000 PRECEDING AND 1 PRECEDING)""",
)
def recent_window_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values that a script's window(key, 6h) sees at each point; all of them, as the SQL has no most."""
    out = state.window_values(from_events(spark, sf_dir, 5), 6 * 3600, None)
    return out.select("raw_message_id", F.when(F.size("recent") > 0, F.col("recent")).alias("recent"))


@query(
    "connectivity_events",
    f"""WITH p AS (SELECT device_id, received_at, max(received_at) OVER (PARTITION BY device_id ORDER BY received_at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM {T}),
b AS (SELECT * FROM p WHERE seen IS NULL OR epoch_us(received_at) - epoch_us(seen) > 43200000000)
SELECT DISTINCT device_id, 'ONLINE' AS kind, received_at AS "at" FROM b UNION SELECT DISTINCT device_id, 'OFFLINE', seen + INTERVAL 12 HOUR FROM b WHERE seen IS NOT NULL""",
)
def connectivity_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.connectivity_events(from_events(spark, sf_dir), F.lit(14400), F.lit(3.0))


@query(
    "uplink_signals",
    f"""SELECT device_id, raw_message_id AS message_id, CASE WHEN raw_message_id % 4 > 0 THEN raw_message_id ELSE epoch_us(received_at) // 1000 END AS version FROM {T}
WHERE device_id % 9 > 0 AND raw_message_id % 8 <> 1 AND CASE raw_message_id % 3 WHEN 0 THEN true WHEN 1 THEN false ELSE device_id % 2 = 0 END""",
)
def uplink_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, i = from_events(spark, sf_dir), F.col("raw_message_id")
    topic = F.when(i % 3 == 0, "application/a/device/1/event/up").when(i % 3 == 1, "application/a/device/1/event/join").otherwise("plain/topic")
    rows = p.select("device_id", i.alias("message_id"), topic.alias("topic"), F.when(F.col("device_id") % 2 == 0, "chirpstack-v4").otherwise("single-value").alias("decoder"), F.when(F.col("device_id") % 9 > 0, "ACTIVE").otherwise("DISABLED").alias("status"), (i % 8 == 1).alias("virtual"), F.when(i % 4 > 0, i).alias("frame_counter"), "received_at")
    return state.uplink_signals(rows)
