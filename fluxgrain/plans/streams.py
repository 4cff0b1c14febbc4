"""Queries on state that outlives micro-batches: the events in several batches give what SQL says of them as a whole."""

from __future__ import annotations

import datetime
import functools
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxgrain.operators import contexts, maintenance, quality, scripts, state
from fluxgrain.plans import rollups, tables
from fluxgrain.plans.checks import at
from fluxgrain.plans.register import registry
from fluxgrain.sources import segments, store
from fluxgrain.sources.telemetry import from_events, from_events_sql
from fluxgrain.streaming import aggregation, series

QUERIES, ORACLES, query = registry()
DEFS = [("click", 0.0, 1.0, "NUMBER", False), ("view", 0.0, 0.5, None, False), ("purchase", None, None, "TEXT", False), ("error", 0.0, 100000.0, "NUMBER", True)]
BOUNDS = ("2000-01-01", "2024-01-07", "2024-01-13", "2024-01-19", "2024-01-25", "2100-01-01")


def in_batches(p: DataFrame, to: str) -> Iterator[str]:
    """p in five folders, one after the other, by received time to the hour; of the hour at a bound one half of the ids goes before it and one after, so that bounds fall between ties."""
    half = F.lit(p.agg(F.max("raw_message_id")).first()[0] // 2)
    came = F.col("received_at")
    over = [F.coalesce((came > at(b)) | ((came == at(b)) & (F.col("raw_message_id") > half)), F.lit(False)).cast("int") for b in BOUNDS]
    number = functools.reduce(lambda a, b: a + b, over) - 1
    return store.folders(p, F.when(came.isNotNull(), number), len(BOUNDS) - 1, to)


def hourly(p: DataFrame) -> DataFrame:
    """Received times to the hour, so that many are equal."""
    return p.withColumn("received_at", F.date_trunc("hour", "received_at"))


HOURLY = f"(SELECT * REPLACE (date_trunc('hour', received_at) AS received_at) FROM {from_events_sql(5)})"


@query(
    "series_over_batches",
    f"""WITH RECURSIVE d(metric_key, lo, hi, stuck) AS (VALUES ('click', 0.0::DOUBLE, 1.0::DOUBLE, true), ('view', 0.0, 0.5, true), ('purchase', NULL, NULL, false), ('error', 0.0, 100000.0, false)),
p AS (SELECT t.*, lo, hi, coalesce(stuck, false) AS stuck, flags & 1 = 0 AS on_time, epoch_us(time) AS us, row_number() OVER (PARTITION BY device_id, t.metric_key ORDER BY received_at, raw_message_id) AS n FROM {HOURLY} t LEFT JOIN d USING (metric_key)),
r AS (SELECT device_id, metric_key, n, raw_message_id, CASE WHEN on_time THEN value END AS v, CASE WHEN on_time THEN us END AS at, 1 AS run, false AS suspect, value AS latest, us AS latest_us, us AS stored, true AS kept, true AS changed FROM p WHERE n = 1
  UNION ALL SELECT p.device_id, p.metric_key, p.n, p.raw_message_id, CASE WHEN p.on_time AND p.us > coalesce(r.at, -1) THEN p.value ELSE r.v END, CASE WHEN p.on_time AND p.us > coalesce(r.at, -1) THEN p.us ELSE r.at END,
  CASE WHEN p.on_time AND p.us > coalesce(r.at, -1) THEN CASE WHEN p.value = r.v THEN r.run + 1 ELSE 1 END ELSE r.run END,
  p.on_time AND r.at IS NOT NULL AND p.us > r.at AND ((p.stuck AND p.value = r.v AND r.run + 1 >= 12) OR coalesce(p.hi > p.lo AND abs(p.value - r.v) / greatest(1.0, (p.us // 1000 - r.at // 1000) / 60000.0::DOUBLE) > (p.hi - p.lo) * 0.1875::DOUBLE, false)),
  CASE WHEN p.us >= r.latest_us THEN p.value ELSE r.latest END, greatest(p.us, r.latest_us),
  CASE WHEN (p.us >= r.latest_us AND p.value <> r.latest) OR p.us < r.latest_us OR p.us - r.stored >= 3600000000 THEN p.us ELSE r.stored END,
  (p.us >= r.latest_us AND p.value <> r.latest) OR p.us < r.latest_us OR p.us - r.stored >= 3600000000, p.us >= r.latest_us AND p.value <> r.latest
  FROM r JOIN p ON p.device_id = r.device_id AND p.metric_key = r.metric_key AND p.n = r.n + 1)
SELECT raw_message_id, CASE WHEN suspect AND t.quality NOT IN (1, 4, 5) THEN 3 ELSE t.quality END AS quality, CASE WHEN metric_key IN ('click', 'view') AND changed THEN t.flags | 8 ELSE t.flags END AS flags, suspect, kept OR metric_key NOT IN ('click', 'view') AS kept
FROM r JOIN {HOURLY} t USING (raw_message_id, device_id, metric_key)""",
)
def series_over_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stuck values, jumps and storage on change over five micro-batches, with ties at their bounds."""
    base = store.scratch(spark, "series")
    defs = spark.createDataFrame(DEFS, "metric_key string, valid_min double, valid_max double, value_type string, state_type boolean")
    on_change = spark.createDataFrame([(o, m) for o in range(3) for m in ("click", "view")], "organization_id bigint, metric_key string")
    for _ in in_batches(hourly(from_events(spark, sf_dir, 5)), f"{base}/points"):  # what is new is one micro-batch
        series.run_judged(spark, base, defs, on_change).awaitTermination()
    return spark.read.parquet(f"{base}/judged").select("raw_message_id", "quality", "flags", "suspect", "kept")


T = from_events_sql()


@query(
    "silence_timers",
    f"""WITH p AS (SELECT device_id, received_at, max(received_at) OVER (PARTITION BY device_id ORDER BY received_at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM {T}),
b AS (SELECT * FROM p WHERE seen IS NULL OR epoch_us(received_at) - epoch_us(seen) > 43200000000), l AS (SELECT device_id, max(received_at) AS seen FROM {T} GROUP BY 1)
SELECT DISTINCT device_id, 'ONLINE' AS kind, received_at AS "at" FROM b UNION SELECT DISTINCT device_id, 'OFFLINE', seen + INTERVAL 12 HOUR FROM b WHERE seen IS NOT NULL
UNION SELECT device_id, 'OFFLINE', seen + INTERVAL 12 HOUR FROM l WHERE epoch_us(seen) // 1000 + 43200001 <= (SELECT epoch_us(max(received_at)) // 1000 - 60000 FROM {T})""",
)
def silence_timers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Devices that go silent and come back, by timers over five micro-batches; those still silent at the end too."""
    base, p = store.scratch(spark, "silence"), from_events(spark, sf_dir).select("device_id", "received_at", "raw_message_id")
    for _ in in_batches(p, f"{base}/in"):  # what is new is one micro-batch
        source = spark.readStream.schema("device_id bigint, received_at timestamp").parquet(f"{base}/in").drop("batch")
        series.run_keyed(series.silences(source, F.lit(14400), F.lit(3.0)), f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("device_id", "kind", "at")


SLOW, PURGES = from_events_sql(None, 0.25), [(0, "ORG", None, 0), (0, "METRIC", "view", 5), (1, "ORG", None, 40), (1, "METRIC", "click", 100), (1, "MODEL", "m-1", 10), (2, "ORG", None, 40)]
AGE = lambda days: f"time < TIMESTAMP '2024-05-01' - INTERVAL {days} DAY"
GONE = f"""CASE organization_id WHEN 0 THEN false WHEN 2 THEN time < TIMESTAMP '2024-02-01' ELSE (device_id % 4 = 1 AND {AGE(10)}) OR CASE metric_key WHEN 'click' THEN {AGE(100)} ELSE time < TIMESTAMP '2024-03-01' END END"""


def purged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Four months of points: one organisation keeps all, two archive; of the last one's archive a month is lost before it is checked."""
    p, base = from_events(spark, sf_dir, None, 0.25), store.scratch(spark, "purge")
    policies = spark.createDataFrame(PURGES, "organization_id bigint, scope string, scope_ref string, retain_days int")
    now, models = at("2024-05-01 00:00:00"), tables.models(p)
    rows = maintenance.retention_days(p, policies, models)
    own = rows.where("organization_id > 0").where(~F.coalesce(F.col("metric_days") > F.col("org_days"), F.lit(False)) & ~F.coalesce((F.col("model_days") < F.col("org_days")) & (F.col("time") < now - F.make_dt_interval(days="model_days")), F.lit(False)))

    def lose(folder: str) -> None:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_organization=2/month=2024-02")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    manifest = store.archive_months(own.select(*p.columns), f"{base}/rows", f"{base}/registry", now - F.expr("interval 40 days"), written=lose)
    return maintenance.purge(p, policies, now, models, manifest, spark.createDataFrame([(1,), (2,)], "organization_id bigint"))


@query("retention_purge", f"SELECT {tables.KEEP} FROM {SLOW} WHERE NOT {GONE}")
def retention_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays: all of who keeps for ever; of who archives what the manifest does not hold, and all later months."""
    return purged(spark, sf_dir)[0]


@query("retention_purged", f"""SELECT organization_id, CASE WHEN organization_id = 1 AND ((device_id % 4 = 1 AND {AGE(10)}) OR metric_key = 'click') THEN 'OVERRIDE' ELSE 'ORG' END AS "by", count(*) AS n_rows, NOT (organization_id = 1 AND ((device_id % 4 = 1 AND {AGE(10)}) OR metric_key = 'click')) AS archived FROM {SLOW} WHERE {GONE} GROUP BY ALL""")
def retention_purged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of the deletion: rows by organisation and by what deleted them."""
    return purged(spark, sf_dir)[1]


DEVICE_ROWS = f"""(SELECT device_id, organization_id, raw_message_id AS id, received_at, time AS measured_at, metric_key, value, CASE WHEN raw_message_id % 3 = 0 THEN value END AS battery, CASE WHEN raw_message_id % 4 > 0 THEN -60.0::DOUBLE - raw_message_id % 50 END AS rssi,
  CASE WHEN raw_message_id % 5 = 0 THEN 7.5::DOUBLE END AS snr, CASE WHEN raw_message_id % 4 > 0 THEN 'gw-' || raw_message_id % 6 END AS gateway, CASE WHEN raw_message_id % 7 = 0 THEN 'Asia/Seoul' WHEN raw_message_id % 11 = 0 THEN 'UTC' END AS timezone FROM {T})"""


def device_rows(p: DataFrame) -> DataFrame:
    i = F.col("raw_message_id")
    return p.select(
        "device_id", "organization_id", i.alias("id"), "received_at", F.col("time").alias("measured_at"), F.map_from_arrays(F.array("metric_key"), F.array("value")).alias("latest"), F.when(i % 3 == 0, F.col("value")).alias("battery"),
        F.when(i % 4 > 0, -60.0 - i % 50).alias("rssi"), F.when(i % 5 == 0, F.lit(7.5)).alias("snr"), F.when(i % 4 > 0, F.concat(F.lit("gw-"), (i % 6).cast("string"))).alias("gateway"), F.when(i % 7 == 0, "Asia/Seoul").when(i % 11 == 0, "UTC").alias("timezone"),
    )


@query(
    "device_state_merge",
    f"""WITH r AS (SELECT *, coalesce(measured_at >= max(measured_at) OVER (PARTITION BY device_id ORDER BY received_at, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS newest FROM {DEVICE_ROWS}),
k AS (SELECT device_id, string_agg(metric_key || '=' || round(value, 3)::DECIMAL(18,3), ',' ORDER BY metric_key) AS latest FROM (SELECT device_id, metric_key, arg_max(value, (measured_at, received_at, id)) AS value FROM r WHERE newest GROUP BY 1, 2) GROUP BY 1),
s AS (SELECT device_id, max(received_at) AS last_seen_at, max(measured_at) AS last_measured_at, {", ".join(f"arg_max({c}, (measured_at, received_at, id)) FILTER (newest AND {c} IS NOT NULL) AS {c}" for c in ("battery", "rssi", "snr", "gateway"))}, arg_max(timezone, (received_at, id)) FILTER (timezone IS NOT NULL) AS timezone FROM r GROUP BY 1)
SELECT device_id, last_seen_at, last_measured_at, latest, battery, rssi, snr, gateway, timezone FROM s JOIN k USING (device_id)""",
)
def device_state_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device states of messages out of order, merged in three parts, each upon the one before."""
    rows, held = device_rows(from_events(spark, sf_dir)), None
    for low, high in (("2000-01-01", "2024-01-09"), ("2024-01-09", "2024-01-20"), ("2024-01-20", "2100-01-01")):
        held = store.written(state.device_states(rows.where((F.col("received_at") >= at(low)) & (F.col("received_at") < at(high))), held))
    out = held.withColumn("latest", F.array_join(F.transform(F.map_entries("latest"), lambda e: F.concat(e["key"], F.lit("="), F.round(e["value"], 3).cast("decimal(18,3)").cast("string"))), ","))
    return out.select("device_id", "last_seen_at", "last_measured_at", "latest", "battery", "rssi", "snr", "gateway", "timezone")


@query("gateways_seen", f"SELECT organization_id, gateway AS gateway_eui, max(measured_at) AS last_seen_at FROM {DEVICE_ROWS} WHERE gateway IS NOT NULL GROUP BY ALL")
def gateways_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.gateways_last_seen(device_rows(from_events(spark, sf_dir)).select("organization_id", F.col("gateway").alias("gateway_eui"), F.col("measured_at").alias("time")))


@query(
    "message_counts_changed",
    f"""WITH c AS (SELECT device_id, count(*) FILTER (raw_message_id % 5 > 1 AND received_at > TIMESTAMP '2024-01-14' AND received_at <= TIMESTAMP '2024-01-15') AS before, count(*) FILTER (raw_message_id % 5 > 1 AND received_at > TIMESTAMP '2024-01-15' AND received_at <= TIMESTAMP '2024-01-16') AS n FROM {T} GROUP BY 1)
SELECT device_id, n AS messages_24h FROM c WHERE n <> before""",
)
def message_counts_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Devices whose number of good messages in 24 hours is another one than the day before."""
    p = from_events(spark, sf_dir).withColumn("status", F.when(F.col("raw_message_id") % 5 > 1, "OK").otherwise("INVALID"))
    none = p.select("device_id").distinct().withColumn("messages_24h", F.lit(None).cast("bigint"))
    yesterday = state.changed_counts(p, none, at("2024-01-15 00:00:00"))
    return state.changed_counts(p, yesterday, at("2024-01-16 00:00:00"))


LINES = "(SELECT metric_key AS script_id, device_id % 3 AS version, date_trunc('minute', time) + to_seconds((raw_message_id % 2)::INTEGER) AS \"at\", raw_message_id AS id, value AS elapsed_ms FROM " + from_events_sql(None, 2400) + ")"


@query(
    "script_stats_bounded",
    f"""WITH r AS (SELECT *, date_trunc('minute', "at") AS bucket, row_number() OVER (PARTITION BY script_id, version, date_trunc('minute', "at") ORDER BY "at", elapsed_ms) <= 8 AS sample, row_number() OVER (PARTITION BY script_id, "at" ORDER BY id) > 10 AS lost FROM {LINES})
SELECT script_id, version, bucket, count(*) AS processed, quantile_disc(elapsed_ms, 0.95) FILTER (sample) AS p95_ms, count(*) FILTER (lost) AS logs_dropped FROM r GROUP BY ALL""",
)
def script_stats_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of a minute's first eight runs only, and lines beyond ten a second, where minutes hold many."""
    p = from_events(spark, sf_dir, None, 2400)
    second = F.date_trunc("minute", "time") + F.make_dt_interval(secs=F.col("raw_message_id") % 2)
    rows = p.select(F.col("metric_key").alias("script_id"), (F.col("device_id") % 3).alias("version"), second.alias("at"), F.col("raw_message_id").alias("id"), F.col("value").alias("elapsed_ms"))
    runs = rows.withColumnRenamed("at", "run_at").withColumns({"failed": F.lit(False), "timed_out": F.lit(False), "input_bytes": F.lit(0)})
    return scripts.minute_stats(runs, rows, samples=8).select("script_id", "version", "bucket", "processed", "p95_ms", "logs_dropped")


@query("rollup_1m_advancing", f"WITH {rollups.MINUTES} SELECT * FROM m1")
def rollup_1m_advancing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of the minutes, rolled up by four runs of which each sees what has been received by then, in chunks of half an hour."""
    base, p = store.scratch(spark, "advancing"), store.written(rollups.unique_points(spark, sf_dir))
    for now in ((1, 0, 45), (2, 10, 10), (2, 10, 40), (5, 0, 0)):
        t = datetime.datetime(2024, 1, 1, *now)
        aggregation.advance(p.where(F.col("received_at") <= F.lit(t)), base, t, datetime.timedelta(minutes=30), state_keys=rollups.STATES)
    return aggregation.minutes(spark, base)


LOOKING = f"(SELECT raw_message_id AS id, device_id, metric_key, time, received_at, coalesce(value, 0) AS value, time <= received_at - INTERVAL 1 HOUR AS late, device_id = 1 AND raw_message_id % 7 = 0 AS failed FROM {from_events_sql(20, 30)})"


def doubled(message: dict, context: dict) -> dict:
    """Twice each value, with the one before it and what the hour before says."""
    out = []
    for m in message["metrics"]:
        hour, was = context["window"](m["key"], "1h"), context["last"].get(m["key"])
        out += [{"key": m["key"], "value": m["value"] * 2}, {"key": "n", "value": len(hour)}]
        out += [{"key": "top", "value": max(hour)}] if hour else []
        out += [{"key": "was", "value": was["value"]}] if was else []
    return {**message, "metrics": out}


def scaled(message: dict, context: dict) -> dict:
    """A metric by the step's factor, for one model's devices; fails for device 1, whose messages then stay as they were."""
    if context["device"]["id"] == 1:
        raise ValueError("not this one")
    return {**message, "metrics": [*message["metrics"], {"key": "scaled", "value": message["metrics"][0]["value"] * context["config"]["factor"]}]}


def seventh(message: dict, context: dict) -> dict:
    if message["messageId"] % 7 == 0:
        raise ValueError("refused")
    return message


@query(
    "transform_contexts",
    f"""WITH p AS (SELECT *, max(time) FILTER (NOT failed) OVER (PARTITION BY device_id ORDER BY received_at, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest, max(epoch_ms(time)) FILTER (NOT late AND NOT failed) OVER (PARTITION BY device_id, metric_key ORDER BY received_at, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM {LOOKING}),
q AS (SELECT *, NOT late AND NOT failed AND coalesce(epoch_ms(time) > seen, true) AS taken FROM p),
r AS (SELECT *, last_value(CASE WHEN NOT failed AND coalesce(time >= newest, true) THEN value * 2 END IGNORE NULLS) OVER w AS was, coalesce(sum(taken::INT) OVER w, 0) AS n_taken FROM q WINDOW w AS (PARTITION BY device_id, metric_key ORDER BY received_at, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
h AS (SELECT a.id, count(*) AS n, max(b.value * 2) AS top FROM r a JOIN r b ON a.device_id = b.device_id AND a.metric_key = b.metric_key AND b.taken AND b.n_taken < a.n_taken AND b.n_taken >= a.n_taken - 1440 AND epoch_ms(b.time) < epoch_ms(a.time) AND epoch_ms(b.time) >= epoch_ms(a.time) - 3600000 WHERE NOT a.late GROUP BY 1)
SELECT r.id, metric_key, value * 2 AS value, was, coalesce(n, 0) AS n, top, CASE WHEN device_id % 3 = 1 AND device_id <> 1 THEN value * 20 END AS scaled, failed FROM r LEFT JOIN h ON r.id = h.id""",
)
def transform_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Functions that look back on what functions made of their device's earlier messages: the last value, an hour's values, a step for one model and one that fails. Milliseconds are rounded, as epoch_ms() of the SQL does."""
    p = from_events(spark, sf_dir, 20, 30)
    metric = F.struct(F.col("metric_key").alias("key"), F.coalesce("value", F.lit(0.0)).alias("value"))
    rows = p.select(
        "device_id", "metric_key", F.col("raw_message_id").alias("id"), "time", "received_at", quality.is_late(F.col("time"), F.col("received_at")).alias("late"),
        F.to_json(F.struct(F.col("device_id").alias("id"), (F.col("device_id") % 3).alias("modelId"))).alias("device"), F.to_json(F.struct(F.col("raw_message_id").alias("messageId"), F.array(metric).alias("metrics"))).alias("message"),
    )
    steps = [contexts.Step(doubled), contexts.Step(scaled, config={"factor": 10}, model_id=1), contexts.Step(seventh, "FAIL_CLOSED", device_id=1)]
    out = contexts.with_past(rows, steps, whole=contexts.rounded).withColumn("_m", F.from_json(F.get_json_object("message", "$.metrics"), "array<struct<key:string,value:double>>"))
    of = lambda key: F.try_element_at(F.map_from_arrays("_m.key", "_m.value"), key)
    return out.select("id", "metric_key", of(F.col("metric_key")).alias("value"), of(F.lit("was")).alias("was"), of(F.lit("n")).cast("bigint").alias("n"), of(F.lit("top")).alias("top"), of(F.lit("scaled")).alias("scaled"), F.col("script_error").isNotNull().alias("failed"))


@query(
    "log_resumed",
    f"""SELECT coalesce(device_id % 4, 0)::INTEGER AS "partition", row_number() OVER (PARTITION BY device_id % 4 ORDER BY received_at >= TIMESTAMP '2024-01-09', received_at >= TIMESTAMP '2024-01-20', received_at, raw_message_id) - 1 AS "offset", raw_message_id, metric_key, value,
  1 + (received_at >= TIMESTAMP '2024-01-09')::INTEGER + (received_at >= TIMESTAMP '2024-01-20')::INTEGER AS run FROM {T}""",
)
def log_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of four partitions that grows three times; a stream that is stopped after each time goes on after the last offset."""
    spark.dataSource.register(segments.Segments)
    base, p = store.scratch(spark, "log"), from_events(spark, sf_dir)
    for run, (low, high) in enumerate((("2000-01-01", "2024-01-09"), ("2024-01-09", "2024-01-20"), ("2024-01-20", "2100-01-01")), 1):
        rows = p.where((F.col("received_at") >= at(low)) & (F.col("received_at") < at(high)))
        segments.append(rows, f"{base}/log", F.col("device_id") % 4, ("received_at", "raw_message_id"), 1000)
        source = spark.readStream.format("segments").schema("partition int, offset bigint, raw_message_id bigint, metric_key string, value double").option("rowsPerTask", 700).load(f"{base}/log")
        out = source.withColumn("run", F.lit(run)).writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True)
        out.start(f"{base}/out").awaitTermination()
    return spark.read.parquet(f"{base}/out")
