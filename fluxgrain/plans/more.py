"""Queries on scans, ids, links, signatures, contracts, archives, confirmed scores, replayed streams and the functions of formulas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxgrain.functions import formula, scalars
from fluxgrain.operators import decode, maintenance, metrics, quality, rollup, scans, scripts, state
from fluxgrain.plans import checks, messages, tables
from fluxgrain.plans.register import registry
from fluxgrain.sources import store
from fluxgrain.sources.telemetry import from_events, from_events_sql
from fluxgrain.streaming import ingest

QUERIES, ORACLES, query = registry()
T = from_events_sql()
at = tables.at


@query("points_between", f"SELECT metric_key, time, value FROM {T} WHERE organization_id = 1 AND device_id = 4 AND metric_key IN ('view', 'click') AND time >= TIMESTAMP '2024-01-03 00:00:00' AND time < TIMESTAMP '2024-01-28 00:00:00' ORDER BY time, metric_key LIMIT 20000")
def points_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.points_between(from_events(spark, sf_dir), 1, 4, ["view", "click"], at("2024-01-03 00:00:00"), at("2024-01-28 00:00:00"))


@query("recent_values", f"SELECT metric_key, time, value FROM {from_events_sql(5)} WHERE device_id = 2 AND time >= TIMESTAMP '2024-01-20 00:00:00' AND flags & 1 = 0")
def recent_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.recent_values(from_events(spark, sf_dir, 5), 2, at("2024-01-20 00:00:00"))


@query(
    "last_known",
    f"""WITH p AS (SELECT * FROM {from_events_sql(5)}), k AS (SELECT DISTINCT device_id, metric_key FROM p),
f AS (SELECT m.raw_message_id AS message_id, m.metric_key AS own, k.metric_key, m.device_id, m.received_at FROM p m JOIN k USING (device_id)),
u AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY device_id, metric_key, received_at ORDER BY raw_message_id DESC) = 1)
SELECT f.message_id, f.metric_key, u.value, u.time FROM f ASOF JOIN u ON f.device_id = u.device_id AND f.metric_key = u.metric_key AND f.received_at > u.received_at""",
)
def last_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each message's device had last sent of each metric before it."""
    p = from_events(spark, sf_dir, 5)
    out = scans.last_known(p.select(F.col("raw_message_id").alias("message_id"), "device_id", "received_at"), p)
    return out.select("message_id", F.explode("last").alias("metric_key", "v")).select("message_id", "metric_key", "v.value", "v.time")


@query("earliest", f"SELECT min(time) AS earliest FROM {T} WHERE time >= TIMESTAMP '2024-01-09 00:00:00'")
def earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.earliest(from_events(spark, sf_dir), at("2024-01-09 00:00:00"))


@query("organizations", f"SELECT DISTINCT organization_id FROM {T} UNION SELECT unnest([0, 1, 2])")
def organizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.organizations(from_events(spark, sf_dir), tables.policies(spark))


@query("oldest_dirty", f"SELECT raw_message_id AS id, received_at AS created_at FROM {T} ORDER BY received_at, raw_message_id LIMIT 500")
def oldest_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.oldest(from_events(spark, sf_dir).select(F.col("raw_message_id").alias("id"), F.col("received_at").alias("created_at")))


@query("minute_chunks", f"WITH e AS (SELECT raw_message_id, date_trunc('hour', time) AS a, date_trunc('minute', received_at + INTERVAL 9 HOUR - INTERVAL 30 SECOND) AS b FROM {T}), s AS (SELECT *, unnest(generate_series(a, b - INTERVAL 1 MICROSECOND, INTERVAL 6 HOUR)) AS from_time FROM e WHERE a < b) SELECT raw_message_id, from_time, least(from_time + INTERVAL 6 HOUR, b) AS to_time FROM s")
def minute_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backlogs of minutes in chunks of six hours, up to the minute that is closed."""
    p = from_events(spark, sf_dir).select("raw_message_id", F.date_trunc("hour", "time").alias("a"), rollup.closed_until(F.col("received_at") + F.expr("interval 9 hours")).alias("b"))
    return p.select("raw_message_id", F.inline(rollup.chunks(F.col("a"), F.col("b"))))


LINKS = f"""WITH u AS (SELECT *, raw_message_id % 50 AS k FROM {T}), g AS (SELECT device_id, time, organization_id, raw_message_id, unnest(['gw-a', 'gw-b']) AS gateway_eui, unnest([-90 - k, -60 - k])::DOUBLE AS rssi FROM u WHERE raw_message_id % 10 > 0
UNION ALL SELECT device_id, time, organization_id, raw_message_id, '', -60 - k FROM u WHERE raw_message_id % 10 = 0)
SELECT device_id, gateway_eui, time, organization_id, rssi, 7.5::DOUBLE AS snr, raw_message_id AS frame_counter FROM g QUALIFY row_number() OVER (PARTITION BY device_id, gateway_eui, time ORDER BY raw_message_id) = 1"""


@query("link_quality", LINKS)
def link_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per gateway of each uplink; of a tenth of them the gateways are unknown."""
    out = decode.lorawan(store.written(messages.uplink(from_events(spark, sf_dir))))
    link = F.when(F.col("id") % 10 == 0, F.col("link").withField("gateways", F.lit(None).cast("array<struct<eui:string,rssi:double,snr:double>>"))).otherwise(F.col("link"))
    rows = out.select("id", F.conv("external_id", 16, 10).cast("bigint").alias("device_id"), F.col("measured_at").alias("time"), "organization_id", link.alias("link"))
    return metrics.link_rows(rows)


SIGNED = f"(SELECT raw_message_id, CASE WHEN raw_message_id % 5 > 0 THEN 'PLATFORM_BROKER' ELSE 'WEBHOOK' END AS source_type, CASE raw_message_id % 4 WHEN 0 THEN 'VERIFIED' WHEN 1 THEN 'INVALID' WHEN 2 THEN 'UNSIGNED' END AS signature, CASE device_id % 3 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'PENDING' END AS status FROM {T})"


@query(
    "signature_gate",
    f"""SELECT raw_message_id, CASE WHEN source_type = 'PLATFORM_BROKER' AND (signature IS NOT DISTINCT FROM 'INVALID' OR (status = 'ACTIVE' AND signature IS DISTINCT FROM 'VERIFIED')) THEN 'ING_SIGNATURE_INVALID' END AS live,
  CASE WHEN source_type = 'PLATFORM_BROKER' AND signature IS NOT DISTINCT FROM 'INVALID' THEN 'ING_SIGNATURE_INVALID' END AS again, source_type = 'PLATFORM_BROKER' AND status IS NOT DISTINCT FROM 'PENDING' AS quarantine,
  source_type = 'PLATFORM_BROKER' AND (status IS NOT DISTINCT FROM 'PENDING' OR signature IS DISTINCT FROM 'VERIFIED') AS quarantine_again FROM {SIGNED}""",
)
def signature_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, d = F.col("raw_message_id"), F.col("device_id")
    signature = F.when(i % 4 == 0, "VERIFIED").when(i % 4 == 1, "INVALID").when(i % 4 == 2, "UNSIGNED")
    p = from_events(spark, sf_dir).select(i, F.when(i % 5 > 0, "PLATFORM_BROKER").otherwise("WEBHOOK").alias("s"), signature.alias("g"), F.when(d % 3 == 0, "ACTIVE").when(d % 3 == 1, "PENDING").alias("t"))
    own = (F.col("s"), F.col("g"), F.col("t"))
    return p.select(i, metrics.signature_error(*own).alias("live"), metrics.signature_error(*own, False).alias("again"), metrics.quarantined(*own).alias("quarantine"), metrics.quarantined(*own, False).alias("quarantine_again"))


@query("forecast_quality", f"SELECT raw_message_id, CASE WHEN raw_message_id % 3 = 0 AND raw_message_id % 2 = 0 THEN 5 WHEN value > 100 THEN 1 ELSE 0 END AS code FROM {T}")
def forecast_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, no = F.col("raw_message_id"), F.lit(False)
    future = metrics.forecast(F.when(i % 3 == 0, "KMA_WEATHER").otherwise("WEBHOOK"), F.when(i % 2 == 0, "kma/forecast/1").otherwise("kma/observed/1"))
    return from_events(spark, sf_dir).select(i, quality.quality_code(future, no, quality.out_of_range(F.col("value"), F.lit(None).cast("double"), F.lit(100.0)), no, no).alias("code"))


@query(
    "canonical_messages",
    f"""WITH h AS (SELECT *, md5('telemetry:' || organization_id || ':' || raw_message_id) AS h FROM {T})
SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-3' || substr(h, 14, 3) || '-' || substr('89ab', ((strpos('0123456789abcdef', substr(h, 17, 1)) - 1) % 4 + 1)::INTEGER, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS telemetry_id, raw_message_id AS message_id, device_id, time AS measured_at, received_at, flags & 1 = 1 AS late, false AS virtual,
  2 AS n_metrics, metric_key AS key, NOT (device_id % 2 = 0) AS plain FROM h""",
)
def canonical_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of an own and a derived metric in their outgoing form, sent twice to a sink that keeps each once."""
    p = from_events(spark, sf_dir).withColumn("message_id", F.col("raw_message_id"))
    second = p.withColumns({"metric_key": F.lit("zz"), "flags": F.when(F.col("device_id") % 2 == 0, F.col("flags").bitwiseOR(16)).otherwise(F.col("flags")).cast("smallint")})
    sent, path = store.written(metrics.canonical(p.unionByName(second))), store.scratch(spark, "sink")
    for _ in range(2):
        store.append_new(sent, path, "telemetry_id")
    m = F.from_json("metrics", "array<struct<key:string,value:double,quality:int,derived:boolean>>")
    out = spark.read.parquet(path).withColumn("m", m)
    return out.select("telemetry_id", "message_id", "device_id", "measured_at", "received_at", "late", "virtual", F.size("m").alias("n_metrics"), F.get("m", F.lit(0))["key"].alias("key"), F.get("m", F.lit(1))["derived"].isNull().alias("plain"))


@query(
    "derived_ids",
    f"""WITH t AS (SELECT raw_message_id, 'derived:' || device_id || ':' || CASE WHEN epoch_us(time) // 1000 % 1000 = 0 THEN strftime(time, '%Y-%m-%dT%H:%M:%SZ') ELSE strftime(time, '%Y-%m-%dT%H:%M:%S.%gZ') END || ':' || least(metric_key, 'power') || ',' || greatest(metric_key, 'power') AS name FROM {T}), h AS (SELECT raw_message_id, md5(name) AS h FROM t)
SELECT raw_message_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-3' || substr(h, 14, 3) || '-' || substr('89ab', ((strpos('0123456789abcdef', substr(h, 17, 1)) - 1) % 4 + 1)::INTEGER, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS id FROM h""",
)
def derived_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_events(spark, sf_dir).select("raw_message_id", scalars.derived_id(F.col("device_id"), F.date_trunc("millisecond", "time"), F.array(F.lit("power"), F.col("metric_key"), F.lit("power"))).alias("id"))


@query(
    "script_contract",
    f"""SELECT raw_message_id, CASE raw_message_id % 7 WHEN 0 THEN 'SCRIPT_OUTPUT_INVALID: not an object' WHEN 1 THEN 'SCRIPT_OUTPUT_INVALID: externalId' WHEN 2 THEN 'SCRIPT_OUTPUT_INVALID: metrics' WHEN 3 THEN 'SCRIPT_OUTPUT_INVALID: key' WHEN 4 THEN 'SCRIPT_OUTPUT_INVALID: value' END AS error,
  CASE WHEN raw_message_id % 7 > 4 THEN 'a=' || (raw_message_id % 9) || ',b=1' END AS said FROM {T}""",
)
def script_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outputs of decoders that keep or break the contract; of a repeated key the last value counts, at the first place."""
    i, k = F.col("raw_message_id"), F.col("raw_message_id") % 7
    item = lambda key, value: F.concat(F.lit('{"key": '), F.lit(key), F.lit(', "value": '), value.cast("string"), F.lit("}"))
    bad = F.when(k == 3, item('"9x"', F.lit(1))).when(k == 4, item('"c"', F.lit('"1"'))).otherwise(item('"a"', i % 9))
    listed = F.concat(F.lit("["), F.concat_ws(", ", item('"a"', F.lit(77)), item('"b"', F.lit("true")), bad), F.lit("]"))
    text = F.when(k == 0, "[1, 2]").otherwise(F.concat(F.lit('{"externalId": '), F.when(k == 1, '" "').otherwise('"x"'), F.lit(', "metrics": '), F.when(k == 2, "7").otherwise(listed), F.lit("}")))
    r = scripts.valid_output(F.col("text"), True)
    out = from_events(spark, sf_dir).select(i, text.alias("text")).withColumn("r", r)
    said = F.array_join(F.transform("r.metrics", lambda m: F.concat(m["key"], F.lit("="), m["value"].cast("int").cast("string"))), ",")
    return out.select(i, "r.error", said.alias("said"))


@query(
    "test_cases",
    f"""SELECT raw_message_id, CASE raw_message_id % 3 WHEN 0 THEN raw_message_id % 2 = 0 WHEN 1 THEN true ELSE raw_message_id % 4 < 2 END AS passed, CASE WHEN raw_message_id % 3 = 0 AND raw_message_id % 2 = 1 THEN '$.metrics[0].value' WHEN raw_message_id % 3 = 2 AND raw_message_id % 4 >= 2 THEN '$.metrics[0].value' END AS path FROM {T}""",
)
def test_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected and actual outputs, exactly, at some paths, and within a tolerance."""
    i = F.col("raw_message_id")
    text = lambda v: F.concat(F.lit('{"metrics": [{"key": "t", "value": '), v.cast("string"), F.lit("}]}"))
    mode = F.when(i % 3 == 0, "EXACT").when(i % 3 == 1, "FIELDS").otherwise("TOLERANCE")
    actual = F.when(i % 3 == 0, (i % 2).cast("double")).when(i % 3 == 1, 5.0).otherwise((i % 4) * 0.1)
    cases = from_events(spark, sf_dir).select(i, text(F.lit(0.0)).alias("expected"), text(actual).alias("actual"), mode.alias("mode"), F.array(F.lit("metrics.t.key")).alias("fields"), F.lit(0.15).alias("tolerance"))
    return scripts.compared(cases).select(i, "passed", F.get("differences", F.lit(0))["path"].alias("path"))


LONG = f"""{tables.RETAINED.split('x AS (')[0].rstrip().rstrip(',')}, q AS (SELECT *, last_day(time::DATE) + 1 <= DATE '2024-02-01' AS old FROM p)"""


@query("retention_long", f"WITH {LONG} SELECT {tables.KEEP} FROM q WHERE old AND (coalesce(metric = 0 OR metric > org, false) OR coalesce(model = 0 OR model > org, false))")
def retention_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of an expired month that longer overrides keep."""
    p = from_events(spark, sf_dir)
    return maintenance.expired_month(p, tables.policies(spark), at("2024-02-01 00:00:00"), tables.models(p))[1]


@query("archive_registry", f"SELECT organization_id, strftime(time, '%Y-%m') AS month, count(*) AS n FROM {T} WHERE device_id % 5 > 0 AND last_day(time::DATE) + 1 <= DATE '2024-02-01' GROUP BY ALL")
def archive_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole months archived by organisation without exempt rows; a second run finds them registered."""
    p, base = from_events(spark, sf_dir), store.scratch(spark, "cold")
    for _ in range(2):
        out = store.archive_months(p, f"{base}/rows", f"{base}/registry", at("2024-02-01 00:00:00"), F.col("device_id") % 5 == 0)
    return out.select("organization_id", "month", "n")


@query(
    "confirmed_scores",
    f"WITH {checks.COUNTS}, n AS (SELECT *, CAST(((TIMESTAMP '2024-01-20 15:10:00' AT TIME ZONE 'UTC') AT TIME ZONE ({checks.ZONE})) - INTERVAL 30 MINUTE AS DATE) - 1 AS due FROM c) SELECT device_id, CAST(day AS VARCHAR) AS day, received FROM n WHERE day = due AND device_id % 7 > 0",
)
def confirmed_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days that become final at ten past midnight in one zone and in the morning of another."""
    c = checks.counts(spark, sf_dir).withColumn("day", F.to_date("day"))
    zones = c.select("device_id").distinct().withColumn("timezone", F.when(F.col("device_id") % 2 == 0, "America/New_York").otherwise("Asia/Seoul"))
    out = maintenance.confirmed(c, c.where("device_id % 7 = 0"), zones, at("2024-01-20 15:10:00"))
    return out.select("device_id", F.col("day").cast("string").alias("day"), "received")


@query(
    "lag_events",
    f"""WITH l AS (SELECT date_trunc('hour', received_at) AS "at", CASE WHEN max(value) > 400 THEN 'CRITICAL' WHEN max(value) > 250 THEN 'WARNING' ELSE 'OK' END AS level FROM {T} GROUP BY 1), w AS (SELECT *, lag(level, 1, 'OK') OVER (ORDER BY "at") AS was FROM l)
SELECT "at", CASE WHEN level = 'OK' THEN 'CLEARED' ELSE 'RAISED' END AS kind, level FROM w WHERE level <> was""",
)
def lag_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = from_events(spark, sf_dir).groupBy(F.date_trunc("hour", "received_at").alias("at")).agg(F.max("value").alias("v"))
    return state.level_changes(hours.select("at", F.when(F.col("v") > 400, "CRITICAL").when(F.col("v") > 250, "WARNING").otherwise("OK").alias("level")))


@query(
    "stored_modes",
    f"""WITH RECURSIVE e AS (SELECT * FROM {from_events_sql(5)}), s AS (SELECT * FROM e WHERE (organization_id = 0 AND metric_key = 'click') OR (organization_id = 1 AND metric_key = 'view')), p AS (SELECT *, row_number() OVER (PARTITION BY device_id, metric_key ORDER BY received_at, raw_message_id) AS n FROM s),
r AS (SELECT device_id, metric_key, n, raw_message_id, value AS v, time AS latest, time AS stored, true AS kept, true AS change FROM p WHERE n = 1
  UNION ALL SELECT p.device_id, p.metric_key, p.n, p.raw_message_id, CASE WHEN p.time >= r.latest THEN p.value ELSE r.v END, greatest(p.time, r.latest),
  CASE WHEN (p.time >= r.latest AND p.value <> r.v) OR p.time < r.latest OR p.time - r.stored >= INTERVAL 1 HOUR THEN p.time ELSE r.stored END,
  (p.time >= r.latest AND p.value <> r.v) OR p.time < r.latest OR p.time - r.stored >= INTERVAL 1 HOUR, p.time >= r.latest AND p.value <> r.v
  FROM r JOIN p ON p.device_id = r.device_id AND p.metric_key = r.metric_key AND p.n = r.n + 1)
SELECT raw_message_id, flags FROM e WHERE raw_message_id NOT IN (SELECT raw_message_id FROM s) UNION ALL SELECT r.raw_message_id, CASE WHEN change THEN e.flags | 8 ELSE e.flags END FROM r JOIN e USING (raw_message_id) WHERE kept""",
)
def stored_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two metrics of two organisations are stored on change, all others whole."""
    modes = spark.createDataFrame([(0, "click"), (1, "view")], "organization_id bigint, metric_key string")
    return metrics.stored(from_events(spark, sf_dir, 5), modes).select("raw_message_id", "flags")


REPLAYED = f"(SELECT raw_message_id AS id, organization_id, 'k' || device_id % 40 || '-' || metric_key AS dedup_key, received_at, device_id FROM {T})"


@query(
    "stream_dedup",
    f"""WITH d AS (SELECT *, coalesce(epoch_us(received_at) - epoch_us(lag(received_at) OVER (PARTITION BY organization_id, dedup_key ORDER BY received_at, id::VARCHAR)) <= 600000000, false) AS again FROM {REPLAYED})
SELECT id, CASE WHEN id % 101 = 0 THEN 'INVALID' WHEN again THEN 'DUPLICATE' WHEN device_id % 7 IN (3, 5) THEN 'UNKNOWN_DEVICE_REJECTED' ELSE 'OK' END AS status FROM d""",
)
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream in micro-batches of one folder with duplicates on both sides of their bounds, whose second folder comes a second time."""
    base, p = store.scratch(spark, "dedup"), from_events(spark, sf_dir)
    key = F.concat(F.lit("k"), (F.col("device_id") % 40).cast("string"), F.lit("-"), F.col("metric_key"))
    topic = F.concat_ws("/", F.lit("application/a/device"), messages.eui(), F.lit("event/up"))
    body = F.to_json(F.struct(F.struct(messages.eui().alias("devEui")).alias("deviceInfo"), F.map_from_arrays(F.array(F.lit("n")), F.array(F.lit(1))).alias("object")))
    days = ("2024-01-01", "2024-01-08", "2024-01-16", "2024-01-24", "2100-01-01")
    number = F.when(F.col("received_at") < at(days[0]), -1)
    for k, day in enumerate(days[1:]):
        number = number.when(F.col("received_at") < at(day), k)
    devices, definitions, aliases = messages.dimensions(spark, p)

    def run() -> None:
        source = ingest.read_envelopes(spark, f"{base}/in", 1_000_000).drop("batch")  # what is new is one micro-batch
        ingest.run_stored(source, base, messages.SOURCES, devices, definitions, aliases, slot="yyyyMMdd").awaitTermination()

    folders = []
    for folder in store.folders(messages.envelopes(p, 1, topic, body, key), number, len(days) - 1, f"{base}/in"):
        folders.append(folder)
        run()
    store.published(spark.read.schema(ingest.ENVELOPE).parquet(folders[1]), f"{base}/in/batch={len(folders)}")
    run()
    return spark.read.parquet(f"{base}/messages").select("id", "status")


FUNCTIONS = {"a": "thi(view, 60)", "b": "round(c2f(view), 1)", "c": "f2c(view)", "d": "sqrt(view)", "e": "pow(view, 2)", "f": "log(view)", "g": "exp(click)", "h": "dew_point(view / 10, 60)", "i": "abs_humidity(view / 10, 60)", "j": "abs(click - view)"}
BODIES = {
    "a": "1.8::DOUBLE * v + 32 - 0.55::DOUBLE * (1 - 60.0::DOUBLE / 100) * (1.8::DOUBLE * v - 26)", "b": "floor((v * 1.8::DOUBLE + 32) * 10 + 0.5::DOUBLE) / 10", "c": "(v - 32) / 1.8::DOUBLE", "d": "sqrt(v)", "e": "pow(v, 2)", "f": "CASE WHEN v > 0 THEN ln(v) END", "g": "exp(c)",
    "h": "243.12::DOUBLE * (ln(0.6::DOUBLE) + 17.62::DOUBLE * (v / 10) / (243.12::DOUBLE + v / 10)) / (17.62::DOUBLE - (ln(0.6::DOUBLE) + 17.62::DOUBLE * (v / 10) / (243.12::DOUBLE + v / 10)))",
    "i": "216.7::DOUBLE * (0.6::DOUBLE * 6.112::DOUBLE * exp(17.62::DOUBLE * (v / 10) / (243.12::DOUBLE + v / 10)) / (273.15::DOUBLE + v / 10))", "j": "abs(c - v)",
}


@query(
    "formula_functions",
    f"""WITH w AS (SELECT device_id, date_trunc('hour', time) AS time, max(value) FILTER (metric_key = 'view') AS v, max(value) FILTER (metric_key = 'click') AS c FROM {from_events_sql(5)} GROUP BY 1, 2),
r AS ({' UNION ALL '.join(f"SELECT device_id, time, '{k}' AS metric_key, {b} AS value FROM w" for k, b in BODIES.items())}) SELECT device_id, time, metric_key, round(value, 6) AS value FROM r WHERE value IS NOT NULL""",
)
def formula_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each function of formulas; results to six places, as libraries of exp and ln may differ in the last bit."""
    p = from_events(spark, sf_dir, 5).withColumn("time", F.date_trunc("hour", "time"))
    return formula.evaluate(p, FUNCTIONS).withColumn("value", F.round("value", 6)).select("device_id", "time", "metric_key", "value")


@query("scalar_rules", f"SELECT raw_message_id, CASE WHEN value - 50 > 0 THEN value - 50 WHEN device_id % 3 > 0 THEN device_id % 3 ELSE 9 END::DOUBLE AS inherited, least(greatest(value * 10 - 100, 0), 999.99::DOUBLE) AS battery, CASE device_id % 5 WHEN 0 THEN 'DECODE' WHEN 1 THEN 'STORE' END AS stage FROM {T}")
def scalar_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("device_id") % 5 == 0, "DECODE_ERROR").when(F.col("device_id") % 5 == 1, "STORE_ERROR").otherwise("OK")
    third = (F.col("device_id") % 3).cast("double")
    return from_events(spark, sf_dir).select("raw_message_id", scalars.inherited(F.col("value") - 50, third, F.lit(9.0)).alias("inherited"), scalars.clamp_battery(F.col("value") * 10 - 100).alias("battery"), metrics.dlq_stage(status).alias("stage"))


@query("raw_result_update", f"SELECT raw_message_id AS id, CASE WHEN raw_message_id % 4 = 0 THEN 'OK' ELSE 'DECODE_ERROR' END AS status FROM {T}")
def raw_result_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of messages that were processed again take the place of their first ones."""
    raw = from_events(spark, sf_dir).select(F.col("raw_message_id").alias("id"), F.lit("DECODE_ERROR").alias("status"), "received_at")
    again = raw.where("id % 4 = 0").withColumn("status", F.lit("OK"))
    return maintenance.upsert(raw, again, ["id"], "received_at").select("id", "status")


UNSEEN = from_events_sql(None, 240)


@query(
    "auto_register",
    f"""WITH m AS (SELECT *, raw_message_id % 101 = 0 AS odd FROM {UNSEEN}), f AS (SELECT device_id, min(received_at) AS seen FROM m WHERE NOT odd AND device_id % 7 = 3 GROUP BY 1),
n AS (SELECT device_id, row_number() OVER (PARTITION BY date_trunc('hour', seen) ORDER BY seen, device_id) AS n FROM f)
SELECT raw_message_id AS id, CASE WHEN odd THEN 'INVALID' WHEN device_id % 7 = 5 OR n > 2 THEN 'UNKNOWN_DEVICE_REJECTED' ELSE 'OK' END AS status,
  CASE WHEN odd THEN 'ING_SOURCE_TYPE_UNKNOWN' WHEN device_id % 7 = 5 THEN 'ING_DEVICE_IGNORED' WHEN n > 2 THEN 'ING_AUTO_REGISTER_QUOTA' END AS error FROM m LEFT JOIN n USING (device_id)""",
)
def auto_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uplinks of a source that takes on two unknown devices an hour."""
    p = from_events(spark, sf_dir, None, 240)
    policies = spark.createDataFrame([(1, "AUTO_REGISTER", 2)], "source_id bigint, policy string, hourly_limit int")
    out, _ = ingest.process(store.written(messages.uplink(p)), messages.SOURCES, *messages.dimensions(spark, p), policies=policies)
    return out.select("id", "status", "error")


@query(
    "ingest_formulas",
    f"""WITH p AS ({messages.POINTS}), g AS (SELECT device_id, time, min(raw_message_id) AS raw_message_id, max(CASE WHEN metric_key = 'view' THEN value END) AS v, max(CASE WHEN metric_key = 'signup' THEN value END) AS s FROM p GROUP BY ALL)
SELECT raw_message_id, device_id, metric_key, time, value, quality, false AS derived FROM p WHERE metric_key <> 'signup' UNION ALL SELECT raw_message_id, device_id, 'twice', time, v * 2, 2, true FROM g WHERE v IS NOT NULL
UNION ALL SELECT raw_message_id, device_id, 'signup', time, s / 2, CASE WHEN s / 2 > 10 THEN 1 ELSE 2 END, true FROM g WHERE s IS NOT NULL""",
)
def ingest_formulas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uplinks through the whole pipeline with two formulas; one takes the place of its own input."""
    p = from_events(spark, sf_dir)
    _, points = ingest.process(store.written(messages.uplink(p)), messages.SOURCES, *messages.dimensions(spark, p), formulas={"twice": "view * 2", "signup": "signup / 2"})
    return points.select("raw_message_id", "device_id", "metric_key", "time", "value", "quality", (F.col("flags").bitwiseAND(16) != 0).alias("derived"))


def dropping(message: dict, context: dict) -> dict | None:
    """Drops one in ten messages, fails on another, and adds a metric to all others."""
    last = int(message["messageId"]) % 10
    if last == 2:
        raise ValueError("no such message")
    if last == 0:
        return None
    return {**message, "metrics": [{**m, "value": m["value"] + 1} for m in message["metrics"]] + [{"key": "extra", "value": True, "unit": "n"}]}


def strict(message: dict, context: dict) -> dict:
    if int(message["messageId"]) % 10 == 1:
        raise ValueError("refused")
    return message


@query(
    "ingest_transform",
    f"""WITH i AS ({messages.INGESTED}), p AS ({messages.POINTS}), t AS (SELECT *, CASE WHEN raw_message_id % 10 = 2 THEN value ELSE value + 1 END AS v FROM p WHERE raw_message_id % 10 > 1),
o AS (SELECT raw_message_id AS id, metric_key, v AS value, CASE WHEN metric_key = 'view' THEN CASE WHEN v < 5 OR v > 100 THEN 1 ELSE 0 END WHEN metric_key = 'signup' AND v > 10 THEN 1 ELSE 2 END AS quality, false AS derived FROM t
  UNION ALL SELECT raw_message_id, 'extra', 1, 2, true FROM t WHERE raw_message_id % 10 > 2)
SELECT id, CASE WHEN status = 'OK' AND id % 10 = 1 THEN 'SCRIPT_ERROR' ELSE status END AS status, status = 'OK' AND id % 10 = 0 AS dropped, metric_key, value, quality, derived FROM i LEFT JOIN o USING (id)""",
)
def ingest_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uplinks through the whole pipeline with two functions of different policies: what becomes of each message and its points."""
    p = from_events(spark, sf_dir)
    out, points = ingest.process(store.written(messages.uplink(p)), messages.SOURCES, *messages.dimensions(spark, p), transforms=[(dropping, "FAIL_OPEN"), (strict, "FAIL_CLOSED")])
    own = points.select(F.col("raw_message_id").alias("id"), "metric_key", "value", "quality", (F.col("flags").bitwiseAND(16) != 0).alias("derived"))
    return out.select("id", "status", "dropped").join(own, "id", "left")


BEAT = """'{"meta":{"heartbeat":{' || CASE WHEN raw_message_id % 3 = 0 THEN '"sentAt":"S",' ELSE '' END || '"stages":[{"name":"sim","at":"A"}' || CASE WHEN raw_message_id % 2 = 0 THEN ',{"name":"ingress","at":"B"}' ELSE '' END || ']}}}'"""
ISO = lambda t: f"CASE WHEN epoch_us({t}) % 1000000 = 0 THEN strftime({t}, '%Y-%m-%dT%H:%M:%SZ') WHEN epoch_us({t}) % 1000 = 0 THEN strftime({t}, '%Y-%m-%dT%H:%M:%S.%gZ') ELSE strftime({t}, '%Y-%m-%dT%H:%M:%S.%fZ') END"


@query(
    "heartbeat_stages",
    f"""SELECT raw_message_id, CASE WHEN raw_message_id % 3 = 0 AND raw_message_id % 5 > 0 THEN 'S' ELSE {ISO("time")} END AS sent_at,
  CASE WHEN raw_message_id % 5 = 0 THEN '' ELSE 'sim=A,' END || 'ingress=' || CASE WHEN raw_message_id % 2 = 0 AND raw_message_id % 5 > 0 THEN 'B' ELSE {ISO("received_at")} END || ',pipeline=2024-03-01T00:00:00Z' AS stages FROM {T} WHERE device_id % 2 = 0""",
)
def heartbeat_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heartbeats of the canary device: stages noted on the way, with what is missing filled in."""
    payload = F.when(F.col("raw_message_id") % 5 == 0, "no json").otherwise(F.expr(BEAT)).cast("binary")
    p = from_events(spark, sf_dir).select("raw_message_id", F.when(F.col("device_id") % 2 == 0, metrics.HEARTBEAT).otherwise("dev").alias("external_id"), payload.alias("payload"), "time", "received_at")
    out = metrics.heartbeats(p, at("2024-03-01 00:00:00"))
    return out.select("raw_message_id", "heartbeat.sentAt", F.array_join(F.transform("heartbeat.stages", lambda s: F.concat_ws("=", s["name"], s["at"])), ",").alias("stages")).withColumnRenamed("sentAt", "sent_at")


@query(
    "attempts",
    f"SELECT raw_message_id, CASE WHEN raw_message_id % 3 = 0 THEN 'DECODE_ERROR:E,OK:' ELSE 'OK:' END AS said FROM {T}",
)
def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of messages that are processed again, some for the second time."""
    before = F.when(F.col("raw_message_id") % 3 == 0, '{"attempts":[{"at":"T","status":"DECODE_ERROR","errorCode":"E"}]}').when(F.col("raw_message_id") % 3 == 1, "no json")
    each = metrics.attempts(before, at("2024-03-01 00:00:00"), F.lit("OK"), F.lit(None).cast("string"))
    return from_events(spark, sf_dir).select("raw_message_id", F.array_join(F.transform(each, lambda a: F.concat(a["status"], F.lit(":"), F.coalesce(a["errorCode"], F.lit("")))), ",").alias("said"))
