"""Queries on decoding, identification and storing of messages; payloads are made from the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxgrain.functions import jsonpaths, scalars
from fluxgrain.operators import decode, metrics
from fluxgrain.sources import store
from fluxgrain.plans.register import registry
from fluxgrain.sources.telemetry import from_events, from_events_sql, table
from fluxgrain.streaming import ingest

QUERIES, ORACLES, query = registry()
T = from_events_sql()


def eui():
    return F.lpad(F.lower(F.hex("device_id")), 16, "0")


def envelopes(p: DataFrame, source_id: int, topic, payload, key=None) -> DataFrame:
    """Events as envelopes of a source."""
    return p.select(
        F.col("raw_message_id").alias("id"),
        F.col("raw_message_id").cast("string").alias("message_id"),
        "organization_id",
        F.lit(source_id).cast("bigint").alias("source_id"),
        F.when(F.col("raw_message_id") % 101 == 0, "CARRIER_PIGEON").otherwise("MQTT_SUBSCRIBE").alias("source_type"),
        topic.alias("topic"),
        payload.cast("binary").alias("payload"),
        "received_at",
        (F.col("raw_message_id").cast("string") if key is None else key).alias("dedup_key"),
        F.lit(False).alias("virtual"),
        F.create_map().cast("map<string,string>").alias("topic_attributes"),
        F.lit(None).cast("string").alias("ingress_status"),
    )


def uplink(p: DataFrame) -> DataFrame:
    """LoRaWAN uplinks: two gateways, the second one stronger and later."""
    iso = lambda t: F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    rx = lambda eui_, rssi, t: F.struct(F.lit(eui_).alias("gatewayId"), rssi.cast("double").alias("rssi"), F.lit(7.5).alias("snr"), iso(t).alias("nsTime"))
    k = F.col("raw_message_id") % 50
    body = F.to_json(
        F.struct(
            F.struct(eui().alias("devEui"), F.lit("EM300").alias("deviceProfileName"), F.struct(F.lit("lab").alias("site")).alias("tags")).alias("deviceInfo"),
            F.col("raw_message_id").alias("fCnt"),
            F.array(rx("GW-A", -90 - k, F.col("time")), rx("GW-B", -60 - k, F.col("time") + F.expr("interval 1 second"))).alias("rxInfo"),
            F.map_from_arrays(F.array("metric_key"), F.array(F.col("value"))).alias("object"),
        )
    )
    return envelopes(p, 1, F.concat_ws("/", F.lit("application/a/device"), eui(), F.lit("event/up")), body)


@query(
    "decode_lorawan",
    f"""SELECT raw_message_id AS id, lpad(lower(hex(device_id)), 16, '0') AS external_id, time AS measured_at, metric_key AS key, value, -60.0::DOUBLE - raw_message_id % 50 AS rssi, raw_message_id AS frame_counter, 2 AS n_gateways, 'lab' AS site FROM {T}""",
)
def decode_lorawan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decode.lorawan(store.written(uplink(from_events(spark, sf_dir))))
    return out.select("id", "external_id", "measured_at", F.inline("values"), "link", "tags").select("id", "external_id", "measured_at", "key", F.col("text").cast("double").alias("value"), "link.rssi", "link.frame_counter", F.size("link.gateways").alias("n_gateways"), F.col("tags")["site"].alias("site"))


@query(
    "decode_single_value",
    f"""SELECT raw_message_id AS id, CASE WHEN raw_message_id % 11 = 0 THEN 'ING_VALUE_NOT_NUMERIC' END AS error, device_id::VARCHAR AS external_id, CASE WHEN raw_message_id % 11 > 0 THEN metric_key END AS key, CASE WHEN raw_message_id % 11 > 0 THEN value END AS value FROM {T}""",
)
def decode_single_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = from_events(spark, sf_dir)
    text = F.when(F.col("raw_message_id") % 11 == 0, F.lit("12,5")).otherwise(F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" ")))
    out = decode.single_value(envelopes(p, 2, F.concat_ws("/", F.lit("site/1"), F.col("device_id").cast("string"), "metric_key"), text))
    return out.select("id", "error", "external_id", F.get("values", F.lit(0)).alias("v")).select("id", "error", "external_id", "v.key", F.col("v.text").cast("double").alias("value"))


MAPPING = {"deviceIdFrom": "topic[1]", "timePath": "$.t", "timeFormat": "AUTO", "metrics": [{"path": "$.reading['v']", "key": "value", "unit": "u"}, {"path": "$.missing", "key": "none"}], "items": {"path": "$.sensors[*]", "keyFrom": "$.name", "valueFrom": "$.k"}}


@query(
    "decode_mapped_json",
    f"""SELECT raw_message_id AS id, device_id::VARCHAR AS external_id, date_trunc('second', time) AS measured_at, 'value' AS key, value, 'u' AS unit FROM {T}
UNION ALL SELECT raw_message_id, device_id::VARCHAR, date_trunc('second', time), metric_key, (raw_message_id % 9)::DOUBLE, NULL FROM {T}""",
)
def decode_mapped_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = from_events(spark, sf_dir)
    sensor = F.struct(F.col("metric_key").alias("name"), (F.col("raw_message_id") % 9).alias("k"))
    body = F.to_json(F.struct(F.unix_seconds("time").alias("t"), F.struct(F.col("value").alias("v")).alias("reading"), F.array(sensor).alias("sensors")))
    out = decode.mapped_json(envelopes(p, 3, F.concat_ws("/", F.lit("x"), F.col("device_id").cast("string")), body), MAPPING)
    return out.select("id", "external_id", "measured_at", F.inline("values")).select("id", "external_id", "measured_at", "key", F.col("text").cast("double").alias("value"), "unit")


#: Channel, its bytes after the two of the code as hexadecimal text of b0 and b1, and the (key, value in terms of b0 and b1) that it says; signed where s.
CHANNELS = [
    ("0175", "{0}", {"battery": "b0"}), ("0367", "{0}{1}", {"temperature": "s / 10.0"}), ("0468", "{0}", {"humidity": "b0 / 2.0"}), ("057D", "{0}{1}", {"co2": "u"}), ("077D", "{0}{1}", {"co2": "u"}),
    ("087D", "{0}{1}", {"tvoc": "u"}), ("0673", "{0}{1}", {"pressure": "u / 10.0"}), ("0973", "{0}{1}", {"pressure": "u / 10.0"}), ("056A", "{0}{1}", {"activity": "u"}),
    ("0665", "{0}{1}{1}{0}{0}{0}", {"illumination": "u", "infrared_and_visible": "b1 + b0 * 256", "infrared": "b0 + b0 * 256"}), ("055B", "{1}{0}{1}{1}{0}{0}{0}", {"LAI": "u / 10.0", "LAImax": "(b1 + b0 * 256) / 10.0", "LAeq": "(b0 + b0 * 256) / 10.0"}),
    ("FF01", "{0}", {}), ("FF0B", "{0}", {}), ("FF0F", "{0}", {}), ("FF09", "{0}{1}", {}), ("FF0A", "{0}{1}", {}), ("FFFF", "{0}{1}", {}), ("FF16", "{0}{1}{0}{1}{0}{1}{0}{1}", {}), ("20CE", "{0}{1}{0}{1}{0}{1}{0}", {}),
]
SAID = ", ".join(f"('{c}', '{k}', ({v})::DOUBLE)" for c, _, keys in CHANNELS for k, v in keys.items())


@query(
    "decode_tlv",
    f"""WITH b AS (SELECT raw_message_id AS id, raw_message_id % 256 AS b0, raw_message_id // 256 % 256 AS b1 FROM {T}), w AS (SELECT *, b0 + b1 * 256 AS u, CASE WHEN b1 >= 128 THEN b0 + b1 * 256 - 65536 ELSE b0 + b1 * 256 END AS s FROM b)
SELECT id, x.key, x.value FROM w, LATERAL (VALUES {SAID}) AS x(channel, key, value)""",
)
def decode_tlv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A binary payload of all channels, those that are skipped too, made and decoded."""
    i = F.col("raw_message_id")
    two = lambda v: F.lpad(F.hex(v), 2, "0")
    parts = []
    for code, form, _ in CHANNELS:
        parts += [F.lit(code), *[two(i % 256) if x == "0" else two(F.floor(i / 256) % 256) for x in form.replace("{", "").replace("}", "")]]
    p = from_events(spark, sf_dir).select(i.alias("id"), decode.tlv_values(F.unhex(F.concat(*parts)), F.lit(None).cast("string")).alias("r"))
    return p.select("id", F.inline("r.values")).select("id", "key", F.col("text").cast("double").alias("value"))


MODELS = [("EM300-TH", "0175640367050104686E", None), ("EM320-TH", "0367FFFF", None), ("EM300-TH", "057DC409", "ING"), ("em500-co2 v1", "057DC4090673A027", None), ("AM103", "087D0100", "ING"), ("AM107", "087D0100056A0200", None), ("WS302", "055B000A0014001E00", None), ("WS302", "0468AA", "ING"), (None, "0468AA", None), ("EM500-CO2", "20CE" + "00" * 14 + "017564", None)]


@query("decode_models", "SELECT * FROM (VALUES (0, NULL, 'battery=100,temperature=26.1,humidity=55'), (1, NULL, 'temperature=-0.1'), (2, 'ING_DECODE_FAILED', ''), (3, NULL, 'co2=2500,pressure=1014.4'), (4, 'ING_DECODE_FAILED', ''), (5, NULL, 'tvoc=1,activity=2'), (6, NULL, 'LAI=1,LAImax=2,LAeq=3'), (7, 'ING_DECODE_FAILED', ''), (8, NULL, 'humidity=85'), (9, NULL, 'battery=100')) AS t(id, error, said)")
def decode_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uplinks without values whose binary data are read by the model's codec; a model's payload may hold its own keys only."""
    rows = spark.createDataFrame([(i, m, h) for i, (m, h, _) in enumerate(MODELS)], "id int, model string, h string")
    info = F.struct(F.lit("24E124AABBCCDDEE").alias("devEui"), F.col("model").alias("deviceProfileName"))
    messages = rows.select("id", F.lit("x").alias("topic"), F.to_json(F.struct(info.alias("deviceInfo"), F.base64(F.unhex("h")).alias("data"))).cast("binary").alias("payload"))
    said = F.array_join(F.transform("values", lambda v: F.concat(v["key"], F.lit("="), F.regexp_replace(v["text"], r"\.0$", ""))), ",")
    return decode.lorawan(messages).select("id", "error", said.alias("said"))


@query(
    "mapped_json_types",
    f"""SELECT raw_message_id AS id, unnest(['text', 'number', 'flag', 'later']) AS key, unnest([(raw_message_id % 5)::VARCHAR, (raw_message_id % 7)::VARCHAR, CASE WHEN raw_message_id % 2 = 0 THEN 'true' ELSE 'false' END, 'true']) AS text, unnest(['text', 'number', 'bool', 'text']) AS kind FROM {T}""",
)
def mapped_json_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values keep the type that they have in the payload: "1" is text, 1 a number, true a flag and "true" text; objects and nulls are left out."""
    p, i = from_events(spark, sf_dir), F.col("raw_message_id")
    body = F.struct((i % 5).cast("string").alias("a"), (i % 7).alias("b"), (i % 2 == 0).alias("c"), F.array(F.struct(F.lit(None).cast("string").alias("x")), F.struct(F.lit("true").alias("x"))).alias("d"))
    messages = store.written(envelopes(p, 3, F.concat_ws("/", F.lit("x"), F.col("device_id").cast("string")), F.to_json(body)))
    mapping = {"deviceIdFrom": "topic[1]", "metrics": [{"path": "$.a", "key": "text"}, {"path": "$.b", "key": "number"}, {"path": "$['c']", "key": "flag"}, {"path": "$.d[*].x", "key": "later"}, {"path": "$.d", "key": "list"}, {"path": "$.none", "key": "none"}]}
    return decode.mapped_json(messages, mapping).select("id", F.inline("values")).select("id", "key", "text", "kind")


@query("json_paths_props", "SELECT event_id, json_extract_string(props, '$.k') AS k, NULL::VARCHAR AS missing, CAST(json_extract_string(props, '$.k') AS INTEGER) + 1 AS next FROM events")
def json_paths_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = jsonpaths.first(F.col("props"), "$['k']")
    return e.select("event_id", k.alias("k"), jsonpaths.first(F.col("props"), "$.a[0].b").alias("missing"), (k.cast("int") + 1).alias("next"))


@query("uuid_v3_ids", f"""WITH h AS (SELECT raw_message_id, md5('telemetry:' || organization_id || ':' || raw_message_id) AS h FROM {T})
SELECT raw_message_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-3' || substr(h, 14, 3) || '-' || substr('89ab', ((strpos('0123456789abcdef', substr(h, 17, 1)) - 1) % 4 + 1)::INTEGER, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS id FROM h""")
def uuid_v3_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat_ws(":", F.lit("telemetry"), F.col("organization_id").cast("string"), F.col("raw_message_id").cast("string"))
    return from_events(spark, sf_dir).select("raw_message_id", scalars.name_uuid(name).alias("id"))


DEFINITIONS = [("hits", "n", 0.0, 1.0, "ACTIVE", {"one": 1.0, "zero": 0.0}), ("view", "s", 5.0, 100.0, "ACTIVE", {}), ("error", None, None, None, "IGNORED", {}), ("signup", None, None, 10.0, "UNVERIFIED", {})]
DEFINITION = "metric_key string, unit string, valid_min double, valid_max double, status string, enum_map map<string,double>"
ALIASES = [(0, "click", "hits"), (1, "click", "hits"), (0, "purchase", "view")]


def decoded(p: DataFrame) -> DataFrame:
    i = F.col("raw_message_id")
    text = F.when(F.col("metric_key") == "click", F.when(F.col("value") == 1, F.when(i % 2 == 0, " ONE ").otherwise("on")).otherwise(F.when(i % 2 == 0, "zero").otherwise("off"))).otherwise(F.col("value").cast("string"))
    value = F.struct(F.col("metric_key").alias("key"), text.alias("text"), F.when(F.col("metric_key") == "click", "text").otherwise("number").alias("kind"), F.lit("own").alias("unit"))
    second = F.struct(F.lit("view").alias("key"), F.lit("50").alias("text"), F.lit("number").alias("kind"), F.lit("own").alias("unit"))
    return p.select(i.alias("message_id"), "organization_id", F.array(value, second).alias("values"))


@query(
    "alias_coerce",
    f"""WITH v AS (SELECT raw_message_id AS message_id, organization_id, metric_key AS original_key, value, 0 AS pos, raw_message_id % 2 AS odd FROM {T} UNION ALL SELECT raw_message_id, organization_id, 'view', 50, 1, 0 FROM {T}),
a AS (SELECT *, CASE WHEN original_key = 'click' AND organization_id < 2 THEN 'hits' WHEN original_key = 'purchase' AND organization_id = 0 THEN 'view' ELSE original_key END AS metric_key FROM v),
n AS (SELECT *, CASE WHEN metric_key = 'hits' AND odd = 1 THEN NULL WHEN metric_key = 'click' AND odd = 0 THEN NULL ELSE value END AS num FROM a WHERE metric_key <> 'error'),
m AS (SELECT *, CASE WHEN bool_or(num IS NULL) OVER (PARTITION BY message_id) THEN 'ING_VALUE_NOT_NUMERIC' END AS message_error FROM n)
SELECT message_id, metric_key, original_key, num AS value, CASE metric_key WHEN 'hits' THEN 'n' WHEN 'view' THEN 's' ELSE 'own' END AS unit, metric_key NOT IN ('hits', 'view') AS unverified,
  coalesce(CASE metric_key WHEN 'hits' THEN num < 0 OR num > 1 WHEN 'view' THEN num < 5 OR num > 100 WHEN 'signup' THEN num > 10 END, false) AS out_of_range, message_error
FROM m QUALIFY row_number() OVER (PARTITION BY message_id, metric_key ORDER BY pos) = 1""",
)
def alias_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aliases, words for numbers, units, ranges, and messages that one bad value makes invalid."""
    rows = decoded(from_events(spark, sf_dir))
    out = metrics.points(rows, spark.createDataFrame(DEFINITIONS, DEFINITION), spark.createDataFrame(ALIASES, "organization_id bigint, alias string, metric_key string"))
    return out.select("message_id", "metric_key", "original_key", "value", "unit", "unverified", "out_of_range", "message_error")


@query("best_gateway_argmax", f"SELECT device_id, arg_max(metric_key, (value, raw_message_id)) AS gateway, max(value) AS rssi, min(time) AS first_time FROM {T} GROUP BY ALL")
def best_gateway_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = from_events(spark, sf_dir)
    return p.groupBy("device_id").agg(F.max_by("metric_key", F.struct("value", "raw_message_id")).alias("gateway"), F.max("value").alias("rssi"), F.min("time").alias("first_time"))


SOURCES = {1: {"decoder": "chirpstack-v4"}, 2: {"decoder": "single-value"}, 3: {"decoder": "generic-json", "config": MAPPING}}
INGESTED = f"""SELECT raw_message_id AS id, CASE WHEN raw_message_id % 101 = 0 THEN 'INVALID' WHEN device_id % 7 = 3 THEN 'UNKNOWN_DEVICE_REJECTED' WHEN device_id % 7 = 5 THEN 'UNKNOWN_DEVICE_REJECTED' ELSE 'OK' END AS status,
  CASE WHEN raw_message_id % 101 = 0 THEN 'ING_SOURCE_TYPE_UNKNOWN' WHEN device_id % 7 = 3 THEN 'ING_DEVICE_UNKNOWN' WHEN device_id % 7 = 5 THEN 'ING_DEVICE_IGNORED' END AS error FROM {T}"""


def dimensions(spark: SparkSession, p: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    devices = p.where("device_id % 7 <> 3").select("device_id", "organization_id").distinct()
    devices = devices.select(F.lit(1).cast("bigint").alias("source_id"), F.upper(eui()).alias("external_id"), "device_id", "organization_id", F.lit("ACTIVE").alias("status"), (F.col("device_id") % 7 == 5).alias("ignored"))
    return devices, spark.createDataFrame(DEFINITIONS, DEFINITION).where("metric_key <> 'error'"), spark.createDataFrame([], "organization_id bigint, alias string, metric_key string")


@query("ingest_status", INGESTED)
def ingest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uplinks through the whole pipeline: what becomes of each message."""
    p = from_events(spark, sf_dir)
    messages, _ = ingest.process(store.written(uplink(p)), SOURCES, *dimensions(spark, p))
    return messages.select("id", "status", "error")


POINTS = f"""SELECT raw_message_id, device_id, metric_key, time, value, CASE WHEN metric_key = 'view' AND (value < 5 OR value > 100) THEN 1 WHEN metric_key = 'signup' AND value > 10 THEN 1 WHEN metric_key = 'view' THEN 0 ELSE 2 END AS quality
FROM {T} WHERE raw_message_id % 101 > 0 AND device_id % 7 NOT IN (3, 5)"""


@query("ingest_points", POINTS)
def ingest_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uplinks through the whole pipeline: the points stored."""
    p = from_events(spark, sf_dir)
    _, points = ingest.process(store.written(uplink(p)), SOURCES, *dimensions(spark, p))
    return points.select("raw_message_id", "device_id", "metric_key", "time", "value", "quality")


@query("stream_equals_batch", POINTS)
def stream_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same points from a stream of envelope files in micro-batches, each written by its number."""
    base = store.scratch(spark, "stream")
    p = from_events(spark, sf_dir)
    files = max(4, spark.sparkContext.defaultParallelism)  # written by all cores, read in two micro-batches
    uplink(p).repartition(files, "id").write.option("parquet.block.size", store.BLOCK).parquet(f"{base}/in")
    devices, definitions, aliases = dimensions(spark, p)

    def handle(batch: DataFrame, number: int) -> None:
        _, points = ingest.process(batch, SOURCES, devices, definitions, aliases)
        points.write.mode("overwrite").parquet(f"{base}/out/batch={number}")

    ingest.run(ingest.read_envelopes(spark, f"{base}/in", (files + 1) // 2), f"{base}/checkpoint", handle).awaitTermination()
    return spark.read.parquet(f"{base}/out").select("raw_message_id", "device_id", "metric_key", "time", "value", "quality")


#: Two mappings of one decoder, a decoder that is not there, and (6) a source that is not configured.
MANY = {**SOURCES, 4: {"decoder": "generic-json", "config": {"deviceIdFrom": "$.dev", "metrics": {"$.v": "reading", "$.flag": "flag"}}}, 5: {"decoder": "other"}}
ZEROED = f"(SELECT * REPLACE (coalesce(value, 0) AS value), 1 + raw_message_id % 6 AS source FROM {T})"


@query(
    "ingest_sources",
    f"""WITH s AS (SELECT *, CASE WHEN raw_message_id % 101 = 0 THEN 'INVALID' WHEN source > 4 THEN 'DECODE_ERROR' WHEN device_id % 7 IN (3, 5) THEN 'UNKNOWN_DEVICE_REJECTED' ELSE 'OK' END AS status FROM {ZEROED}),
v AS (SELECT raw_message_id, metric_key AS key, value AS v, time AS told FROM s WHERE source = 1 UNION ALL SELECT raw_message_id, metric_key, value, received_at FROM s WHERE source = 2
  UNION ALL SELECT raw_message_id, 'value', value, date_trunc('second', time) FROM s WHERE source = 3 UNION ALL SELECT raw_message_id, metric_key, (raw_message_id % 9)::DOUBLE, date_trunc('second', time) FROM s WHERE source = 3
  UNION ALL SELECT raw_message_id, 'reading', value, received_at FROM s WHERE source = 4 UNION ALL SELECT raw_message_id, 'flag', (device_id % 2)::DOUBLE, received_at FROM s WHERE source = 4)
SELECT s.raw_message_id AS id, source AS source_id, status, CASE WHEN status = 'INVALID' THEN 'ING_SOURCE_TYPE_UNKNOWN' WHEN status = 'DECODE_ERROR' THEN 'ING_DECODE_FAILED' WHEN status <> 'OK' THEN CASE WHEN device_id % 7 = 3 THEN 'ING_DEVICE_UNKNOWN' ELSE 'ING_DEVICE_IGNORED' END END AS error,
  key AS metric_key, v AS value, told AS time FROM s LEFT JOIN v ON v.raw_message_id = s.raw_message_id AND status = 'OK'""",
)
def ingest_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of six sources through the whole pipeline at once: three decoders, two mappings, a decoder that is not there and a source that is not configured."""
    p = from_events(spark, sf_dir).withColumns({"value": F.coalesce("value", F.lit(0.0)), "_s": 1 + F.col("raw_message_id") % 6})
    own, of = F.col("device_id").cast("string"), lambda k: p.where(F.col("_s") == k)
    sensor = F.struct(F.col("metric_key").alias("name"), (F.col("raw_message_id") % 9).alias("k"))
    third = F.to_json(F.struct(F.unix_seconds("time").alias("t"), F.struct(F.col("value").alias("v")).alias("reading"), F.array(sensor).alias("sensors")))
    fourth = F.to_json(F.struct(own.alias("dev"), F.col("value").alias("v"), (F.col("device_id") % 2 == 1).alias("flag")))
    rows = uplink(of(1)).unionByName(envelopes(of(2), 2, F.concat_ws("/", F.lit("site/1"), own, "metric_key"), F.col("value").cast("string"))).unionByName(envelopes(of(3), 3, F.concat_ws("/", F.lit("x"), own), third))
    for k in (4, 5, 6):
        rows = rows.unionByName(envelopes(of(k), k, F.lit("x"), fourth))
    devices, definitions, aliases = dimensions(spark, p)
    more = devices.select(F.explode(F.array(*[F.lit(k).cast("bigint") for k in (2, 3, 4)])).alias("source_id"), F.col("device_id").cast("string").alias("external_id"), "device_id", "organization_id", "status", "ignored")
    out, points = ingest.process(store.written(rows), MANY, devices.unionByName(more), definitions, aliases)
    return out.select("id", "source_id", "status", "error").join(points.select(F.col("raw_message_id").alias("id"), "metric_key", "value", "time"), "id", "left")
