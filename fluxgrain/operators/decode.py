"""Payload decoders: messages (topic string, payload binary, ...) to external id, measured time, values, link, tags or an error.

Each decoder adds the same columns: external_id, measured_at, ``values`` (array of key, text, kind, unit), link, tags, error. JSON is read with
Spark's functions; only the sequential binary codec is an Arrow UDF.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluxgrain.functions import jsonpaths
from fluxgrain.functions.scalars import epoch, instant_text

VALUE = "struct<key:string,text:string,kind:string,unit:string>"
VALUES = f"array<{VALUE}>"
LINK = "struct<rssi:double,snr:double,frame_counter:bigint,gateways:array<struct<eui:string,rssi:double,snr:double>>>"
FAILED, NO_ID, NOT_NUMERIC = "ING_DECODE_FAILED", "ING_EXTERNAL_ID_MISSING", "ING_VALUE_NOT_NUMERIC"
OUT = ("external_id", "measured_at", "values", "link", "tags", "error")

#: Fixed values of the binary codec: channel and type -> (bytes, [(key, offset, format, divisor, unit)]); no fields: skipped.
TLV = {
    0x0175: (1, [("battery", 0, "u8", 1, "%")]),
    0x0367: (2, [("temperature", 0, "i16", 10, "℃")]),
    0x0468: (1, [("humidity", 0, "u8", 2, "%")]),
    0x057D: (2, [("co2", 0, "u16", 1, "ppm")]),
    0x077D: (2, [("co2", 0, "u16", 1, "ppm")]),
    0x087D: (2, [("tvoc", 0, "u16", 1, None)]),
    0x0673: (2, [("pressure", 0, "u16", 10, "hPa")]),
    0x0973: (2, [("pressure", 0, "u16", 10, "hPa")]),
    0x056A: (2, [("activity", 0, "u16", 1, None)]),
    0x0665: (6, [("illumination", 0, "u16", 1, "lux"), ("infrared_and_visible", 2, "u16", 1, None), ("infrared", 4, "u16", 1, None)]),
    0x055B: (7, [("LAI", 1, "u16", 10, "dB"), ("LAImax", 3, "u16", 10, "dB"), ("LAeq", 5, "u16", 10, "dB")]),
    0xFF01: (1, []), 0xFF0B: (1, []), 0xFF0F: (1, []), 0xFF09: (2, []), 0xFF0A: (2, []), 0xFFFF: (2, []), 0xFF16: (8, []), 0x20CE: (7, []),
}
STORED_RECORD, LONG_RECORD_MODEL, LONG_RECORD = 0x20CE, "EM500", 14
#: Keys that a model's payloads may hold (fixed values); models not listed may hold all.
MODEL_KEYS = {
    "EM300-TH": {"battery", "temperature", "humidity"},
    "EM320-TH": {"battery", "temperature", "humidity"},
    "EM500-CO2": {"battery", "temperature", "humidity", "co2", "pressure"},
    "AM103": {"battery", "temperature", "humidity", "co2"},
    "AM107": {"battery", "temperature", "humidity", "co2", "tvoc", "pressure", "activity", "illumination", "infrared_and_visible", "infrared"},
    "WS302": {"battery", "LAI", "LAImax", "LAeq"},
}


def tlv(data: bytes, model: str | None = None) -> list[tuple[str, float, str | None]]:
    """(key, value, unit) of a payload of channel, type and value triples; ValueError if it is short or a channel is unknown."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            raise ValueError(f"payload ends within a channel at {at}")
        channel = data[at] << 8 | data[at + 1]
        if channel not in TLV:
            raise ValueError(f"unknown channel {channel:04X} at {at}")
        size, fields = TLV[channel]
        if channel == STORED_RECORD and (model or "").startswith(LONG_RECORD_MODEL):
            size = LONG_RECORD
        at += 2
        if fields and at + size > len(data):
            raise ValueError(f"payload is short at {at}: {size} bytes needed")
        for key, offset, form, divisor, unit in fields:
            raw = data[at + offset : at + offset + (1 if form == "u8" else 2)]
            out.append((key, int.from_bytes(raw, "little", signed=form == "i16") / divisor, unit))
        at += size
    allowed = MODEL_KEYS.get(model or "")
    if allowed is not None and (extra := [k for k, _, _ in out if k not in allowed]):
        raise ValueError(f"{model} has no {extra[0]}")
    return out


def _tlv_batch(data: pd.Series, model: pd.Series) -> pd.DataFrame:
    values, errors = [], []
    for d, m in zip(data, model):
        found, error = [], None
        try:
            found = [{"key": k, "text": repr(v), "kind": "number", "unit": u} for k, v, u in (tlv(bytes(d), m) if d is not None else [])]
        except ValueError as e:
            error = str(e)
        values.append(found)
        errors.append(error)
    return pd.DataFrame({"values": values, "error": errors})


def tlv_values(data: Column, model: Column) -> Column:
    """struct<values, error> of binary payloads; Arrow batches, as a payload is read field by field."""
    return F.pandas_udf(_tlv_batch, f"struct<values:{VALUES},error:string>")(data, model)


def _text(messages: DataFrame) -> Column:
    """The payload as text, null where it is no UTF-8."""
    text = F.col("payload").cast("string")
    return F.when(F.is_valid_utf8(text), text)


def at(v: Column, path: str, kind: str = "string") -> Column:
    """What a JSON value (variant) holds at a path, or null."""
    return F.try_variant_get(v, path, kind)


def scalar(key: Column, v: Column, unit: Column | None = None) -> Column:
    """VALUE of a JSON value with the type that it has there; null for objects, arrays and nulls."""
    t = F.schema_of_variant(v)
    kind = F.when(t == "STRING", "text").when(t == "BOOLEAN", "bool").otherwise("number")
    good = v.isNotNull() & ~t.startswith("OBJECT") & ~t.startswith("ARRAY") & (t != "VOID")
    return F.when(good, F.struct(key.alias("key"), v.cast("string").alias("text"), kind.alias("kind"), (F.lit(None) if unit is None else unit).cast("string").alias("unit")))


def scalars(obj: Column) -> Column:
    """VALUES of the scalar members of a JSON object (map of variants); nested ones and nulls are left out."""
    return F.filter(F.transform(F.map_entries(obj), lambda e: scalar(e["key"], e["value"])), lambda v: v.isNotNull())


def lorawan(messages: DataFrame, codec: Column | None = None) -> DataFrame:
    """LoRaWAN uplinks in JSON: values of ``object``, else of the binary ``data``; the earliest gateway time; the strongest gateway.

    The payload is parsed once, into a variant from which all else is read.
    """
    own_codec = F.lit(None).cast("string") if codec is None else codec
    rows = messages.withColumn("_text", F.col("payload").cast("string"))
    rows = rows.withColumn("_json", F.try_parse_json(F.when(F.is_valid_utf8("_text"), F.col("_text"))))
    v = F.col("_json")
    rows = rows.withColumn(
        "_m",
        F.struct(
            at(v, "$", "map<string,variant>").isNotNull().alias("is_object"),
            F.lower(F.coalesce(at(v, "$.deviceInfo.devEui"), F.nullif(F.regexp_extract(F.coalesce("topic", F.lit("")), "(?:^|/)device/([0-9A-Fa-f]{16})/", 1), F.lit("")))).alias("eui"),
            F.coalesce(at(v, "$.rxInfo", "array<variant>"), F.array().cast("array<variant>")).alias("rx"),
            at(v, "$.object", "map<string,variant>").alias("object"),
            at(v, "$.deviceInfo.tags", "map<string,variant>").alias("tags"),
            at(v, "$.data").alias("data"),
            at(v, "$.fCnt", "bigint").alias("frame_counter"),
            F.try_to_timestamp(at(v, "$.time")).alias("time"),
            F.upper(F.coalesce(own_codec, at(v, "$.deviceInfo.deviceProfileName"))).alias("model"),
        ),
    )
    gateway = lambda r: F.struct(F.lower(at(r, "$.gatewayId")).alias("eui"), at(r, "$.rssi", "double").alias("rssi"), at(r, "$.snr", "double").alias("snr"), F.coalesce(F.try_to_timestamp(at(r, "$.nsTime")), F.try_to_timestamp(at(r, "$.time"))).alias("heard"))
    rows = rows.withColumns({"_rx": F.transform("_m.rx", gateway), "_own": scalars(F.col("_m.object")), "_tags": scalars(F.col("_m.tags"))})
    bare = (F.coalesce(F.size("_own"), F.lit(0)) <= 0) & F.col("_m.data").isNotNull()
    rows = rows.withColumns({"_bare": bare, "_bytes": F.when(bare, F.try_to_binary("_m.data", F.lit("base64")))})
    model = F.coalesce(*[F.when(F.contains(F.col("_m.model"), F.lit(m)), F.lit(m)) for m in MODEL_KEYS], F.lit(None).cast("string"))
    rows = rows.withColumn("_tlv", F.when(F.col("_bare"), tlv_values(F.col("_bytes"), model)))
    known = F.transform(F.filter("_rx", lambda r: r["eui"].isNotNull()), lambda r: F.struct(r["eui"], r["rssi"], r["snr"]))
    rows = rows.withColumn("_gateways", known)
    best = F.array_max(F.transform(F.filter("_gateways", lambda g: g["rssi"].isNotNull()), lambda g: F.struct(g["rssi"].alias("rssi"), g["snr"].alias("snr"))))
    rows = rows.withColumn("_best", best)
    some = F.size("_gateways") > 0
    link = F.struct(F.col("_best.rssi").alias("rssi"), F.col("_best.snr").alias("snr"), F.col("_m.frame_counter").alias("frame_counter"), F.when(some, F.col("_gateways")).alias("gateways"))
    tags = F.coalesce(F.map_from_entries(F.transform("_tags", lambda e: F.struct(e["key"], e["text"]))), F.create_map().cast("map<string,string>"))
    error = (
        F.when(~F.coalesce(F.col("_m.is_object"), F.lit(False)), FAILED)
        .when(F.coalesce("_m.eui", F.lit("")) == "", NO_ID)
        .when(F.col("_bare") & (F.col("_bytes").isNull() | F.col("_tlv.error").isNotNull()), FAILED)
    )
    return rows.select(
        *messages.columns,
        F.col("_m.eui").alias("external_id"),
        F.coalesce(F.array_min(F.filter(F.transform("_rx", lambda r: r["heard"]), lambda t: t.isNotNull())), F.col("_m.time")).alias("measured_at"),
        F.coalesce(F.when(F.col("_bare"), F.col("_tlv.values")).otherwise(F.col("_own")), F.array().cast(VALUES)).cast(VALUES).alias("values"),
        F.when(some | F.col("_m.frame_counter").isNotNull(), link).cast(LINK).alias("link"),
        tags.alias("tags"),
        error.alias("error"),
    )


def single_value(messages: DataFrame) -> DataFrame:
    """A number as text: the topic's last part is the metric, the one before the device; topic attributes come first."""
    parts = F.filter(F.split(F.coalesce("topic", F.lit("")), "/"), lambda p: F.trim(p) != "")
    attr = lambda k: F.try_element_at("topic_attributes", F.lit(k)) if "topic_attributes" in messages.columns else F.lit(None).cast("string")
    rows = messages.withColumns({"parts": parts, "t": F.trim(_text(messages)), "a_id": attr("externalId"), "a_key": attr("metric")})
    numeric = F.coalesce(F.col("t").rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"), F.lit(False)) & (F.abs(F.col("t").try_cast("double")) < float("inf"))
    error = F.when((F.size("parts") < 2) & (F.col("a_id").isNull() | F.col("a_key").isNull()), NO_ID).when(~F.coalesce(numeric, F.lit(False)), NOT_NUMERIC)
    value = F.struct(F.coalesce("a_key", F.try_element_at("parts", F.lit(-1))).alias("key"), F.col("t").alias("text"), F.lit("number").alias("kind"), F.lit(None).cast("string").alias("unit"))
    return rows.select(
        *messages.columns,
        F.coalesce("a_id", F.try_element_at("parts", F.lit(-2))).alias("external_id"),
        F.lit(None).cast("timestamp").alias("measured_at"),
        F.when(error.isNull(), F.array(value)).otherwise(F.array().cast(VALUES)).cast(VALUES).alias("values"),
        F.lit(None).cast(LINK).alias("link"),
        F.create_map().cast("map<string,string>").alias("tags"),
        error.alias("error"),
    )


def check_mapping(config: dict) -> list[str]:
    """What is wrong with a mapping of mapped_json()."""
    errors, keys = [], []

    def path(name: str, p) -> None:
        try:
            jsonpaths.steps(p if isinstance(p, str) else "")
        except ValueError as e:
            errors.append(f"{name}: {e}")

    where = config.get("deviceIdFrom")
    m = re.fullmatch(r"topic\[(\d+)\]", where) if isinstance(where, str) else None
    if not where:
        errors.append("deviceIdFrom is missing")
    elif m:
        errors += ["deviceIdFrom: topic index is 0 to 31"] if int(m[1]) > 31 else []
    else:
        path("deviceIdFrom", where)
    if time := config.get("timePath") or config.get("timeFrom"):
        path("timePath", time)
    if config.get("timeFormat", "AUTO") not in ("AUTO", "EPOCH_S", "EPOCH_MS", "ISO8601"):
        errors.append("timeFormat is AUTO, EPOCH_S, EPOCH_MS or ISO8601")
    metrics, items = config.get("metrics"), config.get("items")
    for p, k in [(x.get("path"), x.get("key")) for x in metrics] if isinstance(metrics, list) else (metrics or {}).items():
        path("metrics", p)
        keys.append(k)
    if any(not k or not str(k).strip() for k in keys) or len(set(keys)) < len(keys):
        errors.append("metrics: keys are blank or repeated")
    for name, default in (("path", None), ("keyFrom", "$.key"), ("valueFrom", "$.value"), ("unitFrom", "$")) if items else ():
        path(f"items.{name}", items.get(name, default))
    if not keys and not items:
        errors.append("metrics or items are needed")
    return errors


def mapped(j: Column, topic: Column, given: Column, config: dict) -> Column:
    """struct<external_id, measured_at, values> of a JSON message (a variant) by a mapping; given: the topic's own device id, for messages that name none."""
    if errors := check_mapping(config):
        raise ValueError("; ".join(errors))
    m = re.fullmatch(r"topic\[(\d+)\]", config["deviceIdFrom"])
    own = F.get(F.split(F.coalesce(topic, F.lit("")), "/"), F.lit(int(m[1]))) if m else jsonpaths.first_of(j, config["deviceIdFrom"]).cast("string")
    device = F.coalesce(F.when(F.trim(own) != "", own), F.when(F.trim(given) != "", given))
    time_path, fmt = config.get("timePath") or config.get("timeFrom"), config.get("timeFormat", "AUTO")
    measured = F.lit(None).cast("timestamp")
    if time_path:
        t = F.trim(jsonpaths.first_of(j, time_path).cast("string"))
        number = t.try_cast("bigint")
        measured = epoch(number, fmt) if fmt.startswith("EPOCH") else F.coalesce(F.when(number.isNotNull(), epoch(number, fmt)), F.try_to_timestamp(t))
    metrics = config.get("metrics") or []
    pairs = [(x["path"], x["key"], x.get("unit")) for x in metrics] if isinstance(metrics, list) else [(p, k, None) for p, k in metrics.items()]

    found = F.array(*[scalar(F.lit(k), jsonpaths.first_of(j, p), F.lit(u)) for p, k, u in pairs]).cast(VALUES) if pairs else F.array().cast(VALUES)
    if items := config.get("items"):
        path = items["path"][:-3] if items["path"].endswith("[*]") else items["path"]
        held = jsonpaths.first_of(j, path)
        each = F.when(F.schema_of_variant(held).startswith("ARRAY"), held.cast("array<variant>")).when(held.isNotNull(), F.array(held))
        of = lambda x, name, default: jsonpaths.first_of(x, items.get(name, default))
        unit = lambda x: of(x, "unitFrom", "$").cast("string") if "unitFrom" in items else F.lit(None).cast("string")
        key = lambda x: of(x, "keyFrom", "$.key").cast("string")
        more = F.transform(F.coalesce(each, F.array().cast("array<variant>")), lambda x: F.when(key(x).isNotNull(), scalar(key(x), of(x, "valueFrom", "$.value"), unit(x))))
        found = F.concat(found, more.cast(VALUES))
    return F.struct(device.alias("external_id"), measured.alias("measured_at"), F.filter(found, lambda v: v.isNotNull()).alias("values"))


def mapped_json(messages: DataFrame, *configs: dict | tuple[dict, list[int]]) -> DataFrame:
    """JSON by mappings: where the device id, the time and each metric stand. A mapping becomes an expression; no UDF.

    One mapping serves all messages. Several, each with the ids of its sources, are cases of one projection, so that messages are read and parsed once however many there are.
    """
    rows = messages.withColumn("j", F.try_parse_json(_text(messages)))
    j = F.col("j")
    given = F.try_element_at("topic_attributes", F.lit("externalId")) if "topic_attributes" in messages.columns else F.lit(None).cast("string")
    found = None
    for c in configs:
        config, ids = c if isinstance(c, tuple) else (c, None)
        read = mapped(j, F.col("topic"), given, config)
        mine = F.lit(True) if ids is None else F.col("source_id").isin(ids)
        found = F.when(mine, read) if found is None else found.when(mine, read)
    rows = rows.withColumn("_mapped", found)
    device = F.col("_mapped.external_id")
    return rows.select(
        *messages.columns,
        device.alias("external_id"),
        F.col("_mapped.measured_at").alias("measured_at"),
        F.col("_mapped.values").alias("values"),
        F.lit(None).cast(LINK).alias("link"),
        F.create_map().cast("map<string,string>").alias("tags"),
        F.when(j.isNull(), FAILED).when(device.isNull(), NO_ID).alias("error"),
    )


class Whole(NamedTuple):
    """A user's decode(input) -> the same as scripted()'s, whose input is all of a message (decode_input()) as a dict, with its source's config."""

    function: Callable


def decode_input(messages: DataFrame, config: Column) -> Column:
    """What a user's decoder is given of a message, as JSON text: topic, payload (JSON as it is, all else in base64), payloadBase64, payloadEncoding, payloadText (of text only), receivedAt and source
    (id, code, type, config: JSON text). JSON that cannot be read counts as text."""
    payload = F.coalesce("payload", F.lit("").cast("binary"))
    raw = F.base64(payload)
    json_ = F.when(payload_encoding(payload) == "JSON", F.try_parse_json(payload.cast("string")))
    encoding = F.when(json_.isNotNull(), "JSON").when(payload_encoding(payload) == "JSON", "TEXT").otherwise(payload_encoding(payload))
    quoted = F.try_parse_json(F.concat(F.lit('"'), raw, F.lit('"')))
    source = F.struct(F.col("source_id").alias("id"), F.concat(F.lit("source-"), F.col("source_id").cast("string")).alias("code"), F.col("source_type").alias("type"), F.coalesce(F.try_parse_json(config), F.try_parse_json(F.lit("{}"))).alias("config"))
    return F.to_json(
        F.struct(
            "topic", F.coalesce(json_, quoted).alias("payload"), raw.alias("payloadBase64"), encoding.alias("payloadEncoding"), F.when(encoding == "TEXT", payload.cast("string")).alias("payloadText"), instant_text(F.col("received_at")).alias("receivedAt"), source.alias("source")
        )
    )


def scripted(messages: DataFrame, function: Callable | Whole, configs: dict[int, dict] | None = None) -> DataFrame:
    """A user's decode(topic, payload) -> {"external_id", "measured_at", "values": [(key, value, unit)], "tags"}, or Whole; any exception is a failed message. configs: source_id -> config."""
    whole = isinstance(function, Whole)

    @F.pandas_udf(f"struct<external_id:string,measured_at:timestamp,values:{VALUES},tags:map<string,string>,error:string>")
    def run(first: pd.Series, second: pd.Series) -> pd.DataFrame:
        out = []
        for a, b in zip(first, second):
            try:
                r = function.function(json.loads(a)) if whole else function(a, None if b is None else bytes(b))
                values = [{"key": k, "text": str(v).lower() if isinstance(v, bool) else str(v), "kind": "bool" if isinstance(v, bool) else "number" if isinstance(v, int | float) else "text", "unit": u} for k, v, u in r.get("values", [])]
                out.append((r.get("external_id"), pd.Timestamp(r["measured_at"]) if r.get("measured_at") else pd.NaT, values, r.get("tags") or {}, None if r.get("external_id") else NO_ID))
            except Exception:  # whatever a user's function raises makes its message a failed one
                out.append((None, pd.NaT, [], {}, FAILED))
        return pd.DataFrame(out, columns=["external_id", "measured_at", "values", "tags", "error"])

    if whole:
        said = {i: json.dumps(c) for i, c in (configs or {}).items()}
        config = F.try_element_at(F.create_map(*[F.lit(x) for pair in said.items() for x in pair]), F.col("source_id").cast("int")) if said else F.lit(None).cast("string")
        arguments = (decode_input(messages, config), F.lit(None).cast("binary"))
    else:
        arguments = ("topic", "payload")
    rows = messages.withColumn("r", run(*arguments))
    return rows.select(*messages.columns, "r.external_id", "r.measured_at", "r.values", F.lit(None).cast(LINK).alias("link"), "r.tags", "r.error")


def payload_encoding(payload: Column) -> Column:
    """JSON, TEXT or BINARY by a payload's bytes."""
    text = payload.cast("string")
    control = text.rlike("[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]")
    return F.when(~F.is_valid_utf8(text), "BINARY").when(F.ltrim(text).rlike(r"^[\{\[]"), "JSON").when(control, "BINARY").otherwise("TEXT")


def overlay(decoded: DataFrame) -> DataFrame:
    """Topic attributes over what was decoded: externalId replaces, metric renames a single value, others become tags that decoded ones beat."""
    attr = lambda k: F.try_element_at("topic_attributes", F.lit(k))
    others = F.map_filter(F.coalesce("topic_attributes", F.create_map().cast("map<string,string>")), lambda k, v: ~k.isin("externalId", "metric"))
    beaten = F.map_filter(others, lambda k, v: ~F.coalesce(F.map_contains_key("tags", k), F.lit(False)))
    renamed = F.transform("values", lambda v: F.struct(attr("metric").alias("key"), v["text"].alias("text"), v["kind"].alias("kind"), v["unit"].alias("unit")))
    return decoded.withColumns(
        {
            "external_id": F.coalesce(attr("externalId"), "external_id"),
            "values": F.when((F.size("values") == 1) & attr("metric").isNotNull(), renamed).otherwise(F.col("values")),
            "tags": F.map_concat(F.coalesce("tags", F.create_map().cast("map<string,string>")), beaten),
        }
    )


def decode(messages: DataFrame, sources: dict[int, dict], scripts: dict[str, object] | None = None) -> DataFrame:
    """Messages decoded by their source's decoder: sources is source_id -> {"decoder": name, "config": ...}.

    Each decoder reads the messages of all its sources at once: what a configuration changes is a case of its expressions, so the plan has a branch per decoder and user
    function, not per configuration. Messages of unknown sources or decoders fail.
    """
    by: dict[str, list[tuple[dict, list[int]]]] = {}
    for source_id, s in sources.items():
        name, config = s.get("decoder") or "chirpstack-v4", s.get("config") or {}
        alike = by.setdefault(name, [])
        same = next((ids for c, ids in alike if c == config), None)
        if same is None:
            alike.append((config, [source_id]))
        else:
            same.append(source_id)
    parts, known = [], []
    for name, configs in by.items():
        ids = [i for _, own in configs for i in own]
        rows = messages.where(F.col("source_id").isin(ids))
        if name == "chirpstack-v4":
            codecs = {i: c["codec"] for c, own in configs for i in own if c.get("codec")}
            parts.append(lorawan(rows, F.try_element_at(F.create_map(*[F.lit(x) for i, c in codecs.items() for x in (i, c)]), F.col("source_id").cast("int")) if codecs else None))
        elif name == "single-value":
            parts.append(single_value(rows))
        elif name == "generic-json":
            parts.append(mapped_json(rows, *configs))
        elif name.startswith("script") and scripts and name in scripts:
            parts.append(scripted(rows, scripts[name], {i: c for c, own in configs for i in own}))
        else:
            continue
        known += ids
    lost = messages.where(~F.coalesce(F.col("source_id").isin(known) if known else F.lit(False), F.lit(False)))
    none = {"external_id": "string", "measured_at": "timestamp", "values": VALUES, "link": LINK, "tags": "map<string,string>"}
    out = lost.select("*", *[F.lit(None).cast(t).alias(c) for c, t in none.items()], F.lit(FAILED).alias("error"))
    for p in parts:
        out = p.unionByName(out)
    return out
