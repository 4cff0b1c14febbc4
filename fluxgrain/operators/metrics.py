"""From decoded values to canonical points: aliases, units, numbers, ranges; and the checks of a message before that."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluxgrain.functions import scalars
from fluxgrain.operators import quality, state
from fluxgrain.sources.telemetry import DERIVED, LATE

MAX_PAYLOAD, KEPT_PAYLOAD, MAX_VALUES, MAX_KEY, MAX_TEXT = 262_144, 4_096, 100, 64, 1_024
#: Source types, the states of a message (those that can be processed again first), payload formats, signatures, and the stages of dead letters.
SOURCE_TYPES = ("MQTT_SUBSCRIBE", "PLATFORM_BROKER", "WEBHOOK", "SIMULATION", "CONNECTOR", "EDGE", "KMA_WEATHER", "AIRKOREA", "HOLIDAY", "ICAL", "ONEM2M", "OPCUA", "MODBUS_TCP")
HEARTBEAT, STAGES = "__heartbeat__", "sentAt string, stages array<struct<name:string,at:string>>"
REPROCESSABLE = ("DECODE_ERROR", "SCRIPT_ERROR", "STORE_ERROR", "PUBLISH_ERROR", "UNKNOWN_DEVICE_REJECTED")
STATUSES = ("RECEIVED", "OK", "DUPLICATE", *REPROCESSABLE, "INVALID")
PAYLOAD_FORMATS = ("JSON", "CBOR", "MSGPACK", "PROTOBUF", "AVRO", "CSV", "TEXT", "BINARY", "SPARKPLUG_B")
SIGNATURES = ("VERIFIED", "UNSIGNED", "INVALID")
DLQ_STAGES = {"DECODE_ERROR": "DECODE", "SCRIPT_ERROR": "SCRIPT", "STORE_ERROR": "STORE", "PUBLISH_ERROR": "PUBLISH"}


def rejected(messages: DataFrame, source_types: tuple[str, ...] = SOURCE_TYPES) -> Column:
    """The code of a message that goes no further than its envelope, or null: source type, size, what the ingress found."""
    status = F.col("ingress_status") if "ingress_status" in messages.columns else F.lit(None).cast("string")
    return (
        F.when(~F.coalesce(F.col("source_type").isin(*source_types), F.lit(False)), "ING_SOURCE_TYPE_UNKNOWN")
        .when(F.octet_length("payload") > MAX_PAYLOAD, "ING_PAYLOAD_TOO_LARGE")
        .when(status == "DECODE_ERROR", "ING_DECODE_FAILED")
        .when(status.isNotNull(), status)
    )


def stored_payload(payload: Column) -> Column:
    return F.when(F.octet_length(payload) > MAX_PAYLOAD, F.substring(payload, 1, KEPT_PAYLOAD)).otherwise(payload)


def over_limits(values: Column) -> Column:
    """The first limit that a message's values break, or null: their number, then value by value the key's length and the text's size."""
    each = F.transform(
        values,
        lambda v: F.when(F.length(v["key"]) > MAX_KEY, "ING_KEY_TOO_LONG").when((v["kind"] == "text") & (F.octet_length(v["text"]) > MAX_TEXT), "ING_VALUE_TOO_LONG"),
    )
    return F.when(F.size(values) > MAX_VALUES, "ING_TOO_MANY_VALUES").otherwise(F.get(F.filter(each, lambda x: x.isNotNull()), F.lit(0)))


def dlq_stage(status: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in DLQ_STAGES.items() for x in kv]), status)


def may_become(status: Column, following: Column, again: bool = False) -> Column:
    """Whether a message may go from one status to the next: from RECEIVED to any result or, processed again, from a failure to any result."""
    source = status.isin(*REPROCESSABLE) if again else status == "RECEIVED"
    return F.coalesce(source & following.isin(*STATUSES) & (following != "RECEIVED"), F.lit(False))


def known_name(value: Column, names: tuple[str, ...]) -> Column:
    """The value if it is one of the names that the contract lists (PAYLOAD_FORMATS, SIGNATURES), else null."""
    return F.when(value.isin(*names), value)


def identified(messages: DataFrame, devices: DataFrame, policy: Column | None = None) -> DataFrame:
    """messages (source_id, external_id) with device_id, device_status and device_error; deleted devices are missing, ignored ones rejected.

    devices: (source_id, external_id, device_id, organization_id, status, ignored). They are as many as the input has, so both sides are dealt out by device: a join that is made a broadcast
    only while it runs has messages dealt already, and then a task reads what several tasks wrote, which grows with the input.
    """
    d = devices.where("status <> 'DELETED'").select("source_id", scalars.external_id(F.col("external_id")).alias("_x"), "device_id", F.col("status").alias("device_status"), "ignored").dropDuplicates(["source_id", "_x"])
    rows = messages.withColumn("_x", scalars.external_id(F.col("external_id"))).join(d.hint("merge"), ["source_id", "_x"], "left").drop("_x")
    policy = F.lit("REJECT") if policy is None else policy
    error = F.when(F.col("device_id").isNull(), F.when(policy == "AUTO_REGISTER", "ING_AUTO_REGISTER_QUOTA").otherwise("ING_DEVICE_UNKNOWN")).when(F.coalesce("ignored", F.lit(False)), "ING_DEVICE_IGNORED")
    return rows.withColumn("device_error", error).drop("ignored")


def registered(messages: DataFrame, devices: DataFrame, policies: DataFrame, limit: int = 100, before: DataFrame | None = None) -> DataFrame:
    """The unknown devices of messages (source_id, external_id, organization_id, received_at) that come from sources which register such devices: rows shaped like devices,
    pending, with seen_at, accepted and alarm. A source takes on so many an hour (its own hourly_limit, or ``limit``), by first message; the others may come again with later calls.

    policies: (source_id, policy, hourly_limit); before: rows of earlier calls, whose devices are known and whose places in an hour are taken.
    Ids are made of source and external id, so a repeated call makes the same ones.
    """
    known = devices.where("status <> 'DELETED'").select("source_id", scalars.external_id(F.col("external_id")).alias("_x"))
    open_sources = policies.where("policy = 'AUTO_REGISTER'").select("source_id", F.when(F.col("hourly_limit") > 0, F.col("hourly_limit")).otherwise(limit).alias("_limit"))
    rows = messages.where("external_id IS NOT NULL").withColumn("_x", scalars.external_id(F.col("external_id"))).join(F.broadcast(open_sources), "source_id").join(known.hint("merge"), ["source_id", "_x"], "left_anti")
    first = rows.groupBy("source_id", F.col("_x").alias("external_id"), "_limit").agg(F.min_by("organization_id", "received_at").alias("organization_id"), F.min("received_at").alias("seen_at"))
    judged = state.registrations(first, F.col("_limit"), before=before)
    return judged.select("source_id", "external_id", F.xxhash64("source_id", "external_id").alias("device_id"), "organization_id", F.lit("PENDING").alias("status"), F.lit(False).alias("ignored"), "seen_at", "accepted", "alarm")


def points(messages: DataFrame, definitions: DataFrame, aliases: DataFrame) -> DataFrame:
    """One row per message and metric of messages with ``values``: key by alias, number, unit, and what is wrong with the message.

    definitions: (metric_key, unit, valid_min, valid_max, status, enum_map); aliases: (organization_id, alias, metric_key); both are configuration and are broadcast, as
    a few keys have all values and dealing values out by key would leave each key's to one task. The first value of a canonical key
    counts; keys of another shape and ignored metrics are left out; a value that is no number makes its whole message invalid.
    """
    each = messages.select("*", F.posexplode("values").alias("_at", "_v")).drop("values")
    each = each.withColumns({"original_key": F.col("_v.key"), "_text": F.col("_v.text"), "_kind": F.col("_v.kind"), "_unit": F.col("_v.unit")}).drop("_v")
    each = each.where(F.col("original_key").rlike(scalars.METRIC_KEY))
    a = aliases.select(F.col("organization_id"), F.col("alias").alias("original_key"), F.col("metric_key").alias("_canonical"))
    each = each.join(F.broadcast(a), ["organization_id", "original_key"], "left").withColumn("metric_key", F.coalesce("_canonical", "original_key")).drop("_canonical")
    d = definitions.select("metric_key", F.col("unit").alias("_own_unit"), "valid_min", "valid_max", F.col("status").alias("_status"), F.col("enum_map").alias("_words"))
    each = each.join(F.broadcast(d), "metric_key", "left").where(~F.coalesce(F.col("_status") == "IGNORED", F.lit(False)))
    value = scalars.number(F.col("_text"), F.col("_kind"), F.col("_words"))
    each = each.withColumn("value", value)
    message = Window.partitionBy("message_id")
    each = each.withColumn("message_error", F.when(F.max(F.col("value").isNull().cast("int")).over(message) == 1, "ING_VALUE_NOT_NUMERIC"))
    each = each.withColumn("_n", F.row_number().over(Window.partitionBy("message_id", "metric_key").orderBy("_at"))).where("_n = 1")
    each = each.withColumns({"unit": F.coalesce("_own_unit", "_unit"), "unverified": F.col("_status").isNull() | (F.col("_status") == "UNVERIFIED"), "out_of_range": quality.out_of_range(F.col("value"), F.col("valid_min"), F.col("valid_max"))})
    return each.drop("_at", "_text", "_kind", "_unit", "_own_unit", "_status", "_words", "_n", "valid_min", "valid_max")


def signature_error(source_type: Column, signature: Column, device_status: Column, live: bool = True) -> Column:
    """The code with which a platform broker's message is refused, or null: its signature is wrong, or its approved device has not signed it.

    Messages that are processed again carry no signature and are not refused for lacking one; quarantined() marks them.
    """
    own = F.coalesce(source_type == "PLATFORM_BROKER", F.lit(False))
    unsigned = F.lit(live) & (F.coalesce(device_status, F.lit("")) != "PENDING") & (F.coalesce(signature, F.lit("")) != "VERIFIED")
    return F.when(own & (F.coalesce(signature == "INVALID", F.lit(False)) | (device_status.isNotNull() & unsigned)), "ING_SIGNATURE_INVALID")


def quarantined(source_type: Column, signature: Column, device_status: Column, live: bool = True) -> Column:
    """Whether a message's values are kept apart as unverified: its device waits for approval, or it is processed again without a signature."""
    own = F.coalesce(source_type == "PLATFORM_BROKER", F.lit(False))
    return own & (F.coalesce(device_status == "PENDING", F.lit(False)) | (F.lit(not live) & (F.coalesce(signature, F.lit("")) != "VERIFIED")))


def link_rows(messages: DataFrame) -> DataFrame:
    """One row per gateway that heard a message, or one with the gateway '' where only the message's own reception is known; once per device, gateway and time."""
    own = F.col("link.rssi").isNotNull() | F.col("link.snr").isNotNull()
    heard = F.when(F.size("link.gateways") > 0, F.col("link.gateways")).when(own, F.array(F.struct(F.lit("").alias("eui"), F.col("link.rssi").alias("rssi"), F.col("link.snr").alias("snr"))))
    rows = messages.where("link IS NOT NULL").withColumn("_g", F.explode(heard))
    rows = rows.select("device_id", F.col("_g.eui").alias("gateway_eui"), "time", "organization_id", F.col("_g.rssi").alias("rssi"), F.col("_g.snr").alias("snr"), F.col("link.frame_counter").alias("frame_counter"), "id")
    first = F.min_by(F.struct("organization_id", "rssi", "snr", "frame_counter"), "id").alias("_f")
    return rows.groupBy("device_id", "gateway_eui", "time").agg(first).select("device_id", "gateway_eui", "time", "_f.*")


def canonical(points: DataFrame) -> DataFrame:
    """One row per message of its points: id, device, times, flags, and its metrics by key; a metric says that it is derived only if it is.

    points need message_id (the source's number), organization_id, device_id, metric_key, value, quality, flags, time, received_at, is_virtual.
    """
    derived = F.when(F.col("flags").bitwiseAND(DERIVED) != 0, True)
    metric = F.struct(F.col("metric_key").alias("key"), F.col("value"), F.col("quality"), derived.alias("derived"))
    g = points.groupBy("organization_id", "message_id", "device_id", F.col("time").alias("measured_at"))
    late = F.bool_or(F.col("flags").bitwiseAND(LATE) != 0)
    out = g.agg(F.max("received_at").alias("received_at"), late.alias("late"), F.bool_or("is_virtual").alias("virtual"), F.sort_array(F.collect_list(metric)).alias("metrics"))
    return out.withColumns({"telemetry_id": scalars.telemetry_id(F.col("organization_id"), F.col("message_id")), "metrics": F.to_json("metrics")})


def forecast(source_type: Column, topic: Column) -> Column:
    """Whether a message is a weather forecast: its values are of the future and marked so."""
    return F.coalesce((source_type == "KMA_WEATHER") & F.contains(topic, F.lit("forecast")), F.lit(False))


def stored(points: DataFrame, on_change: DataFrame) -> DataFrame:
    """points, those of the (organization_id, metric_key) in on_change only where they change; all others are stored whole."""
    modes = on_change.select("organization_id", "metric_key", F.lit(True).alias("_change")).distinct()
    rows = points.join(F.broadcast(modes), ["organization_id", "metric_key"], "left").withColumn("_change", F.coalesce("_change", F.lit(False)))
    picked = state.stored_on_change(rows.where("_change")).select("raw_message_id", "metric_key", F.col("flags").alias("_flags"))
    changed = rows.where("_change").join(picked, ["raw_message_id", "metric_key"]).withColumn("flags", F.col("_flags"))
    return rows.where("NOT _change").select(*points.columns).unionByName(changed.select(*points.columns))


def applicable(devices: DataFrame, formulas: DataFrame) -> DataFrame:
    """(device_id, formula_id, ordinal): formulas of a device's model, then its own, then its space's; formulas has target_type, target_id."""
    parts = []
    for rank, (kind, column) in enumerate((("MODEL", "model_id"), ("DEVICE", "device_id"), ("SPACE", "space_id"))):
        f = formulas.where(F.col("target_type") == kind).select(F.col("target_id").alias("_t"), F.col("id").alias("formula_id"))
        parts.append(devices.join(f, F.col(column) == F.col("_t")).select("device_id", "formula_id", F.lit(rank).alias("_rank")))
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return both.select("device_id", "formula_id", F.row_number().over(Window.partitionBy("device_id").orderBy("_rank", "formula_id")).alias("ordinal"))


def heartbeats(messages: DataFrame, now: Column) -> DataFrame:
    """Messages (external_id, payload, time, received_at) of the canary device with heartbeat: sentAt and stages, those that the payload notes under meta.heartbeat, the ingress if it is not among them, and this one."""
    noted = F.from_json(F.get_json_object(F.try_validate_utf8(F.col("payload").cast("string")), "$.meta.heartbeat"), STAGES)
    before = F.coalesce(noted["stages"], F.array().cast("array<struct<name:string,at:string>>"))
    stage = lambda name, at: F.array(F.struct(F.lit(name).alias("name"), scalars.instant_text(at).alias("at")))
    ingress = F.when(F.exists(before, lambda s: F.coalesce(s["name"] == "ingress", F.lit(False))), before).otherwise(F.concat(before, stage("ingress", F.col("received_at"))))
    beat = F.struct(F.coalesce(noted["sentAt"], scalars.instant_text(F.col("time"))).alias("sentAt"), F.concat(ingress, stage("pipeline", now)).alias("stages"))
    return messages.where(F.col("external_id") == HEARTBEAT).withColumn("heartbeat", beat)


def attempts(trace: Column, now: Column, status: Column, error: Column) -> Column:
    """The attempts noted in a message's stored trace (JSON or null), and this one."""
    before = F.from_json(trace, "attempts array<struct<at:string,status:string,errorCode:string>>")["attempts"]
    this = F.struct(scalars.instant_text(now).alias("at"), status.alias("status"), error.alias("errorCode"))
    return F.concat(F.coalesce(before, F.array().cast("array<struct<at:string,status:string,errorCode:string>>")), F.array(this))
