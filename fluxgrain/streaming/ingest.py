"""Raw messages as a stream: read, decode, judge and store in micro-batches; the same functions serve a batch.

State that must outlive a micro-batch is stored, each batch's in a folder of its own that appears whole: ids and keys of messages by received hour, so that replays and
duplicates are told by reading a batch's own hours, registered devices, and points. Series are judged by a second stream with keyed state (series.py).
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fluxgrain.functions import formula, scalars
from fluxgrain.operators import contexts, decode, metrics, quality, state
from fluxgrain.operators import scripts as scripts_
from fluxgrain.sources import segments, store
from fluxgrain.sources.telemetry import DERIVED, TELEMETRY

#: Reporting interval in seconds of a device that has none (fixed value).
DEFAULT_INTERVAL = 300

ENVELOPE = (
    "id bigint, message_id string, organization_id bigint, source_id bigint, source_type string, topic string, payload binary, received_at timestamp, "
    "dedup_key string, virtual boolean, topic_attributes map<string,string>, ingress_status string"
)


def read_envelopes(spark: SparkSession, path: str, per_trigger: int = 16) -> DataFrame:
    """Envelopes from Parquet files as a stream; a file that does not fit the schema ends the stream rather than being skipped."""
    return spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", per_trigger).parquet(path)


def read_log(spark: SparkSession, path: str, rows_per_task: int = 1_000_000) -> DataFrame:
    """Envelopes from a log of segments (sources/segments.py) as a stream that goes on after the last offset of each partition that its checkpoint holds."""
    spark.dataSource.register(segments.Segments)
    return spark.readStream.format("segments").schema(ENVELOPE).option("rowsPerTask", rows_per_task).load(path)


def from_json_lines(lines: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(envelopes, unreadable lines) of JSON text; payloads are base64."""
    text = ENVELOPE.replace("payload binary", "payload string")
    rows = lines.withColumn("_e", F.from_json(column, text + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    bad = F.col("_e").isNull() | F.col("_e._bad").isNotNull() | F.col("_e.message_id").isNull()
    good = rows.where(~bad).select("_e.*").drop("_bad").withColumn("payload", F.unbase64("payload"))
    return good, rows.where(bad).select(F.col(column))


def process(
    messages: DataFrame,
    sources: dict[int, dict],
    devices: DataFrame,
    definitions: DataFrame,
    aliases: DataFrame,
    scripts: dict | None = None,
    seen: DataFrame | None = None,
    suspects: bool = False,
    on_change: DataFrame | None = None,
    policies: DataFrame | None = None,
    formulas: dict[str, str] | DataFrame | None = None,
    transforms: list[tuple[Callable, str]] | list[contexts.Step] | None = None,
    before: DataFrame | None = None,
    keep: Callable[[DataFrame], DataFrame] = store.written,
    history: DataFrame | None = None,
    live: bool = True,
    last: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(messages with status and error, points) of a bounded set of envelopes.

    A message is judged in this order: envelope, signature, source, duplicate, decoding, limits, device, the device's signature, duplicate by content, values. So a copy
    is one whatever its payload or device, unless its key is of its content only (``sha256:``): such a key counts anew in each half reporting interval of the device
    (its interval_sec, if devices has such a column) if the message has neither a time nor a counter of its own, and is judged once the device is known.

    seen: stored messages of the ten minutes before; suspects: judge stuck values and jumps too (definitions then have value_type and
    state_type); on_change: the (organization_id, metric_key) whose points are stored only when they change; policies: sources that register unknown devices
    (metrics.registered()), before: what earlier calls registered, keep: what becomes of this call's registrations (written, as they are read several times);
    formulas: metrics derived from a message's own, which take the place of a metric of the same key: {key: formula}, or by scope, as a table that with_scoped() describes;
    history: stored points that rolling windows look back on; transforms: (function, policy) pairs that
    good messages go through before, or contexts.Step, whose functions see their device (name, model_id, space_id and attributes, as far as devices has them), its last values and windows of
    history, last (device_id, metric_key, value, time) and this call's earlier messages (with_transformed()); live: false for messages that are processed again, which carry no signature.
    """
    signature = F.col("signature_status") if "signature_status" in messages.columns else F.lit(None).cast("string")
    # messages without an id are told apart by the row's own
    named = F.coalesce("message_id", F.concat(F.lit("\0"), F.coalesce("id", F.monotonically_increasing_id()).cast("string")))
    early = F.coalesce(metrics.rejected(messages), metrics.signature_error(F.col("source_type"), signature, F.lit(None).cast("string"), live))
    rows = messages.withColumns({"early": early, "message_id": named, "_signature": signature})
    decoded = decode.overlay(decode.decode(rows, sources, scripts))
    if policies is not None:
        decoded = store.written(decoded)  # read twice: for new devices and for the messages
        known = devices
        if before is not None:
            known = known.select("source_id", "external_id", "device_id", "organization_id", "status", "ignored").unionByName(before.where("accepted").select("source_id", "external_id", "device_id", "organization_id", "status", "ignored"))
        asking = decoded.where("early IS NULL AND error IS NULL")
        new = keep(metrics.registered(asking, known, policies, before=before)).where("accepted")
        devices = known.select("source_id", "external_id", "device_id", "organization_id", "status", "ignored").unionByName(new.drop("seen_at", "accepted", "alarm"))
        decoded = decoded.join(F.broadcast(policies.select("source_id", F.col("policy").alias("_policy")).distinct()), "source_id", "left")  # a source may have all messages
    known = metrics.identified(decoded, devices, None if policies is None else F.col("_policy")).drop("_policy")
    by_content = F.coalesce(F.startswith("dedup_key", F.lit("sha256:")), F.lit(False))
    if "interval_sec" in devices.columns:
        known = known.join(devices.select("device_id", F.col("interval_sec").alias("_interval")).dropDuplicates(["device_id"]).hint("merge"), "device_id", "left")
    else:
        known = known.withColumn("_interval", F.lit(None).cast("int"))
    plain = by_content & F.col("measured_at").isNull() & F.col("link.frame_counter").isNull()
    bucket = state.content_key(F.col("dedup_key"), F.col("received_at"), F.coalesce(F.when(F.col("_interval") > 0, F.col("_interval")), F.lit(DEFAULT_INTERVAL)))
    known = known.withColumns({"dedup_key": F.when(plain, bucket).otherwise(F.col("dedup_key")), "_content": by_content})
    known = state.duplicates(known, seen=seen)
    time, reason = quality.measured_time(F.col("measured_at"), F.col("received_at"), F.col("virtual"))
    sourced = F.coalesce(F.col("source_id").isin(*sources), F.lit(False)) if sources else F.lit(False)
    signed = metrics.signature_error(F.col("source_type"), F.col("_signature"), F.col("device_status"), live)
    copy = F.when(F.col("duplicate"), "ING_DUPLICATE")
    steps = [
        (F.col("early"), F.when(F.col("early") == "ING_DECODE_FAILED", "DECODE_ERROR").otherwise("INVALID")),
        (F.when(~sourced, "ING_DECODE_FAILED"), F.lit("DECODE_ERROR")),
        (F.when(~F.col("_content"), copy), F.lit("DUPLICATE")),
        (F.col("error"), F.lit("DECODE_ERROR")),
        (metrics.over_limits(F.col("values")), F.lit("INVALID")),
        (F.col("device_error"), F.lit("UNKNOWN_DEVICE_REJECTED")),
        (signed, F.lit("INVALID")),
        (copy, F.lit("DUPLICATE")),
    ]
    status = F.lit("OK")
    for code, becomes in reversed(steps):
        status = F.when(code.isNotNull(), becomes).otherwise(status)
    apart = metrics.quarantined(F.col("source_type"), F.col("_signature"), F.col("device_status"), live)
    known = known.withColumns({"time": time, "time_corrected": reason, "result_error": F.coalesce(*[code for code, _ in steps]), "status": status, "_apart": apart})
    each = metrics.points(known.where("status = 'OK'"), definitions, aliases)
    bad = each.where("message_error IS NOT NULL").select("message_id", "message_error").distinct()
    out = known.join(bad.hint("merge"), "message_id", "left").withColumns(
        {"status": F.when(F.col("message_error").isNotNull(), "INVALID").otherwise(F.col("status")), "result_error": F.coalesce("message_error", "result_error")}
    )
    each = each.withColumn("flags", quality.is_late(F.col("time"), F.col("received_at")).cast("smallint")).withColumn("raw_message_id", F.col("id"))
    each = each.withColumns({"derived": F.lit(False), "unverified": F.col("unverified") | F.col("_apart")})
    if transforms:
        each, told = with_transformed(each, definitions, transforms, devices, history, last)
        out = out.join(told.hint("merge"), "message_id", "left").withColumns({"status": F.when(F.col("script_error").isNotNull(), "SCRIPT_ERROR").otherwise(F.col("status")), "result_error": F.coalesce("script_error", "result_error")})
    out = out.withColumn("dropped", F.coalesce("dropped", F.lit(False)) if transforms else F.lit(False))
    if isinstance(formulas, DataFrame):
        each = with_scoped(each, definitions, devices, formulas, history)
    elif formulas:
        each = with_derived(each, definitions, formulas, history)
    each = quality.suspects(each, definitions) if suspects else each.withColumn("suspect", F.lit(False))
    code = quality.quality_code(metrics.forecast(F.col("source_type"), F.col("topic")), F.col("time_corrected").isNotNull(), F.col("out_of_range"), F.col("suspect"), F.col("unverified"))
    late = quality.is_late(F.col("time"), F.col("received_at"))
    points = each.where("message_error IS NULL").select(
        "device_id", "metric_key", "time", "organization_id", "value", code.alias("quality"), (late.cast("int") + F.when(F.col("derived"), DERIVED).otherwise(0)).cast("smallint").alias("flags"), F.coalesce("virtual", F.lit(False)).alias("is_virtual"), "received_at", F.col("id").alias("raw_message_id")
    )
    if on_change is not None:
        points = metrics.stored(points, on_change)
    own = F.when(~F.startswith("message_id", F.lit("\0")), F.col("message_id")).alias("message_id")
    return out.select("id", own, "organization_id", "source_id", "dedup_key", "received_at", "external_id", "device_id", "time", "time_corrected", "status", F.col("result_error").alias("error"), "dropped", "link"), points


#: Columns that a point has for itself; all others are its message's.
OWN = ("metric_key", "value", "unit", "unverified", "out_of_range", "original_key", "derived")


def judged(rows: DataFrame, definitions: DataFrame, columns: list[str]) -> DataFrame:
    """New points (metric_key, value, given unit, derived) with unit, range and state by their definitions, ignored metrics left out."""
    d = definitions.select("metric_key", F.col("unit").alias("_own_unit"), "valid_min", "valid_max", F.col("status").alias("_status"))
    found = rows.join(F.broadcast(d), "metric_key", "left").where("NOT coalesce(_status = 'IGNORED', false)")
    beyond = quality.out_of_range(F.col("value"), F.col("valid_min"), F.col("valid_max"))
    return found.withColumns({"unit": F.coalesce("_own_unit", "unit"), "unverified": F.col("_status").isNull() | (F.col("_status") == "UNVERIFIED"), "out_of_range": beyond}).select(*columns)


def looks_back(functions: list | None) -> bool:
    return any(isinstance(f, contexts.Step) for f in functions or [])


def described(devices: DataFrame) -> DataFrame:
    """(device_id, device): what functions are told of a device, as JSON text with those of its facts that devices has; one row each."""
    facts = [F.col(c).alias(name) for c, name in (("name", "name"), ("model_id", "modelId"), ("space_id", "spaceId"), ("attributes", "attributes")) if c in devices.columns]
    return devices.where("device_id IS NOT NULL").dropDuplicates(["device_id"]).select("device_id", F.to_json(F.struct(F.col("device_id").alias("id"), *facts)).alias("device"))


def with_transformed(points: DataFrame, definitions: DataFrame, functions: list, devices: DataFrame | None = None, history: DataFrame | None = None, last: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(points, (message_id, script_error, dropped)) of good messages that go as JSON through functions(message, context), which may change their metrics.

    A message is {messageId, deviceId, measuredAt, metrics: [{key, value, unit}]}. None drops its points; keys that were not there are derived. What
    breaks the contract (scripts.valid_output()) counts as a failure: of a closed policy if any function has one, else the message stays as it was. Steps (contexts.with_past()), which
    may not be mixed with plain functions, are judged each by its own policy and look back on their device.
    """
    points = store.written(points)  # read several times
    good = points.where("message_error IS NULL")
    shared = [c for c in points.columns if c not in OWN and c != "message_id"]
    metric = F.struct(F.col("metric_key").alias("key"), "value", "unit")
    m = good.groupBy("message_id").agg(F.min_by(F.struct(*shared), "metric_key").alias("_m"), F.sort_array(F.collect_list(metric)).alias("metrics"), F.map_from_entries(F.collect_list(F.struct("metric_key", F.struct("original_key", "derived")))).alias("_before"))
    said = F.to_json(F.struct(F.col("message_id").alias("messageId"), F.col("_m.device_id").alias("deviceId"), scalars.instant_text(F.col("_m.time")).alias("measuredAt"), "metrics"))
    m = m.withColumn("message", said)
    if looks_back(functions):
        if not all(isinstance(f, contexts.Step) for f in functions):
            raise ValueError("steps and plain functions may not be mixed")
        m = m.withColumns({"device_id": F.col("_m.device_id"), "id": F.col("_m.id"), "time": F.col("_m.time"), "received_at": F.col("_m.received_at"), "late": quality.is_late(F.col("_m.time"), F.col("_m.received_at"))})
        m = m.join(described(devices), "device_id", "left") if devices is not None else m.withColumn("device", F.lit(None).cast("string"))
        done = contexts.with_past(m, functions, history, last).drop("device_id", "id", "time", "received_at", "late", "device")
    else:
        done = scripts_.transform(m, functions)
    done = done.withColumn("_r", scripts_.valid_output(F.col("message")))
    broken = F.when(F.col("script_error").isNull() & ~F.col("dropped"), F.col("_r.error"))
    closed = any(f[1] == "FAIL_CLOSED" for f in functions)
    done = done.withColumn("script_error", F.coalesce("script_error", broken) if closed else F.col("script_error"))
    done = store.written(done.withColumn("metrics", F.coalesce("_r.metrics", "metrics")).drop("_r", "message"))
    each = done.where("script_error IS NULL AND NOT dropped").select("message_id", "_m.*", "_before", F.explode("metrics").alias("_v")).select("*", "_v.*").drop("_v").withColumnRenamed("key", "metric_key")
    was = F.try_element_at("_before", F.col("metric_key"))
    each = each.withColumns({"original_key": F.coalesce(was["original_key"], "metric_key"), "derived": F.coalesce(was["derived"], F.lit(True))})
    rest = points.where("message_error IS NOT NULL")
    return rest.unionByName(judged(each, definitions, points.columns)), done.select("message_id", "script_error", "dropped")


def with_derived(points: DataFrame, definitions: DataFrame, formulas: dict[str, str], history: DataFrame | None = None) -> DataFrame:
    """points of good messages and what formulas make of each message's, judged like all others; rolling windows see these points and history."""
    points = store.written(points)  # read several times
    found = formula.evaluate(points.where("message_error IS NULL AND device_id IS NOT NULL"), formulas, by=("message_id",), history=history)
    return replaced(points, found.withColumn("unit", F.lit(None).cast("string")), definitions)


def with_scoped(points: DataFrame, definitions: DataFrame, devices: DataFrame, formulas: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Like with_derived(), with formulas (id, target_type, target_id, result_key, expression, unit) of models, devices and spaces; devices have model_id and space_id then.

    All formulas of a message read the message's own metrics; of those with one result key the last in the order model, device, space, then id, counts. Formulas are a
    configuration: each is compiled once in the driver, and one that cannot be read is left out. Which ones a device has is joined as one row per device.
    """
    compiled = {}
    for f in formulas.select("id", "expression", "result_key").where("result_key IS NOT NULL").collect():
        try:
            formula.parse(f["expression"])
            compiled[str(f["id"])] = f["expression"]
        except formula.FormulaError:  # left out, as said above
            continue
    points = store.written(points)  # read several times
    if not compiled:
        return points
    lists = metrics.applicable(devices, formulas.where(F.col("id").cast("string").isin(*compiled)))
    lists = lists.groupBy("device_id").agg(F.map_from_entries(F.collect_list(F.struct(F.col("formula_id").cast("string"), "ordinal"))).alias("names"))
    found = formula.evaluate(points.where("message_error IS NULL AND device_id IS NOT NULL"), compiled, by=("message_id",), history=history, lists=lists)
    says = formulas.select(F.col("id").cast("string").alias("metric_key"), "result_key", F.col("unit"))
    last = found.join(F.broadcast(says), "metric_key").groupBy("device_id", "time", "message_id", "result_key").agg(F.max_by(F.struct("value", "unit"), "ordinal").alias("_l"))
    return replaced(points, last.select("device_id", "time", "message_id", F.col("result_key").alias("metric_key"), "_l.*"), definitions)


def replaced(points: DataFrame, found: DataFrame, definitions: DataFrame) -> DataFrame:
    """points with the derived ones found (device_id, time, message_id, metric_key, value, unit), each in place of its message's point of the same key."""
    found = store.written(found)  # read twice
    shared = [c for c in points.columns if c not in OWN and c not in ("device_id", "time", "message_id")]
    carriers = points.where("message_error IS NULL").groupBy("message_id").agg(F.first(F.struct(*shared)).alias("_m")).select("message_id", "_m.*")
    new = found.join(carriers.hint("merge"), "message_id").withColumns({"original_key": F.col("metric_key"), "derived": F.lit(True)})
    kept = points.join(found.select("message_id", "metric_key").hint("merge"), ["message_id", "metric_key"], "left_anti")
    return kept.unionByName(judged(new, definitions, points.columns))


REGISTERED = "source_id bigint, external_id string, device_id bigint, organization_id bigint, status string, ignored boolean, seen_at timestamp, accepted boolean, alarm boolean"
#: How far rolling windows look back: 24 hours, and the hour after which a point is late.
LOOK_BACK = datetime.timedelta(hours=26)


def run(envelopes: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None], available_now: bool = True, every: str = "10 seconds") -> StreamingQuery:
    """Start handling micro-batches of envelopes; handle must write by key, as a batch may come again."""
    writer = envelopes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)).start()


IDS = "organization_id bigint, dedup_key string, received_at timestamp, message_id string, slot string, batch bigint"
#: The part of a received time that names the folder of its ids.
HOUR = "yyyyMMddHH"


def earlier_ids(spark: SparkSession, base: str, messages: DataFrame, number: int, slot: str = HOUR) -> DataFrame:
    """Ids and keys that earlier batches stored in the slots in which this batch's messages were received, and ten minutes before each: only those slots' folders are listed, and of their
    files only row groups within the batch's own bounds are read."""
    name = lambda t: F.date_format(t, slot)
    before = F.col("received_at") - F.expr("interval 10 minutes")
    asked = messages.select("received_at", F.explode(F.array(name(F.col("received_at")), name(before))).alias("h")).groupBy("h").agg(F.min("received_at").alias("first"), F.max("received_at").alias("last"))
    slots = asked.where("h IS NOT NULL").collect()  # at most two rows for each slot that the batch spans
    paths = [p for r in slots if store.exists(spark, p := f"{base}/ids/slot={r['h']}")]
    if not paths:
        return spark.createDataFrame([], IDS)
    first, last = min(r["first"] for r in slots), max(r["last"] for r in slots)
    near = F.col("received_at").between(F.lit(first) - F.expr("interval 10 minutes"), F.lit(last))
    return spark.read.schema(IDS).option("basePath", f"{base}/ids").parquet(*paths).where((F.col("batch") < number) & near)


def history(spark: SparkSession, base: str, messages: DataFrame, number: int, slot: str = HOUR) -> DataFrame:
    """The points on which a batch's rolling windows may look back: those of the batches that hold messages received from a day before its first to its last, found by the folders of ids."""
    first, last = messages.agg(F.min("received_at"), F.max("received_at")).first()
    hourly, batches = "HH" in slot, set()
    at = None if first is None else (first - LOOK_BACK).replace(minute=0, second=0, microsecond=0)
    while at is not None and at.date() <= last.date():
        name = f"{at:%Y%m%d%H}" if hourly else f"{at:%Y%m%d}"
        batches |= {int(x.removeprefix("batch=")) for x in store.names(spark, f"{base}/ids/slot={name}") if x.startswith("batch=")}
        at += datetime.timedelta(hours=1 if hourly else 24)
    paths = [f"{base}/points/batch={b}" for b in sorted(batches) if b < number]
    return spark.read.schema(TELEMETRY).parquet(*paths).where(F.col("time") >= F.lit(first) - F.expr("interval 25 hours")) if paths else spark.createDataFrame([], TELEMETRY)


LATEST = "device_id bigint, metric_key string, value double, time timestamp, raw_message_id bigint"


def latest(spark: SparkSession, base: str, number: int) -> DataFrame:
    """The newest values of all series after the batches before ``number``: what the last of them stored, whose size is that of the devices, not of the stream's past."""
    stored = [int(x.removeprefix("batch=")) for x in store.names(spark, f"{base}/latest") if x.startswith("batch=")]
    before = max((b for b in stored if b < number), default=None)
    return spark.createDataFrame([], LATEST) if before is None else spark.read.schema(LATEST).parquet(f"{base}/latest/batch={before}")


def run_stored(envelopes: DataFrame, base: str, sources: dict[int, dict], devices: DataFrame, definitions: DataFrame, aliases: DataFrame, slot: str = HOUR, **options) -> StreamingQuery:
    """process() over a stream, its results in base/messages, base/points and base/links by batch, each published whole (store.published()), so that
    a batch which comes again after a lost driver changes nothing and other streams may read the folders.

    What a later batch must know is stored too: ids and keys by received hour (earlier_ids(); slot ``yyyyMMdd``: by day, for batches that span many hours), for duplicates and replays on both sides of a batch's bounds; registered
    devices and raised alarms in base/registered; points, on which rolling windows and functions look back a day; every series' newest value in base/latest, if functions look back. Stuck values, jumps and storage on change depend on each
    series' points before: they are judged by a stream over base/points with keyed state (series.run_judged()).
    """
    spark = envelopes.sparkSession
    if options.get("suspects") or options.get("on_change") is not None:
        raise ValueError("series.run_judged() judges suspects and changes of a stream")
    registering = options.get("policies") is not None

    def earlier(name: str, shape: str, number: int) -> DataFrame:
        if not store.exists(spark, f"{base}/{name}"):
            return spark.createDataFrame([], shape)
        return spark.read.schema(f"{shape}, batch bigint").parquet(f"{base}/{name}").where(F.col("batch") < number).drop("batch")

    def handle(batch: DataFrame, number: int) -> None:
        if store.exists(spark, f"{base}/points/batch={number}"):  # the last that a batch publishes
            return
        batch = store.written(batch, "batch")  # read several times
        stored = earlier_ids(spark, base, batch, number, slot)
        fresh = state.unseen(batch, stored)
        more = dict(options)
        if registering:
            more |= {"before": earlier("registered", REGISTERED, number), "keep": lambda new: store.published(new, f"{base}/registered/batch={number}")}
        back = looks_back(options.get("transforms"))
        if back or options.get("formulas") is not None:
            more["history"] = history(spark, base, batch, number, slot)
        if back:
            more["last"] = latest(spark, base, number)
        messages, points = process(fresh, sources, devices, definitions, aliases, seen=stored.drop("slot", "batch"), **more)
        messages = store.published(messages, f"{base}/messages/batch={number}")
        links = metrics.link_rows(messages.where("status = 'OK'"))
        store.published(links, f"{base}/links/batch={number}")
        ids = messages.select("organization_id", "dedup_key", "received_at", "message_id", F.date_format("received_at", slot).alias("slot"), F.lit(number).cast("bigint").alias("batch"))
        ids.repartition("slot").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slot", "batch").parquet(f"{base}/ids")
        if back:
            points = store.written(points)
            store.published(state.latest_after(points, more["last"]), f"{base}/latest/batch={number}")
        store.published(points, f"{base}/points/batch={number}")

    return run(envelopes, f"{base}/checkpoint", handle)


def minute_counts(points: DataFrame, grace: str = "30 seconds") -> DataFrame:
    """Live one-minute counts and sums of a stream of points, closed after the grace time; late points are left to recompute()."""
    g = points.withWatermark("time", grace).groupBy("device_id", "metric_key", F.window("time", "1 minute").alias("w"))
    out = g.agg(F.count("*").alias("count_all"), F.sum(F.col("value").cast("decimal(18,6)")).cast("double").alias("sum"))
    return out.select("device_id", "metric_key", F.col("w.start").alias("bucket"), "count_all", "sum")


def last_values(points: DataFrame) -> DataFrame:
    """Live latest value of each series, as a stateful operator: a series' state is one value and its time."""
    import pandas as pd
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def update(key: tuple, frames, held: GroupState):
        value, at = held.get if held.exists else (None, None)
        for f in frames:
            if len(f):
                top = f.sort_values(["us", "raw_message_id"]).iloc[-1]
                if at is None or top["us"] >= at:
                    value, at = float(top["value"]), int(top["us"])
        held.update((value, at))
        yield pd.DataFrame([(*key, value, at)], columns=["device_id", "metric_key", "value", "us"])

    rows = points.select("device_id", "metric_key", "value", F.unix_micros("time").alias("us"), "raw_message_id")
    out = rows.groupBy("device_id", "metric_key").applyInPandasWithState(update, "device_id bigint, metric_key string, value double, us bigint", "value double, us bigint", "update", GroupStateTimeout.NoTimeout)
    return out.select("device_id", "metric_key", "value", F.timestamp_micros("us").alias("time"))
