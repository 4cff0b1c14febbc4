"""Operators over the order of a device's or a key's messages: duplicates, storage on change, gaps, silence, latest values, quotas."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluxgrain.operators import parts
from fluxgrain.sources.telemetry import LATE, STATE_CHANGE


def duplicates(messages: DataFrame, window_seconds: int = 600, seen: DataFrame | None = None) -> DataFrame:
    """messages with duplicate: the message before with the same (organization_id, dedup_key) came at most ten minutes earlier.

    Each copy prolongs the time, so copies chain; exactly ten minutes still counts. Messages without a key are none. seen: the (organization_id,
    dedup_key, received_at, message_id) of earlier batches, of which those of the last ten minutes matter (recent()).
    """
    alone = F.when(F.col("dedup_key").isNull(), F.xxhash64("message_id", "received_at") % 4096)  # rows without a key are dealt out
    order = Window.partitionBy("organization_id", "dedup_key", alone).orderBy("received_at", "message_id")
    gap = F.unix_micros("received_at") - F.unix_micros(F.lag("received_at").over(order))
    duplicate = F.coalesce(F.col("dedup_key").isNotNull() & (gap <= window_seconds * 1_000_000), F.lit(False))
    if seen is None:
        return messages.withColumn("duplicate", duplicate)
    keys = seen.select("organization_id", "dedup_key", "received_at", "message_id", F.lit(True).alias("_seen"))
    both = messages.withColumn("_seen", F.lit(False)).unionByName(keys, allowMissingColumns=True)
    return both.withColumn("duplicate", duplicate).where("NOT _seen").drop("_seen")


def unseen(messages: DataFrame, stored: DataFrame) -> DataFrame:
    """messages whose message_id is not stored yet, each id once (the first received): what came again is not written again. Messages without an id all stay."""
    alone = F.when(F.col("message_id").isNull(), F.coalesce("id", F.monotonically_increasing_id()))
    first = messages.withColumn("_alone", alone)
    first = first.withColumn("_n", F.row_number().over(Window.partitionBy("message_id", "_alone").orderBy("received_at", "id"))).where("_n = 1 OR message_id IS NULL")
    return first.join(stored.select("message_id").distinct(), "message_id", "left_anti").select(*messages.columns)


def content_key(key: Column, received: Column, interval_seconds: Column) -> Column:
    """The key of a message known by its content only: the same content counts anew in each half reporting interval."""
    half = F.greatest(F.floor(interval_seconds / 2), F.lit(1))
    return F.concat_ws(":", key, F.floor(F.unix_seconds(received) / half).cast("string"))


def stored_on_change(points: DataFrame, heartbeat_seconds: int = 3600) -> DataFrame:
    """The points that storage on change keeps, flags telling changes: a value unlike the one before, or an hour after the last stored one.

    What is stored depends on what was stored before, so a series is read in order of arrival as a stream of sorted rows:
    memory holds one batch. Points older than the latest are stored without judging. Points without a device, a metric, a time or a value are left out.
    """
    columns = ["device_id", "metric_key", "time", "value", "flags", "received_at", "raw_message_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        series, value, latest, stored = None, None, None, None
        for b in batches:
            keep, change = [], []
            for d, m, t, v in zip(b["device_id"], b["metric_key"], b["us"], b["value"]):
                if (d, m) != series:
                    series, value, latest, stored = (d, m), None, None, None
                changed = value is None or (t >= latest and v != value)
                kept = changed or t < latest or t - stored >= heartbeat_seconds * 1_000_000
                keep.append(kept)
                change.append(changed)
                stored = t if kept else stored
                if latest is None or t >= latest:
                    value, latest = v, t
            b = b.assign(change=change)[keep]
            yield b

    whole = points.dropna(subset=["device_id", "metric_key", "time", "value"])
    rows = whole.select(*columns, F.unix_micros("time").alias("us")).repartition("device_id", "metric_key").sortWithinPartitions("device_id", "metric_key", "received_at", "raw_message_id")
    kinds = "device_id bigint, metric_key string, time timestamp, value double, flags smallint, received_at timestamp, raw_message_id bigint, us bigint, change boolean"
    out = rows.mapInPandas(run, kinds)
    return out.withColumn("flags", F.when(F.col("change"), F.col("flags").bitwiseOR(STATE_CHANGE)).otherwise(F.col("flags")).cast("smallint")).select(*columns)


DAY = 86_400_000_000


def window_values(points: DataFrame, seconds: int, most: int | None = 1440) -> DataFrame:
    """points with recent: the values of the series' points in [time - seconds, time) that are not late, in order of (time, raw_message_id), at most the ``most`` latest (None:
    all); seconds is a day at most. Points without a time have those of the others without one.

    A series is cut into days, each with what the windows of its points look back on of the day before, so that no task has a whole series. A day's values are held once, as one
    array, and a window is a slice of it between two running counts; rows pass one by one. What is written grows with points times values in a window, so the tasks' number is
    not left to the size of what is dealt out.
    """
    if not 0 < seconds * 1_000_000 <= DAY:
        raise ValueError("windows are of a day at most")
    us, key = F.unix_micros("time"), ["device_id", "metric_key", "_to"]
    on_time = F.coalesce(F.col("flags").bitwiseAND(LATE) == 0, F.lit(False))
    last = F.pmod(us, F.lit(DAY)) >= DAY - seconds * 1_000_000
    part = lambda day: F.struct(day.alias("day"), F.col("device_id").isNull().alias("no_device"), F.col("metric_key").isNull().alias("no_metric"))
    here, next_day = part(parts.day("time")), part(F.date_add(parts.day("time"), 1))
    rows = points.withColumn("_to", F.explode(F.when(on_time & last, F.array(here, next_day)).otherwise(F.array(here))))
    rows = rows.withColumns({"device_id": F.coalesce("device_id", F.lit(0)), "metric_key": F.coalesce("metric_key", F.lit(""))})  # keys without nulls, which a join passes over
    rows = rows.repartition(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), *key)
    values = rows.where(on_time).groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("time", "raw_message_id", "value"))).alias("_points")).select(*key, F.col("_points.value").alias("_values"))
    seen = lambda to: F.count(F.when(on_time, 1)).over(Window.partitionBy(*key).orderBy(us).rangeBetween(Window.unboundedPreceding, to)).cast("int")
    rows = rows.withColumns({"_first": F.when(us.isNull(), 0).otherwise(seen(-seconds * 1_000_000 - 1)), "_end": seen(-1)})
    out = rows.where(parts.day("time").eqNullSafe(F.col("_to.day"))).join(values, key, "left")
    first = F.col("_first") if most is None else F.greatest("_first", F.col("_end") - most)
    recent = F.coalesce(F.slice("_values", first + 1, F.col("_end") - first), F.array().cast("array<double>"))
    given = {"device_id": F.when(~F.col("_to.no_device"), F.col("device_id")), "metric_key": F.when(~F.col("_to.no_metric"), F.col("metric_key"))}
    return out.select(*[given[c].alias(c) if c in given else c for c in points.columns], recent.alias("recent"))


def gaps(messages: DataFrame, interval: Column, factor: int = 3) -> DataFrame:
    """(device_id, gap_start, gap_end, expected_count): silences of at least ``factor`` reporting intervals before a message."""
    rows = messages.withColumn("interval_sec", interval).where(F.col("interval_sec") > 0)
    rows = parts.earlier_max(rows, ["device_id"], ["received_at"], F.col("received_at"), "seen", parts.day("received_at"))
    silent = (F.unix_micros("received_at") - F.unix_micros("seen")) / 1_000_000
    rows = rows.where(silent >= factor * F.col("interval_sec"))
    return rows.select("device_id", F.col("seen").alias("gap_start"), F.col("received_at").alias("gap_end"), F.floor(silent / F.col("interval_sec")).cast("int").alias("expected_count")).dropDuplicates(["device_id", "gap_start"])


def offline(messages: DataFrame, now: Column, interval: Column, multiplier: Column) -> DataFrame:
    """(device_id, last_seen, connectivity) at ``now``: OFFLINE after a silence of more than interval times multiplier."""
    seen = messages.withColumns({"i": interval, "x": multiplier}).groupBy("device_id").agg(F.max("received_at").alias("last_seen"), F.max("i").alias("i"), F.max("x").alias("x"))
    limit = F.floor(F.col("i") * F.col("x") * 1000 + 0.5)
    off = (F.unix_micros(now) - F.unix_micros("last_seen")) / 1000 > limit
    return seen.select("device_id", "last_seen", F.when(off, "OFFLINE").otherwise("ONLINE").alias("connectivity"))


def latest_values(points: DataFrame) -> DataFrame:
    """Per device and metric the value of the latest time; of equal times the one that came last."""
    order = F.struct("time", "received_at", "raw_message_id")
    return points.groupBy("device_id", "metric_key").agg(F.max_by("value", order).alias("value"), F.max("time").alias("time"), F.max_by("quality", order).alias("quality"))


def latest_maps(points: DataFrame) -> DataFrame:
    """Per device the map of its metrics' latest values, its last measured and last received time."""
    v = latest_values(points).groupBy("device_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("metric_key", "value")))).alias("latest"), F.max("time").alias("last_measured_at"))
    seen = points.groupBy("device_id").agg(F.max("received_at").alias("last_seen_at"))
    return v.join(seen, "device_id")


def latest_after(points: DataFrame, before: DataFrame) -> DataFrame:
    """before (device_id, metric_key, value, time, raw_message_id), brought up to date by points in order of arrival: a message that is not older than its device's newest one replaces the values of its metrics."""
    names = ["device_id", "metric_key", "value", "time", "raw_message_id"]
    held = before.groupBy("device_id").agg(F.max("time").alias("_held"))
    order = F.struct("received_at", "raw_message_id")
    earlier = F.max("time").over(Window.partitionBy("device_id").orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    rows = points.select(*names, "received_at").join(held, "device_id", "left").withColumn("_top", F.greatest(earlier, "_held")).where("time >= _top")
    new = rows.select(*names, F.struct("time", F.col("received_at"), "raw_message_id").alias("_o"))
    old = before.select(*names, F.struct("time", F.lit(None).cast("timestamp").alias("received_at"), "raw_message_id").alias("_o"))
    best = old.unionByName(new).groupBy("device_id", "metric_key").agg(F.max_by(F.struct("value", "time", "raw_message_id"), "_o").alias("_l"))
    return best.select("device_id", "metric_key", "_l.*")


STATE_FIELDS = ("battery", "rssi", "snr", "gateway")


def device_states(messages: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Per device: organization_id, last_seen_at, last_measured_at, latest (map), battery, rssi, snr, gateway and timezone after messages in order of arrival (received_at, id).

    messages: device_id, organization_id, id, received_at, measured_at, latest as map<string,double>, battery, rssi, snr, gateway, timezone. A message whose measured time is not before all that
    arrived earlier adds its values to the map and replaces what it has of the fields; what it has not stays. Other messages count as seen only. The zone is the last one given.
    before: rows of an earlier call, so that states may be kept from batch to batch; merging in parts gives what merging all at once does. Besides the running maximum
    of times, all is grouped aggregates, per device and per device and key.
    """
    rows = messages.select("device_id", "organization_id", F.struct("received_at", "id").alias("_at"), F.col("received_at").alias("seen"), F.col("measured_at").alias("measured"), "latest", *STATE_FIELDS, "timezone")
    if before is not None:
        first = F.struct(F.lit("0001-01-01").cast("timestamp").alias("received_at"), F.lit(0).cast(messages.schema["id"].dataType).alias("id"))
        rows = rows.unionByName(before.select("device_id", "organization_id", first.alias("_at"), F.col("last_seen_at").alias("seen"), F.col("last_measured_at").alias("measured"), "latest", *STATE_FIELDS, "timezone"))
    top = F.max("measured").over(Window.partitionBy("device_id").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("newest", F.coalesce(F.col("measured") >= top, F.col("measured").isNotNull()))
    order = F.struct("measured", "_at")
    last = lambda c: F.max_by(F.when(F.col("newest"), F.col(c)), F.when(F.col("newest") & F.col(c).isNotNull(), order)).alias(c)
    zone = F.max_by("timezone", F.when(F.col("timezone").isNotNull(), F.col("_at"))).alias("timezone")
    state = rows.groupBy("device_id").agg(F.max_by("organization_id", "_at").alias("organization_id"), F.max("seen").alias("last_seen_at"), F.max("measured").alias("last_measured_at"), *[last(c) for c in STATE_FIELDS], zone)
    keys = rows.where("newest").select("device_id", order.alias("_o"), F.explode("latest").alias("key", "value")).groupBy("device_id", "key").agg(F.max_by("value", "_o").alias("value"))
    maps = keys.groupBy("device_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "value")))).alias("latest"))
    out = state.join(maps, "device_id", "left").withColumn("latest", F.coalesce("latest", F.create_map().cast("map<string,double>")))
    return out.select("device_id", "organization_id", "last_seen_at", "last_measured_at", "latest", *STATE_FIELDS, "timezone")


def changed_counts(messages: DataFrame, states: DataFrame, now: Column) -> DataFrame:
    """(device_id, messages_24h) of the states (device_id, messages_24h) whose number of good messages in the last 24 hours is another one now; devices without messages have 0."""
    counted = messages_last_day(messages.where("status = 'OK'"), now).select("device_id", F.col("messages_24h").alias("_n"))
    rows = states.join(counted, "device_id", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    return rows.where(~F.col("messages_24h").eqNullSafe(F.col("_n"))).select("device_id", F.col("_n").alias("messages_24h"))


def registrations(first_seen: DataFrame, limit: int | Column = 100, window: str = "hour", before: DataFrame | None = None) -> DataFrame:
    """first_seen (source_id, external_id, seen_at) of unknown devices with accepted and alarm: so many a source and hour, the first
    one beyond raises the alarm. before: what earlier calls said (source_id, seen_at, accepted, alarm); its hours' places are taken and its alarms raised."""
    at = F.date_trunc(window, "seen_at")
    rows = first_seen.withColumn("_hour", at).withColumn("n", F.row_number().over(Window.partitionBy("source_id", "_hour").orderBy("seen_at", "external_id")))
    held, raised = F.lit(0), F.lit(False)
    if before is not None:
        taken = before.groupBy("source_id", at.alias("_hour")).agg(F.count(F.when(F.col("accepted"), 1)).alias("_held"), F.bool_or("alarm").alias("_raised"))
        rows = rows.join(taken, ["source_id", "_hour"], "left")
        held, raised = F.coalesce("_held", F.lit(0)), F.coalesce("_raised", F.lit(False))
    place = F.col("n") + held
    return rows.select(*first_seen.columns, (place <= limit).alias("accepted"), ((place == limit + 1) & ~raised).alias("alarm"))


def messages_last_day(messages: DataFrame, now: Column) -> DataFrame:
    rows = messages.where((F.col("received_at") > now - F.expr("interval 24 hours")) & (F.col("received_at") <= now))
    return rows.groupBy("device_id").agg(F.count("*").alias("messages_24h"))


def gateways_last_seen(links: DataFrame) -> DataFrame:
    return links.where(F.col("gateway_eui").isNotNull() & (F.col("gateway_eui") != "")).groupBy("organization_id", "gateway_eui").agg(F.max("time").alias("last_seen_at"))


def lag_level(backlog: DataFrame, now: Column) -> DataFrame:
    """One row: the worst partition's lag in seconds and its level (over a minute WARNING, over five CRITICAL); a single
    grouped maximum, with one row per partition before it."""
    each = backlog.groupBy("partition").agg(F.max("received_at").alias("at"))
    worst = each.agg(F.max((F.unix_micros(now) - F.unix_micros("at")) / 1_000_000).alias("lag_sec"))
    return worst.select("lag_sec", F.when(F.col("lag_sec") > 300, "CRITICAL").when(F.col("lag_sec") > 60, "WARNING").otherwise("OK").alias("level"))


def level_changes(levels: DataFrame, at: str = "at") -> DataFrame:
    """(at, kind, level) of a series of evaluated levels: RAISED where a level other than OK is new, CLEARED where it is OK again; nothing while it stays."""
    rows = levels.withColumns({parts.PART: parts.day(at), "_one": F.lit(1)})  # only days' last levels meet in one task
    rows = parts.previous(rows, ["_one"], [at], F.struct("level"), "_before").withColumn("_was", F.coalesce("_before.level", F.lit("OK")))
    rows = rows.where(F.col("level") != F.col("_was"))
    return rows.select(at, F.when(F.col("level") == "OK", "CLEARED").otherwise("RAISED").alias("kind"), "level")


def connectivity_events(messages: DataFrame, interval: Column, multiplier: Column) -> DataFrame:
    """(device_id, kind, at): ONLINE at a device's first message and at each one after a silence of more than interval times
    multiplier, OFFLINE when such a silence has lasted that long."""
    rows = messages.select("device_id", "received_at", F.floor(interval * multiplier * 1000 + 0.5).cast("bigint").alias("limit_ms"))
    rows = parts.earlier_max(rows, ["device_id"], ["received_at"], F.col("received_at"), "seen", parts.day("received_at"))
    back = F.col("seen").isNull() | ((F.unix_micros("received_at") - F.unix_micros("seen")) / 1000 > F.col("limit_ms"))
    rows = rows.where(back)
    gone = F.timestamp_micros(F.unix_micros("seen") + F.col("limit_ms") * 1000)
    events = F.array(F.struct(F.lit("ONLINE").alias("kind"), F.col("received_at").alias("at")), F.struct(F.lit("OFFLINE").alias("kind"), gone.alias("at")))
    return rows.select("device_id", F.inline(events)).where("at IS NOT NULL").distinct()


def uplink_signals(messages: DataFrame) -> DataFrame:
    """(device_id, message_id, version) of uplinks of active, real devices: the topic's event is up or, without one, the decoder is
    the LoRaWAN one; the version is the frame counter or else the received time in milliseconds."""
    event = F.regexp_extract(F.coalesce("topic", F.lit("")), "/event/([^/]+)$", 1)
    up = F.when(event != "", event == "up").otherwise(F.coalesce(F.col("decoder") == "chirpstack-v4", F.lit(False)))
    rows = messages.where((F.col("status") == "ACTIVE") & ~F.coalesce("virtual", F.lit(False)) & up)
    return rows.select("device_id", "message_id", F.coalesce(F.when(F.col("frame_counter") >= 0, F.col("frame_counter")), F.unix_millis("received_at")).alias("version"))
