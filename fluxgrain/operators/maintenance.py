"""Changes to stored tables: insert-ignore and upsert, renamed metrics, retention, archives, dead letters, repeats of processing.

Tables are DataFrames in and DataFrames out; sources.store writes them. Nothing is updated in place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluxgrain.functions import scalars
from fluxgrain.sources.telemetry import DERIVED, REPROCESSED

KEY = ["device_id", "metric_key", "time"]


def insert_ignore(stored: DataFrame, new: DataFrame, key: list[str] = KEY, order: str = "raw_message_id") -> DataFrame:
    """stored with those rows of new whose key it lacks; of new rows with one key the first by ``order``."""
    first = new.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(order))).where("_n = 1").drop("_n")
    return stored.unionByName(first.join(stored.select(*key), key, "left_anti").select(*stored.columns))


def upsert(stored: DataFrame, new: DataFrame, key: list[str] = KEY, order: str = "raw_message_id") -> DataFrame:
    """stored with new's rows in place of those with the same key; of new rows with one key the last by ``order``."""
    last = new.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc(order)))).where("_n = 1").drop("_n")
    return stored.join(last.select(*key), key, "left_anti").select(*stored.columns).unionByName(last.select(*stored.columns))


def remap(points: DataFrame, alias: str, target: str) -> DataFrame:
    """points with metric ``alias`` as ``target`` (flag 4); where the target has a point of that time already, it stays and the alias's goes."""
    old = points.where(F.col("metric_key") == alias)
    taken = points.where(F.col("metric_key") == target).select("device_id", "time")
    moved = old.join(taken, ["device_id", "time"], "left_anti").withColumns({"metric_key": F.lit(target), "flags": F.col("flags").bitwiseOR(REPROCESSED).cast("smallint")})
    return points.where(F.col("metric_key") != alias).unionByName(moved.select(*points.columns))


def remap_dirty(points: DataFrame, alias: str, target: str) -> DataFrame:
    """The minutes of both metrics that remap() changes."""
    m = F.date_trunc("minute", "time")
    rows = points.where(F.col("metric_key") == alias).select("device_id", F.explode(F.array(F.lit(alias), F.lit(target))).alias("metric_key"), m.alias("from_time"))
    return rows.distinct().select("*", (F.col("from_time") + F.expr("interval 1 minute")).alias("to_time"), F.lit("REMAP").alias("reason"))


def retention_days(points: DataFrame, policies: DataFrame, devices: DataFrame | None = None) -> DataFrame:
    """points with org_days, metric_days, model_days (null: no such policy; 0: for ever). policies: (organization_id, scope, scope_ref, retain_days)."""
    p = lambda scope: policies.where(F.col("scope") == scope)
    org = p("ORG").groupBy("organization_id").agg(F.min("retain_days").alias("org_days"))
    metric = p("METRIC").groupBy("organization_id", F.col("scope_ref").alias("metric_key")).agg(F.min("retain_days").alias("metric_days"))
    rows = points.join(org, "organization_id", "left").join(metric, ["organization_id", "metric_key"], "left")
    if devices is None:
        return rows.withColumn("model_days", F.lit(None).cast("int"))
    model = p("MODEL").select("organization_id", F.col("scope_ref").alias("_ref"), "retain_days")
    own = devices.select("device_id", F.explode(F.array_compact(F.array(F.col("model_id").cast("string"), "model_code"))).alias("_ref"), "organization_id")
    by_device = own.join(model, ["organization_id", "_ref"]).groupBy("device_id").agg(F.min("retain_days").alias("model_days"))
    return rows.join(by_device, "device_id", "left")


def expired(now: Column, default_days: int = 365) -> Column:
    """Whether a row of retention_days() goes: any shorter override deletes it, a longer one exempts it from the organisation's days. An organisation that keeps
    for ever (0 days) loses nothing, whatever its overrides say."""
    age = lambda days: (days > 0) & (F.col("time") < now - F.make_dt_interval(days=days))
    org = F.coalesce("org_days", F.lit(default_days))
    forever = lambda d: (d == 0) | ((d > org) & (org > 0))
    shorter = lambda d: (d > 0) & ((d <= org) | (org == 0)) & age(d)
    no = F.lit(False)
    metric, model = F.col("metric_days"), F.col("model_days")
    exempt = F.coalesce(forever(metric), no) | F.coalesce(forever(model), no)
    own = F.coalesce(age(metric), no) | F.coalesce(age(model), no)
    gone = F.coalesce(shorter(metric), no) | F.coalesce(shorter(model), no) | F.when(exempt, own).otherwise(F.coalesce(age(org), no))
    return (org > 0) & gone


def purge(points: DataFrame, policies: DataFrame, now: Column, devices: DataFrame | None = None, manifest: DataFrame | None = None, archiving: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(points that stay, what went: organization_id, by, n_rows, archived) by the policies of retention_days().

    Organisations in archiving (organization_id) lose by their own days only whole months that the manifest (organization_id, month) holds, up to the first month that it
    lacks; shorter overrides delete what they name all the same. Which months an organisation has is a grouped minimum over months, not over rows.
    """
    rows = retention_days(points, policies, devices).withColumn("_gone", expired(now))
    org = F.coalesce("org_days", F.lit(365))
    named = F.coalesce((F.col("metric_days") > 0) & (F.col("time") < now - F.make_dt_interval(days="metric_days")), F.lit(False)) | F.coalesce((F.col("model_days") > 0) & (F.col("time") < now - F.make_dt_interval(days="model_days")), F.lit(False))
    rows = rows.withColumn("_by", F.when(F.col("_gone"), F.when(named, "OVERRIDE").otherwise("ORG")))
    if archiving is not None:
        month = F.date_format("time", "yyyy-MM")
        own = rows.join(archiving.select("organization_id", F.lit(True).alias("_archives")).distinct(), "organization_id", "left")
        wanted = own.where("_archives AND _by = 'ORG'").groupBy("organization_id", month.alias("month")).agg(F.first("org_days").alias("org_days"))
        cutoff = F.date_trunc("month", now - F.make_dt_interval(days=org))
        lacking = wanted if manifest is None else wanted.join(manifest.select("organization_id", "month").distinct(), ["organization_id", "month"], "left_anti")
        hole = lacking.groupBy("organization_id").agg(F.min(F.to_timestamp("month", "yyyy-MM")).alias("_hole"))
        own = own.join(hole, "organization_id", "left")
        kept_back = F.col("_archives") & (F.col("_by") == "ORG") & (F.col("time") >= F.least(cutoff, "_hole"))
        rows = own.withColumn("_by", F.when(~F.coalesce(kept_back, F.lit(False)), F.col("_by")))
    else:
        rows = rows.withColumn("_archives", F.lit(None).cast("boolean"))
    went = rows.where("_by IS NOT NULL").groupBy("organization_id", F.col("_by").alias("by")).agg(F.count("*").alias("n_rows"), F.bool_or(F.coalesce("_archives", F.lit(False)) & (F.col("_by") == "ORG")).alias("archived"))
    return rows.where("_by IS NULL").select(*points.columns), went


def expired_month(points: DataFrame, policies: DataFrame, before: Column, devices: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(points that stay, rows of months that ended by ``before`` which go to the long table because an override keeps them longer). What else an old month still has stays in it,
    such as rows that wait for the archive: purge() alone deletes, and a month may be dropped once it has no rows."""
    ends = F.add_months(F.date_trunc("month", "time"), 1).cast("timestamp")
    rows = retention_days(points, policies, devices)
    org = F.coalesce("org_days", F.lit(365))
    longer = lambda d: F.coalesce((F.col(d) == 0) | (F.col(d) > org), F.lit(False))
    moves = (ends <= before) & (longer("metric_days") | longer("model_days"))
    return rows.where(~moves).select(*points.columns), rows.where(moves).select(*points.columns)


def confirmed(scores: DataFrame, already: DataFrame, zones: DataFrame, now: Column, default_zone: str = "Asia/Seoul") -> DataFrame:
    """The daily scores that become final at ``now``: of each device's last whole local day (from half past midnight on; before that of the day before), unless one is final already."""
    rows = scores.join(zones.select("device_id", "timezone").dropDuplicates(["device_id"]), "device_id", "left")
    local = F.from_utc_timestamp(now, F.coalesce("timezone", F.lit(default_zone)))
    due = F.date_sub(F.to_date(local - F.expr("interval 30 minutes")), 1)
    return rows.where(F.col("day") == due).select(*scores.columns).join(already.select("device_id", "day"), ["device_id", "day"], "left_anti")


def retention_preview(points: DataFrame, policies: DataFrame, now: Column, devices: DataFrame | None = None) -> DataFrame:
    """Per organisation the rows, those that retention would delete, and their share in percent."""
    rows = retention_days(points, policies, devices).withColumn("_gone", expired(now))
    out = rows.groupBy("organization_id").agg(F.count("*").alias("n_rows"), F.count(F.when(F.col("_gone"), 1)).alias("n_expired"))
    return out.withColumn("percent", F.round((F.col("n_expired") * 100 / F.col("n_rows")).cast("decimal(12,6)"), 1).cast("double"))


def retention_preview_items(tables: dict[str, tuple[DataFrame, str, int]], items: list[tuple[str, str | None, str, int]], organization_id: int, now: Column) -> DataFrame:
    """(position, scope, scope_ref, data_class, n_rows, n_bytes) for each item (scope, scope_ref, data_class, retain_days): the organisation's rows older
    than its days, and their part of the table's bytes.

    tables: data class -> (rows, time column, bytes of the table). 0 days keep for ever. METRIC items count their metric's rows where the table has metrics.
    A table is scanned once for all of its items, by one global aggregate with partial sums.
    """
    if unknown := {c for _, _, c, _ in items} - tables.keys():
        raise ValueError(f"unknown data classes {sorted(unknown)}")
    out = []
    for name, (rows, time, size) in tables.items():
        own = [(i, *item) for i, item in enumerate(items) if item[2] == name]
        if not own:
            continue
        counts = [F.count("*").alias("n")]
        for i, scope, ref, _, days in own:
            old = (F.col("organization_id") == organization_id) & (F.col(time) < now - F.expr(f"interval {int(days)} days")) if days else F.lit(False)
            if scope.upper() == "METRIC" and ref is not None and "metric_key" in rows.columns:
                old &= F.col("metric_key") == ref
            counts.append(F.count(F.when(old, 1)).alias(f"n{i}"))
        text = lambda x: F.lit(x).cast("string")
        part = lambda i: F.coalesce(F.floor(F.try_divide(F.lit(size).cast("decimal(20,0)") * F.col(f"n{i}"), F.col("n"))), F.lit(0)).cast("bigint")
        structs = [F.struct(F.lit(i).alias("position"), text(s).alias("scope"), text(r).alias("scope_ref"), text(c).alias("data_class"), F.col(f"n{i}").alias("n_rows"), part(i).alias("n_bytes")) for i, s, r, c, _ in own]
        out.append(rows.agg(*counts).select(F.inline(F.array(*structs))))
    return reduce(DataFrame.unionByName, out)


def reprocess_targets(raw: DataFrame, source_id: int, start: Column, end: Column, only_failed: bool = False, device_ids: list[int] | None = None, after_id: int = 0) -> DataFrame:
    """The raw messages that a repeat of processing takes, in the order of their ids: duplicates never, OK ones unless only failed ones are asked for."""
    rows = raw.where((F.col("source_id") == source_id) & (F.col("received_at") >= start) & (F.col("received_at") < end) & (F.col("id") > after_id) & (F.col("status") != "DUPLICATE"))
    if only_failed:
        rows = rows.where(F.col("status") != "OK")
    return rows.where(F.col("device_id").isin(device_ids)) if device_ids else rows


def progress_percent(done: Column, total: Column) -> Column:
    return F.when(total == 0, F.lit(100.0)).otherwise(F.round((F.least(done, total) * F.lit(100) / total).cast("decimal(20,8)"), 1).cast("double"))


def reprocess_finished(jobs: DataFrame, outcomes: DataFrame, now: Column) -> DataFrame:
    """The events of repeats that are over: status COMPLETED, FAILED (the job has an error) or CANCELLED, counts and percentage; jobs that go on are left out.

    jobs: (job_id, organization_id, source_id, total, cancelled, error); outcomes: (job_id, status, replayed), one per target that is done, status null if its raw message is gone. Such ones and
    replayed ones (the same result as before) are skipped; others are processed, failed unless OK or DUPLICATE.
    """
    skipped = F.col("status").isNull() | F.coalesce("replayed", F.lit(False))
    counted = outcomes.groupBy("job_id").agg(F.count(F.when(~skipped, 1)).alias("processed"), F.count(F.when(~skipped & ~F.col("status").isin("OK", "DUPLICATE"), 1)).alias("failed"), F.count(F.when(skipped, 1)).alias("skipped"))
    rows = jobs.join(counted, "job_id", "left").na.fill(0, ["processed", "failed", "skipped"])
    status = F.when(F.col("cancelled"), "CANCELLED").when(F.col("error").isNotNull(), "FAILED").when(F.col("processed") + F.col("skipped") >= F.col("total"), "COMPLETED")
    rows = rows.withColumns({"status": status, "percent": progress_percent(F.col("processed"), F.col("total")), "finished_at": now}).where("status IS NOT NULL")
    return rows.select("job_id", "organization_id", "source_id", "status", "total", "processed", "failed", "skipped", "percent", "error", "finished_at")


def dead_letters(open_items: DataFrame, failures: DataFrame) -> DataFrame:
    """One open item per raw message: failures (raw_message_id, stage, code, at) raise the attempts of open items or open new ones."""
    f = failures.groupBy("raw_message_id").agg(F.max_by("stage", "at").alias("stage"), F.max_by("code", "at").alias("code"), F.count("*").cast("int").alias("n"), F.min("at").alias("first_at"), F.max("at").alias("last_at"))
    o = open_items.select("raw_message_id", F.col("stage").alias("o_stage"), F.col("code").alias("o_code"), "attempts", F.col("first_at").alias("o_first"), F.col("last_at").alias("o_last"))
    both = o.join(f, "raw_message_id", "full")
    return both.select("raw_message_id", F.coalesce("stage", "o_stage").alias("stage"), F.coalesce("code", "o_code").alias("code"), (F.coalesce("attempts", F.lit(0)) + F.coalesce("n", F.lit(0))).cast("int").alias("attempts"), F.least("o_first", "first_at").alias("first_at"), F.greatest("o_last", "last_at").alias("last_at"))


def derived_points(points: DataFrame, devices: DataFrame, now: Column) -> DataFrame:
    """points (organization_id, device_id, metric_key, time, value) from outside with reason (null if they are taken, else why not) and times cut to milliseconds.

    devices: (device_id, organization_id, status). Keys are of the stricter shape without capitals; a device of another organisation is unknown.
    """
    known = devices.select("device_id", F.col("organization_id").alias("_org"), F.upper("status").alias("_status")).dropDuplicates(["device_id"])
    rows = points.join(known, "device_id", "left")
    reason = (
        F.when(F.col("_org").isNull() | (F.col("_org") != F.col("organization_id")), "UNKNOWN_DEVICE")
        .when(F.coalesce(F.col("_status").isin("DELETED", "INACTIVE"), F.lit(False)), "DEVICE_INACTIVE")
        .when(~F.coalesce(F.col("metric_key").rlike("^[a-z][a-z0-9_]{0,63}$"), F.lit(False)), "INVALID_METRIC")
        .when(F.col("value").isNull() | F.isnan("value") | (F.abs("value") == float("inf")), "INVALID_VALUE")
        .when(F.col("time").isNull(), "INVALID_TIME")
        .when(F.col("time") > now + F.expr("interval 5 minutes"), "FUTURE_TIME")
    )
    return rows.select(*[c for c in points.columns if c != "time"], F.date_trunc("millisecond", "time").alias("time"), reason.alias("reason"))


def stored_derived(judged: DataFrame, now: Column, watermark: Column | None = None, order: str = "position") -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(rows, messages, latest, dirty) of the points that derived_points() took (reason is null): what is to be upserted, published, merged into device states and rolled up anew.

    rows: as telemetry, one per device, metric and millisecond, of several the one given last by ``order``. messages: one for each device and instant, whose id is the same whenever the same metrics are
    sent again (scalars.derived_id()). latest: (device_id, metric_key, value, time) of each device's newest instant. dirty: the minutes before the watermark, as late data are.
    judged should be a stored table, as all four read it.
    """
    taken = judged.where("reason IS NULL").groupBy("organization_id", "device_id", "metric_key", "time").agg(F.max_by("value", order).alias("value"))
    rows = taken.select("device_id", "metric_key", "time", "organization_id", "value", F.lit(0).cast("smallint").alias("quality"), F.lit(DERIVED).cast("smallint").alias("flags"), F.lit(False).alias("is_virtual"), now.alias("received_at"), F.lit(None).cast("bigint").alias("raw_message_id"))
    metric = F.struct(F.col("metric_key").alias("key"), "value")
    messages = taken.groupBy("organization_id", "device_id", F.col("time").alias("measured_at")).agg(F.sort_array(F.collect_list(metric)).alias("metrics"))
    messages = messages.withColumns({"message_id": scalars.derived_id(F.col("device_id"), F.col("measured_at"), F.col("metrics.key")), "received_at": now, "late": F.lit(False), "derived": F.lit(True)})
    newest = messages.groupBy("device_id").agg(F.max_by("metrics", "measured_at").alias("_m"), F.max("measured_at").alias("time"))
    latest = newest.select("device_id", "time", F.inline("_m")).select("device_id", F.col("key").alias("metric_key"), "value", "time")
    start = F.date_trunc("minute", "time")
    late = F.lit(False) if watermark is None else F.col("time") < watermark
    dirty = taken.where(late).select("organization_id", F.lit("1m").alias("level"), "device_id", "metric_key", start.alias("start"), (start + F.expr("interval 1 minute")).alias("end"), F.lit("LATE").alias("reason")).distinct()
    return rows, messages, latest, dirty


def misplaced(existing: DataFrame, rows: DataFrame, table: str, now: Column, warned: DataFrame | None = None) -> DataFrame:
    """The warnings (table, reason, n_rows, day) of a day for rows (month as yyyy-MM) that no partition of the table holds; at most one for a table and day.

    existing: the partitions there are (month); warned: warnings given before (table, day). Rows are counted by month before they meet the partitions.
    """
    counted = rows.groupBy("month").agg(F.count("*").alias("_n")).join(existing.select("month").distinct(), "month", "left_anti")
    out = counted.groupBy(F.lit(table).alias("table"), F.lit("DEFAULT_PARTITION_ROWS").alias("reason")).agg(F.sum("_n").alias("n_rows")).withColumn("day", F.to_date(now))
    return out if warned is None else out.join(warned.select("table", "day").distinct(), ["table", "day"], "left_anti").select(*out.columns)


def missing_months(existing: DataFrame, now: Column, ahead: int = 3) -> DataFrame:
    """The months from now's on, ``ahead`` more, that no partition in existing (month as yyyy-MM) holds."""
    first = F.date_trunc("month", now)
    wanted = existing.sparkSession.range(1).select(F.explode(F.sequence(first, F.add_months(first, ahead).cast("timestamp"), F.expr("interval 1 month"))).alias("m"))
    return wanted.select(F.date_format("m", "yyyy-MM").alias("month")).join(existing.select("month").distinct(), "month", "left_anti")


def expired_days(existing: DataFrame, now: Column, keep_days: int) -> DataFrame:
    """Daily partitions (day as yyyy-MM-dd) that are older than the days kept and one more."""
    return existing.where(F.to_date("day") < F.date_sub(F.to_date(now), keep_days + 1)).select("day").distinct()


def known_zone(zone: Column) -> Column:
    """The zone if it is a name of the time zone database, else null; offsets are none."""
    from zoneinfo import available_timezones

    return F.when(zone.isin(sorted(available_timezones())), zone)
