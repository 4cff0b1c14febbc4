"""Quality of measurements: rules on one row, stateful checks over a device's or a series' rows, and daily scores."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluxgrain.operators import parts
from fluxgrain.sources.telemetry import CORRECTED, FORECAST, GOOD, IMPORTED, LATE, OUT_OF_RANGE, SUSPECT, UNVERIFIED

STUCK_COUNT, JUMP_FRACTION, STUCK_EXEMPT = 12, 0.1875, ("battery",)


def out_of_range(value: Column, low: Column, high: Column) -> Column:
    """Whether a value is beyond its bounds; bounds are inclusive and a null bound bounds nothing."""
    return F.coalesce(value < low, F.lit(False)) | F.coalesce(value > high, F.lit(False))


def is_late(measured: Column, received: Column) -> Column:
    return measured <= received - F.expr("interval 1 hour")


def measured_time(measured: Column, received: Column, keep: Column | None = None) -> tuple[Column, Column]:
    """(time to use, reason it was corrected or null): missing, over five minutes ahead, or over seven days old times become the
    received time; where ``keep`` holds only missing ones do."""
    keep = F.lit(False) if keep is None else F.coalesce(keep, F.lit(False))
    reason = (
        F.when(measured.isNull(), "MISSING")
        .when(keep, None)
        .when(measured > received + F.expr("interval 5 minutes"), "FUTURE")
        .when(measured < received - F.expr("interval 7 days"), "TOO_OLD")
    )
    return F.when(reason.isNull(), measured).otherwise(received), reason


def quality_code(forecast: Column, corrected: Column, beyond: Column, suspect: Column, unverified: Column) -> Column:
    return F.when(forecast, FORECAST).when(corrected, CORRECTED).when(beyond, OUT_OF_RANGE).when(suspect, SUSPECT).when(unverified, UNVERIFIED).otherwise(GOOD).cast("smallint")


def suspects(points: DataFrame, definitions: DataFrame) -> DataFrame:
    """points with suspect: a value equal to the eleven before it, or a change per minute over 3/16 of the valid range.

    definitions: (metric_key, valid_min, valid_max, value_type, state_type). Late points and points not later than all before
    them are not judged and do not count. Ties of time are in the order of raw_message_id.
    """
    d = definitions.select("metric_key", "valid_min", "valid_max", "value_type", "state_type", F.lit(True).alias("defined"))
    late = F.col("flags").bitwiseAND(LATE) != 0
    keys, series = ["device_id", "metric_key"], ["time", "raw_message_id"]
    rows = points.join(F.broadcast(d), "metric_key", "left")
    rows = parts.earlier_max(rows, keys, ["received_at", "raw_message_id"], F.when(~late, F.col("time")), "_top", parts.day("received_at"))
    rows = rows.withColumn("_counts", F.coalesce(~late & (F.col("_top").isNull() | (F.col("time") > F.col("_top"))), F.lit(False)))
    # what counts comes in the order of its times, so that days of arrival are parts of that order too
    some = parts.previous(rows.where("_counts"), keys, series, F.struct("value", "time"), "_last")
    some = parts.run_lengths(some, keys, series, F.coalesce(F.col("_last.value") == F.col("value"), F.lit(False)), "_length")
    number = F.col("value_type").isNull() | (F.upper("value_type") == "NUMBER")
    stuck = F.col("defined") & ~F.coalesce("state_type", F.lit(False)) & number & ~F.col("metric_key").isin(*STUCK_EXEMPT) & F.col("_last").isNotNull() & (F.col("_length") >= STUCK_COUNT)
    gap = F.greatest(F.lit(1.0), (F.unix_millis("time") - F.unix_millis("_last.time")) / 60000.0)
    jump = (F.col("valid_max") > F.col("valid_min")) & (F.abs(F.col("value") - F.col("_last.value")) / gap > (F.col("valid_max") - F.col("valid_min")) * JUMP_FRACTION)
    judged = some.select(*points.columns, (F.coalesce(stuck, F.lit(False)) | F.coalesce(jump, F.lit(False))).alias("suspect"))
    return judged.unionByName(rows.where("NOT _counts").select(*points.columns, F.lit(False).alias("suspect")))


def skew_means(messages: DataFrame) -> DataFrame:
    """Mean skew (measured less received, in seconds) of a device's messages received in the last hour, at each message.

    Means are of whole milliseconds, so they do not depend on the order of summing.
    """
    ms, hour = F.unix_millis("received_at"), 3_600_000
    rows = messages.where(F.col("measured_at").isNotNull() & F.col("received_at").isNotNull() & F.col("device_id").isNotNull())
    rows = rows.withColumns({"_ms": ms, "_skew": F.unix_millis("measured_at") - ms, "_n": F.lit(1).cast("bigint"), "_day": F.floor(ms / 86_400_000)})
    # a day's last hour is looked back on from the next day, so that a device's days are apart
    rows = rows.withColumn("_to", F.explode(F.when(F.col("_ms") % 86_400_000 >= 82_800_000, F.array("_day", F.col("_day") + 1)).otherwise(F.array("_day"))))
    # each message is taken away again once its hour is over, so that a mean is two running sums, not a sum over the hour at each message
    gone = F.col("_ms") + hour + 1
    over = rows.where(F.floor(gone / 86_400_000) == F.col("_to")).select("device_id", "_to", gone.alias("_ms"), (-F.col("_skew")).alias("_skew"), (-F.col("_n")).alias("_n"))
    so_far = Window.partitionBy("device_id", "_to").orderBy("_ms").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    both = rows.withColumn("_own", F.col("_to") == F.col("_day")).unionByName(over, allowMissingColumns=True)
    both = both.withColumn("skew_sec", F.sum("_skew").over(so_far) / F.sum("_n").over(so_far) / 1000.0)
    return both.where("_own").select(*messages.columns, "skew_sec")


def skew_events(messages: DataFrame, threshold: float = 300, sustain: float = 1800, clear: float = 120) -> DataFrame:
    """(device_id, kind, at, since, skew_sec): SUSPECTED once a mean skew over threshold has lasted, CLEARED once it is small again.

    The state after a message depends on that before it, so each device's messages are taken in order, as a stream of sorted
    rows: memory holds a batch, however many messages a device has.
    """
    rows = skew_means(messages).select("device_id", F.unix_millis("received_at").alias("at"), "skew_sec")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        device, since, suspected = None, None, False
        for b in batches:
            out = []
            for d, at, skew in zip(b["device_id"], b["at"], b["skew_sec"]):
                if d != device:
                    device, since, suspected = d, None, False
                if abs(skew) > threshold:
                    since = at if since is None else since
                    if not suspected and at >= since + sustain * 1000:
                        suspected = True
                        out.append((d, "SUSPECTED", at, since, round(skew, 1)))
                elif suspected:
                    if abs(skew) <= clear:
                        out.append((d, "CLEARED", at, since, round(skew, 1)))
                        suspected, since = False, None
                else:
                    since = None
            yield pd.DataFrame(out, columns=["device_id", "kind", "at", "since", "skew_sec"])

    found = rows.repartition("device_id").sortWithinPartitions("device_id", "at").mapInPandas(run, "device_id bigint, kind string, at bigint, since bigint, skew_sec double")
    return found.select("device_id", "kind", F.timestamp_millis("at").alias("at"), F.timestamp_millis("since").alias("since"), "skew_sec")


def daily_counts(points: DataFrame, zones: DataFrame | None = None, default_zone: str = "Asia/Seoul") -> DataFrame:
    """Per device and local day: times received, late ones, values, out of range and suspect ones; imported points do not count."""
    rows = points.where(F.col("flags").bitwiseAND(IMPORTED) == 0)
    zone = F.lit(default_zone)
    if zones is not None:
        rows = rows.join(zones.select("device_id", "timezone").dropDuplicates(["device_id"]), "device_id", "left")
        zone = F.coalesce("timezone", zone)
    late = F.col("flags").bitwiseAND(LATE) != 0
    rows = rows.withColumn("day", F.to_date(F.from_utc_timestamp("time", zone)))
    return rows.groupBy("device_id", "day").agg(
        F.count_distinct("time").alias("received"),
        F.count_distinct(F.when(late, F.col("time"))).alias("late"),
        F.count("*").alias("n_values"),
        F.count(F.when(F.col("quality") == OUT_OF_RANGE, 1)).alias("out_of_range"),
        F.count(F.when(F.col("quality") == SUSPECT, 1)).alias("suspect"),
    )


def half_up(c: Column) -> Column:
    return F.floor(c + 0.5).cast("int")


def daily_score(counts: DataFrame, interval: Column, day_seconds: Column = None) -> DataFrame:
    """counts with completeness, timeliness, validity, stability and score (0 to 100); a null or zero interval is unknown."""
    seconds = F.lit(86400) if day_seconds is None else day_seconds
    known = F.coalesce(interval > 0, F.lit(False))
    pct = lambda part, all_: half_up(part * F.lit(100.0) / all_)
    expected = F.when(known, F.floor(seconds / interval)).otherwise(0).cast("int")
    out = counts.withColumn("expected", expected)
    none = F.col("received") == 0
    complete = F.when(~known | (F.col("expected") == 0), 100).otherwise(pct(F.least("received", "expected"), F.greatest(F.col("expected"), F.lit(1))))
    share = lambda bad, all_: F.when(F.col(all_) == 0, 100).otherwise(pct(F.col(all_) - F.col(bad), F.greatest(F.col(all_), F.lit(1))))
    zero = lambda c: F.when(none, F.lit(0)).otherwise(c).cast("int")
    out = out.withColumns(
        {
            "completeness": F.when(none, F.when(known, 0).otherwise(100)).otherwise(complete).cast("int"),
            "timeliness": zero(share("late", "received")),
            "validity": zero(share("out_of_range", "n_values")),
            "stability": zero(share("suspect", "n_values")),
        }
    )
    rest = F.col("timeliness") + F.col("validity") + F.col("stability")
    # in whole units of 1/10 and 1/3, so that halves are exact: .4/.2/.2/.2, or a third each
    total = F.when(known, F.floor((F.col("completeness") * 4 + rest * 2 + 5) / 10)).otherwise(F.floor((rest * 2 + 3) / 6))
    return out.withColumn("score", zero(total))
