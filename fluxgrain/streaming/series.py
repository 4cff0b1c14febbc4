"""Series and devices as keyed state of a stream: stuck values, jumps, storage on change, silence and latest values across micro-batches.

Each key's state is a few typed numbers in Spark's state store (RocksDB, so it need not fit in memory) under the query's checkpoint: a restart goes on where the last
committed batch ended, and a batch that is repeated starts from the state before it. Of a key no more rows are in memory than one micro-batch has. A new query may be started from
stored tables (seeds()).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from fluxgrain.operators import quality, state
from fluxgrain.sources import store
from fluxgrain.sources.telemetry import CORRECTED, FORECAST, LATE, OUT_OF_RANGE, STATE_CHANGE, SUSPECT, TELEMETRY

PROVIDER, ROCKS = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Last judged value, its time and how often it came in a row; latest value and its time; time of the last stored point.
SERIES = "last double, last_us bigint, run int, latest double, latest_us bigint, stored_us bigint"


def whole(x) -> int | None:
    return None if x is None or x is pd.NA or x != x else int(x)


class Judge(StatefulProcessor):
    """A series' points in order of arrival: which are suspect (as quality.suspects()), and which storage on change keeps (as state.stored_on_change())."""

    def __init__(self, columns: list[str], heartbeat_seconds: int = 3600):
        self.columns, self.heartbeat = columns, heartbeat_seconds * 1_000_000

    def init(self, handle) -> None:
        self.series = handle.getValueState("series", SERIES)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        for r in initialState.itertuples(index=False):
            self.series.update((None if pd.isna(r.last) else float(r.last), whole(r.last_us), whole(r.run) or 0, None if pd.isna(r.latest) else float(r.latest), whole(r.latest_us), whole(r.stored_us)))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last, last_us, run, latest, latest_us, stored = self.series.get() if self.series.exists() else (None, None, 0, None, None, None)
        frame = pd.concat(list(rows)).sort_values(["received_us", "raw_message_id"], kind="stable")
        suspects, kept, changes = [], [], []
        for us, v, late, stuck, limit in zip(frame["us"].tolist(), frame["value"].tolist(), frame["late"].tolist(), frame["stuck"].tolist(), frame["jump"].tolist()):
            suspect = False
            if not late and (last_us is None or us > last_us):
                run = run + 1 if last_us is not None and v == last else 1
                if last_us is not None:
                    minutes = max(1.0, (us // 1000 - last_us // 1000) / 60_000)
                    suspect = (stuck and run >= quality.STUCK_COUNT) or abs(v - last) / minutes > limit
                last, last_us = v, us
            changed = latest is None or (us >= latest_us and v != latest)
            keep = changed or us < latest_us or us - stored >= self.heartbeat
            stored = us if keep else stored
            if latest is None or us >= latest_us:
                latest, latest_us = v, us
            suspects.append(suspect)
            kept.append(keep)
            changes.append(changed)
        self.series.update((last, last_us, run, latest, latest_us, stored))
        yield frame.assign(suspect=suspects, kept=kept, changed=changes)[self.columns]

    def close(self) -> None:
        pass


def seeds(points: DataFrame) -> DataFrame:
    """The state with which a new query starts, from stored points: latest values; what makes a value suspect begins anew."""
    v = state.latest_values(points)
    none = F.lit(None)
    return v.select("device_id", "metric_key", none.cast("double").alias("last"), none.cast("bigint").alias("last_us"), F.lit(0).alias("run"), F.col("value").alias("latest"), F.unix_micros("time").alias("latest_us"), F.unix_micros("time").alias("stored_us"))


def judged(points: DataFrame, definitions: DataFrame, on_change: DataFrame | None = None, initial: DataFrame | None = None) -> DataFrame:
    """A stream of points with suspect, kept and changed, quality and flags set accordingly. definitions and on_change are those of quality.suspects() and metrics.stored();
    points of metrics that are not stored on change are kept whatever their value. Points without a device, a metric, a time or a value are left out."""
    d = definitions.select("metric_key", "valid_min", "valid_max", F.col("value_type").alias("_kind"), F.col("state_type").alias("_state"), F.lit(True).alias("_defined"))
    rows = points.dropna(subset=["device_id", "metric_key", "time", "value"]).join(F.broadcast(d), "metric_key", "left")
    number = F.col("_kind").isNull() | (F.upper("_kind") == "NUMBER")
    stuck = F.coalesce(F.col("_defined") & ~F.coalesce("_state", F.lit(False)) & number & ~F.col("metric_key").isin(*quality.STUCK_EXEMPT), F.lit(False))
    jump = F.coalesce(F.when(F.col("valid_max") > F.col("valid_min"), (F.col("valid_max") - F.col("valid_min")) * quality.JUMP_FRACTION), F.lit(float("inf")))
    rows = rows.withColumns({"us": F.unix_micros("time"), "received_us": F.unix_micros("received_at"), "late": F.col("flags").bitwiseAND(LATE) != 0, "stuck": stuck, "jump": jump})
    if on_change is None:
        rows = rows.withColumn("by_change", F.lit(False))
    else:
        modes = on_change.select("organization_id", "metric_key", F.lit(True).alias("by_change")).distinct()
        rows = rows.join(F.broadcast(modes), ["organization_id", "metric_key"], "left").withColumn("by_change", F.coalesce("by_change", F.lit(False)))
    columns = ["device_id", "metric_key", "us", "organization_id", "value", "quality", "flags", "is_virtual", "received_us", "raw_message_id", "by_change"]
    rows = rows.select(*columns, "late", "stuck", "jump")
    kinds = "device_id bigint, metric_key string, us bigint, organization_id bigint, value double, quality smallint, flags smallint, is_virtual boolean, received_us bigint, raw_message_id bigint, by_change boolean, suspect boolean, kept boolean, changed boolean"
    state_of = None if initial is None else initial.groupBy("device_id", "metric_key")
    found = rows.groupBy("device_id", "metric_key").transformWithStateInPandas(Judge([*columns, "suspect", "kept", "changed"]), kinds, "append", "none", initialState=state_of)
    worse = F.col("suspect") & ~F.col("quality").isin(FORECAST, CORRECTED, OUT_OF_RANGE)
    return found.select(
        "device_id", "metric_key", F.timestamp_micros("us").alias("time"), "organization_id", "value", F.when(worse, SUSPECT).otherwise(F.col("quality")).cast("smallint").alias("quality"),
        F.when(F.col("by_change") & F.col("changed"), F.col("flags").bitwiseOR(STATE_CHANGE)).otherwise(F.col("flags")).cast("smallint").alias("flags"), "is_virtual", F.timestamp_micros("received_us").alias("received_at"), "raw_message_id",
        "suspect", (F.col("kept") | ~F.col("by_change")).alias("kept"),
    )


def keyed(spark: SparkSession, start: Callable[[], StreamingQuery]) -> StreamingQuery:
    """start() with the state store that keyed state needs; the session's own setting comes back, as a query keeps the one that it began with."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        return start()
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def run_keyed(rows: DataFrame, to: str, checkpoint: str) -> StreamingQuery:
    """Start a stream of keyed state to its end, each micro-batch published as the folder to/batch=N."""
    spark = rows.sparkSession
    writer = rows.writeStream.option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True)
    return keyed(spark, writer.foreachBatch(lambda batch, number: store.published(batch, f"{to}/batch={number}") and None).start)


def run_judged(spark: SparkSession, base: str, definitions: DataFrame, on_change: DataFrame | None = None, initial: DataFrame | None = None, files: int | None = None) -> StreamingQuery:
    """Judge the points that ingest.run_stored() publishes under base, into base/judged by batch; files: so many files of points a micro-batch at most."""
    source = spark.readStream.schema(TELEMETRY)
    if files is not None:
        source = source.option("maxFilesPerTrigger", files)
    points = source.parquet(f"{base}/points").drop("batch")
    return run_keyed(judged(points, definitions, on_change, initial), f"{base}/judged", f"{base}/judged-checkpoint")


class Watch(StatefulProcessor):
    """Silence by timers: OFFLINE once the stream's time has passed a device's limit without a message, ONLINE with the next one; nothing is scanned."""

    def init(self, handle) -> None:
        self.handle, self.seen = handle, handle.getValueState("seen", "at_us bigint, limit_ms bigint, online boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        at, limit, online = self.seen.get() or (None, None, False)
        before = at // 1000 + limit + 1 if online else None  # the timer about the message before
        out = []
        for us, ms in sorted(pair for f in rows for pair in zip(f["us"].tolist(), f["limit_ms"].tolist())):
            if at is not None and us <= at:
                continue  # an older message than the latest says nothing about silence
            if online and us - at > ms * 1000:
                out.append((key[0], "OFFLINE", at + ms * 1000))
                online = False
            if not online:
                out.append((key[0], "ONLINE", us))
            at, limit, online = us, ms, True
        after = at // 1000 + limit + 1 if online else None
        if after != before:  # each call to the state takes longer than the rows of most devices
            if before is not None:
                self.handle.deleteTimer(before)
            self.handle.registerTimer(after)
        self.seen.update((at, limit, online))
        if out:
            yield pd.DataFrame(out, columns=["device_id", "kind", "us"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at, limit, online = self.seen.get()
        if online and expiredTimerInfo.getExpiryTimeInMs() > at // 1000 + limit:
            self.seen.update((at, limit, False))
            yield pd.DataFrame([(key[0], "OFFLINE", at + limit * 1000)], columns=["device_id", "kind", "us"])

    def close(self) -> None:
        pass


def silences(messages: DataFrame, interval, multiplier, delay: str = "1 minute") -> DataFrame:
    """A stream's (device_id, kind, at): as state.connectivity_events(), and OFFLINE also for devices that have not come back yet, by timers on received_at."""
    limit = F.floor(interval * multiplier * 1000 + 0.5).cast("bigint")
    rows = messages.where("device_id IS NOT NULL AND received_at IS NOT NULL").select("device_id", "received_at", limit.alias("limit_ms")).withWatermark("received_at", delay)
    rows = rows.withColumn("us", F.unix_micros("received_at"))
    found = rows.groupBy("device_id").transformWithStateInPandas(Watch(), "device_id bigint, kind string, us bigint", "append", "eventTime")
    return found.select("device_id", "kind", F.timestamp_micros("us").alias("at"))
