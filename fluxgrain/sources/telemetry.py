"""The telemetry view: one row per (device, metric, time), and the event table seen as such a view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of ``flags`` and codes of ``quality`` (fixed values).
LATE, IMPORTED, REPROCESSED, STATE_CHANGE, DERIVED = 1, 2, 4, 8, 16
GOOD, OUT_OF_RANGE, UNVERIFIED, SUSPECT, CORRECTED, FORECAST = 0, 1, 2, 3, 4, 5

TELEMETRY = (
    "device_id bigint, metric_key string, time timestamp, organization_id bigint, value double, quality smallint, "
    "flags smallint, is_virtual boolean, received_at timestamp, raw_message_id bigint"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def from_events(spark: SparkSession, sf_dir: str, devices: int | None = None, squeeze: int = 1) -> DataFrame:
    """The event table as telemetry: users are devices, event types are metrics.

    ``devices`` folds the users into so many devices; ``squeeze`` divides times since 2024-01-01, so that minutes
    hold several points. The event times carry no zone and are taken as UTC (the session's zone must be UTC).
    """
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    base = 1704067200000000
    time = F.timestamp_micros(F.lit(base) + F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - base) / squeeze))
    device = F.col("user_id") if devices is None else F.col("user_id") % devices
    return events.select(
        device.alias("device_id"),
        F.col("event_type").alias("metric_key"),
        time.alias("time"),
        (F.col("user_id") % 3).alias("organization_id"),
        F.when(F.col("event_type") == "click", (k % 2).cast("double")).otherwise(F.col("value")).alias("value"),
        (k % 6).cast("smallint").alias("quality"),
        (k % 2).cast("smallint").alias("flags"),
        F.lit(False).alias("is_virtual"),
        (time + F.make_dt_interval(mins=k)).alias("received_at"),
        F.col("event_id").alias("raw_message_id"),
    )


def from_events_sql(devices: int | None = None, squeeze: int = 1) -> str:
    """The same view in DuckDB SQL, as a parenthesised query."""
    k = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
    base = 1704067200000000
    time = f"make_timestamp({base} + CAST(floor((epoch_us(ts) - {base}) / {squeeze}) AS BIGINT))"
    device = "user_id" if devices is None else f"user_id % {devices}"
    return f"""(SELECT {device} AS device_id, event_type AS metric_key, {time} AS time, user_id % 3 AS organization_id,
      CASE WHEN event_type = 'click' THEN CAST({k} % 2 AS DOUBLE) ELSE value END AS value, {k} % 6 AS quality, {k} % 2 AS flags,
      false AS is_virtual, {time} + to_minutes({k}) AS received_at, event_id AS raw_message_id FROM events)"""
