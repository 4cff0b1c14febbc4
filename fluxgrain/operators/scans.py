"""Lookups and scans of the telemetry view, of stored messages and of organisations; filters reach the Parquet reader as they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluxgrain.sources.telemetry import LATE

MOST = 20_000


def points_between(points: DataFrame, organization_id: int, device_id: int, keys: list[str], start: Column, end: Column, most: int = MOST) -> DataFrame:
    """A device's points of some metrics with start <= time < end, the earliest ``most`` by time and metric."""
    rows = points.where((F.col("organization_id") == organization_id) & (F.col("device_id") == device_id) & F.col("metric_key").isin(*keys) & (F.col("time") >= start) & (F.col("time") < end))
    return rows.select("metric_key", "time", "value").orderBy("time", "metric_key").limit(most)


def recent_values(points: DataFrame, device_id: int, since: Column) -> DataFrame:
    """A device's points from ``since`` on that are not late, to be read by metric and time."""
    rows = points.where((F.col("device_id") == device_id) & (F.col("time") >= since) & (F.col("flags").bitwiseAND(LATE) == 0))
    return rows.select("metric_key", "time", "value").orderBy("metric_key", "time")


def messages_by_id(raw: DataFrame, organization_id: int, ids: list[int]) -> DataFrame:
    """Stored messages of an organisation by their numbers."""
    return raw.where((F.col("organization_id") == organization_id) & F.col("id").isin(*ids))


def last_known(messages: DataFrame, points: DataFrame) -> DataFrame:
    """messages (message_id, device_id, received_at) with last: the map of the device's metrics to the value and time last known before the message came.

    Both are ordered together along (device, metric), so that no message meets all points; messages go to the metrics that their device has.
    """
    metrics = points.select("device_id", "metric_key").distinct()
    asked = messages.select("message_id", "device_id", F.col("received_at").alias("at")).join(metrics, "device_id").withColumns({"_v": F.lit(None).cast("struct<value:double,time:timestamp>"), "_n": F.lit(0)})
    known = points.select(F.lit(None).cast(messages.schema["message_id"].dataType).alias("message_id"), "device_id", F.col("received_at").alias("at"), "metric_key", F.struct("value", "time").alias("_v"), F.lit(1).alias("_n"), "raw_message_id")
    order = Window.partitionBy("device_id", "metric_key").orderBy("at", "_n", F.coalesce("raw_message_id", F.lit(0)))
    both = asked.withColumn("raw_message_id", F.lit(None).cast("bigint")).unionByName(known)
    found = both.withColumn("_last", F.last("_v", True).over(order.rowsBetween(Window.unboundedPreceding, -1))).where("_n = 0 AND _last IS NOT NULL")
    maps = found.groupBy("message_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("metric_key", "_last")))).alias("last"))
    return messages.join(maps, "message_id", "left")


def earliest(points: DataFrame, floor: Column) -> DataFrame:
    """One row: the earliest time from ``floor`` on, null without points."""
    return points.where(F.col("time") >= floor).agg(F.min("time").alias("earliest"))


def organizations(states: DataFrame, policies: DataFrame) -> DataFrame:
    """The organisations that have devices or policies."""
    return states.select("organization_id").union(policies.select("organization_id")).where("organization_id IS NOT NULL").distinct()
