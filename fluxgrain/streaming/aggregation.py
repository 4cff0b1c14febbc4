"""Minutes rolled up as time goes on: closed ones once, in chunks up to a stored watermark, and those that late points change again.

A run's rows lie in folders that appear whole: ``part=c<until>`` for each chunk, ``part=r<now>`` for what was computed again, both in microseconds; ``runs`` has a row per run with its
time and the watermark that it reached. A run that died leaves whole chunks, which the next one finds and keeps. Of rows of one minute the last part counts (minutes()).
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxgrain.operators import rollup
from fluxgrain.sources import store

RUN = "at timestamp, watermark timestamp"
GRACE, BACKFILL, MINUTE = datetime.timedelta(seconds=30), datetime.timedelta(hours=2), datetime.timedelta(minutes=1)


def micros(t: datetime.datetime) -> int:
    return int((t - datetime.datetime(1970, 1, 1)) / datetime.timedelta(microseconds=1))


def last_run(spark: SparkSession, base: str) -> tuple[datetime.datetime, datetime.datetime] | None:
    """(time, watermark) of the last run that ended."""
    if not (names := sorted(n for n in store.names(spark, f"{base}/runs") if n.startswith("run="))):
        return None
    r = spark.read.schema(RUN).parquet(f"{base}/runs/{names[-1]}").first()
    return r["at"], r["watermark"]


def advance(points: DataFrame, base: str, now: datetime.datetime, chunk: datetime.timedelta = datetime.timedelta(hours=6), **options) -> datetime.datetime | None:
    """Roll up what is closed at ``now`` (thirty seconds after its minute's end) and was not before, and again the minutes that points changed which have come since the last run; the
    new watermark. points: all that are stored by now; of them a chunk's own times (and an hour before) and the late ones' hours are read. The first run begins with the
    earliest point of the last two hours. options are those of rollup.minutes()."""
    spark = points.sparkSession
    before = last_run(spark, base)
    until = (now - GRACE).replace(second=0, microsecond=0)
    if before is None:
        first = points.where(F.col("time") >= F.lit(now - BACKFILL)).agg(F.min("time")).first()[0]
        if first is None:
            return None
        low = first.replace(second=0, microsecond=0)
    else:
        low = before[1]
    at = low
    while at < until:  # some chunks for each day that was missed
        end = min(at + chunk, until)
        store.published(rollup.minutes(points, F.lit(at), F.lit(end), **options), f"{base}/minutes/part=c{micros(end)}")
        at = end
    if before is not None:
        late = (F.col("received_at") > F.lit(before[0])) & (F.col("time") < F.lit(before[1]))
        oldest = points.where(late).agg(F.min("time")).first()[0]
        if oldest is not None:
            near = points.where(F.col("time") >= F.lit(oldest.replace(second=0, microsecond=0)))
            dirty = rollup.late_minutes(near, late).where(F.col("from_time") < F.lit(before[1]))
            none = rollup.minutes(points.limit(0), **options)
            store.published(rollup.recompute(none, dirty, points.where(F.col("time") < F.lit(before[1])), **options), f"{base}/minutes/part=r{micros(now)}")
    reached = max(at, low)
    store.published(spark.createDataFrame([(now, reached)], RUN), f"{base}/runs/run={micros(now)}")
    return reached


def minutes(spark: SparkSession, base: str) -> DataFrame:
    """The minutes rolled up so far."""
    rows = spark.read.parquet(f"{base}/minutes")
    columns = [c for c in rows.columns if c != "part"]
    on = [*rollup.SERIES, "bucket"]
    last = rows.groupBy(*on).agg(F.max_by(F.struct(*[c for c in columns if c not in on]), "part").alias("_r"))
    return last.select(*on, "_r.*").select(*columns)
