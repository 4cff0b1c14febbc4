"""Steps whose largest task must not grow with the input."""

import datetime as dt

import glob
import re

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from fluxgrain.operators import metrics, quality, state
from fluxgrain.plans import messages, streams
from fluxgrain.sources import store
from fluxgrain.sources.telemetry import from_events
from fluxgrain.streaming import ingest

DATA = "/root/testdata/sf0.001"


def plan(df):
    """The plan as it ran in the end."""
    df.write.format("noop").mode("overwrite").save()  # its own plan is another one
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_messages_stay_dealt_by_key(spark):
    p = from_events(spark, DATA)
    policies = spark.createDataFrame([(1, "AUTO_REGISTER", 2)], "source_id bigint, policy string, hourly_limit int")
    for options in ({}, {"policies": policies}, {"formulas": {"twice": "view * 2"}}):
        out, points = ingest.process(store.written(messages.uplink(p)), messages.SOURCES, *messages.dimensions(spark, p), **options)
        for df in (out, points):
            said = plan(df)
            assert "isFinalPlan=true" in said and "AQEShuffleRead local" not in said  # such a read takes whole outputs of tasks


def test_metrics_are_not_dealt_by_key(spark):
    """One source has all messages and a few metrics all values: neither may be what rows are dealt out by."""
    p = from_events(spark, DATA)
    devices, definitions, aliases = messages.dimensions(spark, p)
    said = plan(metrics.points(messages.decoded(p), definitions, aliases))
    policies = spark.createDataFrame([(1, "AUTO_REGISTER", 2)], "source_id bigint, policy string, hourly_limit int")
    asking = p.select(F.lit(1).cast("bigint").alias("source_id"), F.col("device_id").cast("string").alias("external_id"), "organization_id", "received_at")
    said += plan(metrics.registered(asking, devices, policies))
    alone = re.findall(r"hashpartitioning\((?:source_id|metric_key|original_key|organization_id)#\d+L?(?:, (?:original_key|organization_id)#\d+L?)?, \d+\)", said)
    assert "hashpartitioning(" in said and not alone


def test_row_groups_of_written_tables(spark):
    t = store.written(spark.range(0, 6_000_000, 1, 1).withColumn("x", F.xxhash64("id")))
    assert t.count() == 6_000_000
    assert min(pq.ParquetFile(f.removeprefix("file://")).num_row_groups for f in t.inputFiles()) > 2


SERIES = "device_id bigint, metric_key string, us bigint, value double, flags int, raw_message_id bigint"


def test_windows_are_cut_by_day(spark):
    noon, second = 1_704_110_400_000_000, 1_000_000
    rows = [(1, "t", noon + i * 20 * second, float(i), i % 10 == 0, i) for i in range(4_000)] + [(1, "t", None, -1.0, 0, 9_000), (None, None, noon, 7.0, 0, 9_001)]
    p = spark.createDataFrame([(*r[:4], int(r[4]), r[5]) for r in rows], SERIES).withColumn("time", F.timestamp_micros("us"))
    wide = lambda most: {r["raw_message_id"]: r["recent"] for r in state.window_values(p, 12 * 3600, most).collect()}
    every, some = wide(None), wide(1440)
    for i in range(4_000):
        seen = [float(j) for j in range(max(0, i - 2_160), i) if j % 10]  # over midnight too, and more than 1,440 of them
        assert every[i] == seen and some[i] == seen[-1440:]
    assert len(every) == 4_002 and every[9_001] == []
    assert "hashpartitioning(device_id" in (said := plan(state.window_values(p, 3600))) and "_to#" in said.split("hashpartitioning(device_id")[1].split(")")[0]


def test_mean_skew_by_running_sums(spark):
    at, hour = 1_704_110_400_000, 3_600_000
    came = [at, at, at + 1, at + hour, at + hour + 1, at + hour + 1, at + 12 * hour - 1, at + 12 * hour, at + 13 * hour - 1, at + 13 * hour]
    rows = [(d, i, ms, ms - 1000 * i * (d + 1)) for d in range(3) for i, ms in enumerate(came)]
    m = spark.createDataFrame(rows, "device_id bigint, id bigint, ms bigint, told bigint").withColumns({"received_at": F.timestamp_millis("ms"), "measured_at": F.timestamp_millis("told")})
    out = quality.skew_means(m)
    for r in out.collect():
        near = [t - ms for d, _, ms, t in rows if d == r["device_id"] and r["ms"] - hour <= ms <= r["ms"]]
        assert r["skew_sec"] == sum(near) / len(near) / 1000
    assert out.count() == len(rows)
    assert "-3600000" not in plan(out)  # no sum over the hour at each message


def test_folders_are_written_by_all_tasks(spark):
    base = store.scratch(spark, "folders")
    rows = spark.range(0, 1_000, 1, 4)
    number = F.when(F.col("id") < 990, F.col("id") % 3 * F.when(F.col("id") % 3 == 2, 2).otherwise(1))  # none in 2 and 3, ten rows in no folder
    for k, path in enumerate(store.folders(rows, number, 5, base)):
        assert path == f"{base}/batch={k}" and len([x for x in store.names(spark, base) if x.startswith("batch=")]) == k + 1
        held = spark.read.schema("id bigint").parquet(path)
        assert held.count() == (330 if k in (0, 1, 4) else 0)
        assert k in (2, 3) or len([x for x in store.names(spark, path) if x.endswith(".parquet")]) == 4


def test_batches_by_received_time(spark):
    p = from_events(spark, DATA)
    base = store.scratch(spark, "batches")
    paths = list(streams.in_batches(p, base))
    assert len(paths) == 5
    sums = [spark.read.parquet(x).agg(F.min("received_at").alias("a"), F.max("received_at").alias("b"), F.count("*").alias("n")).first() for x in paths]
    assert sum(r["n"] for r in sums) == p.count() and all(a["b"] <= b["a"] for a, b in zip(sums, sums[1:]))


def test_windows_are_slices_of_a_day(spark):
    midnight, second = 1_704_153_600_000_000, 1_000_000
    rows = [(d, m, midnight + (i // 3 - 20) * 600 * second, None if i % 7 == 0 else float(i), None if i % 11 == 0 else int(i % 5 == 0), i) for i in range(120) for d, m in ((1, "t"), (None, "t"), (0, "t"), (1, None), (1, ""))]
    rows += [(1, "t", None, float(i), i % 2, 200 + i) for i in range(4)]
    p = spark.createDataFrame(rows[::-1], SERIES).withColumn("time", F.timestamp_micros("us"))
    df = state.window_values(p, 6 * 3600, None)
    got = {(r["device_id"], r["metric_key"], r["raw_message_id"]): r["recent"] for r in df.collect()}
    assert len(got) == len(rows) and df.columns == [*p.columns, "recent"]
    for d, m, us, _, _, i in rows:
        near = [x for x in rows if x[:2] == (d, m) and x[4] == 0 and (x[2] is None if us is None else x[2] is not None and us - 21_600 * second <= x[2] < us)]
        assert got[d, m, i] == [x[3] for x in sorted(near, key=lambda x: (x[2] or 0, x[5]))]  # values that are null too, equal times by id
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        said = plan(state.window_values(p, 6 * 3600, None)).split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "collect_list" in said and "specifiedwindowframe(RangeFrame, -" not in said  # no list is gathered anew at each point
    assert said.count("Exchange hashpartitioning") == 2 and "Generate explode(_" not in said  # the join deals nothing anew, and a day's rows are not made at once
