"""Scans in parts against plain loops over whole series, with runs over many days, empty days and ties."""

import datetime as dt
import random

from pyspark.sql import functions as F

from fluxgrain.operators import parts, quality, state

T0 = dt.datetime(2024, 3, 1)


def test_parts_against_loops(spark):
    rng = random.Random(5)
    rows, i = [], 0
    for key in range(6):
        at = T0
        for _ in range(120):
            at += dt.timedelta(hours=rng.choice([0, 1, 5, 30, 90]) if key else 7)
            rows.append((key, at, i, float(rng.choice([1, 1, 1, 1, 2])) if key > 1 else 1.0))
            i += 1
    p = spark.createDataFrame(rows, "k int, at timestamp, id int, v double").repartition(7)
    top = parts.earlier_max(p, ["k"], ["at", "id"], F.col("v"), "top", parts.day("at"))
    before = parts.previous(top, ["k"], ["at", "id"], F.struct("v"), "before")
    got = {r["id"]: r for r in parts.run_lengths(before, ["k"], ["at", "id"], F.coalesce(F.col("before.v") == F.col("v"), F.lit(False)), "n").collect()}
    last, run, most = {}, {}, {}
    for k, _, i, v in rows:
        r = got[i]
        assert r["top"] == most.get(k) and (r["before"]["v"] if r["before"] else None) == last.get(k)
        run[k] = run[k] + 1 if last.get(k) == v else 1
        last[k], most[k] = v, max(v, most.get(k, 0))
        assert r["n"] == run[k]
    assert max(r["n"] for r in got.values() if r["k"] == 0) == 120  # one run over all days


def test_no_window_holds_a_whole_series(spark):
    """Windows over rows are partitioned by day too; those over a series' days alone see one row per day."""
    rows = [(1, "m", T0 + dt.timedelta(hours=i), 1.0, 0, T0 + dt.timedelta(hours=i), i) for i in range(100)]
    p = spark.createDataFrame(rows, "device_id bigint, metric_key string, time timestamp, value double, flags int, received_at timestamp, raw_message_id bigint")
    d = spark.createDataFrame([("m", 0.0, 1.0, None, False)], "metric_key string, valid_min double, valid_max double, value_type string, state_type boolean")
    assert quality.suspects(p, d).where("suspect").count() == 89
    plan = quality.suspects(p, d)._jdf.queryExecution().optimizedPlan().toString()
    for line in (x for x in plan.splitlines() if " Window " in x or x.strip().startswith(("+- Window", "Window"))):
        over_rows = "lag(" in line or "row_number()" in line
        assert not over_rows or "_part" in line.rsplit("], [", 2)[-2], line


def test_gaps_over_days(spark):
    times = [T0, T0 + dt.timedelta(days=3), T0 + dt.timedelta(days=3, minutes=5), T0 + dt.timedelta(days=9)]
    p = spark.createDataFrame([(1, t) for t in times], "device_id bigint, received_at timestamp")
    got = [(r["gap_start"], r["gap_end"]) for r in state.gaps(p, F.lit(3600)).orderBy("gap_start").collect()]
    assert got == [(times[0], times[1]), (times[2], times[3])]
    assert state.gaps(p.limit(0), F.lit(3600)).count() == 0
