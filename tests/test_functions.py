"""Formulas, paths, values, decoders and stateful operators against fixed vectors."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from fluxgrain.functions import formula, jsonpaths, scalars
from fluxgrain.operators import decode, letters, maintenance, metrics, quality, rollup, scripts, state
from fluxgrain.sources import store

T0 = dt.datetime(2026, 10, 3)


def value(spark, source, **metrics_):
    f = formula.parse(source)
    return spark.range(1).select(f.column(lambda k: F.lit(metrics_.get(k)).cast("double")).alias("x")).first()[0]


@pytest.mark.parametrize(
    ("source", "given", "want"),
    [
        ("temperature*1.8+32", {"temperature": 21}, 69.8),
        ("round(thi(28,70),1)", {}, 78.4),
        ("round(dew_point(25, 60), 1)", {}, 16.7),
        ("-(t-2)^2", {"t": 5}, -9.0),
        ("2^3^2", {}, 512.0),
        ("-7.5 % 2", {}, -1.5),
        ("clamp(x, 0, 10)", {"x": 12}, 10.0),
        ("max(a, 3)", {}, None),
        ("a/0", {"a": 1}, None),
        ("sqrt(0-1)", {}, None),
        ("C2F(f2c(50))", {}, 50.0),
    ],
)
def test_formula(spark, source, given, want):
    got = value(spark, source, **given)
    assert got == pytest.approx(want) if want is not None else got is None


@pytest.mark.parametrize("source", ["", "1 +", "(1", "1)", "foo(1)", "thi(1)", "min()", "rolling_mean(a, 10)", "rolling_mean(a, 25h)", "a b", "1 $ 2", "x" * 501])
def test_formula_errors(source):
    with pytest.raises(formula.FormulaError):
        formula.parse(source)


def test_rolling_window_bounds(spark):
    at = lambda m: T0 + dt.timedelta(minutes=m)
    rows = [(1, "co2", at(m), 400.0 + 10 * m, 0) for m in range(12)] + [(1, "co2", at(12), 600.0, 0)]
    p = spark.createDataFrame(rows, "device_id bigint, metric_key string, time timestamp, value double, flags int")
    got = {r["time"]: r["value"] for r in formula.evaluate(p, {"m": "rolling_mean(co2, 10m)"}).collect()}
    assert got[at(12)] == pytest.approx((sum(400 + 10 * m for m in range(2, 12)) + 600) / 11)


def test_rolling_window_length(spark):
    rows = [(1, "co2", T0 + dt.timedelta(seconds=i), float(i), int(i == 1490)) for i in range(1500)]
    p = spark.createDataFrame(rows, "device_id bigint, metric_key string, time timestamp, value double, flags int")
    got = {(r["metric_key"], r["time"]): r["value"] for r in formula.evaluate(p, {"n": "rolling_count(co2, 1h)", "low": "rolling_min(co2, 1h)"}).collect()}
    last = T0 + dt.timedelta(seconds=1499)
    assert (got["n", last], got["low", last]) == (1441, 58)
    assert (got["n", T0 + dt.timedelta(seconds=100)], got["low", T0 + dt.timedelta(seconds=100)]) == (101, 0)


def test_letters_are_limited(spark):
    assert letters.checked(spark.range(5000)).count() == 5000
    with pytest.raises(ValueError):
        letters.checked(spark.range(5001))


def test_paths(spark):
    j = json.dumps({"a": [{"k": 1}, {"k": None}, {"b": "x"}], "c d": {"e": True}})
    row = spark.createDataFrame([(j,)], "j string").select(jsonpaths.first(F.col("j"), "$['c d'].e"), jsonpaths.first(F.col("j"), "$.a[*].b"), jsonpaths.first(F.col("j"), "$.a[1].k")).first()
    assert tuple(row) == ("true", "x", None)
    for bad in ("", "a", "$..a", "$.a[", "$.a[-1]"):
        with pytest.raises(ValueError):
            jsonpaths.steps(bad)


def test_numbers(spark):
    rows = [("1e3", "text", {}, 1000.0), (" OPEN ", "text", {}, 1.0), ("open", "text", {"shut": 0.0}, None), ("NaN", "text", {}, None), ("true", "bool", {}, 1.0), ("x", "text", {}, None), (None, "text", {}, None)]
    df = spark.createDataFrame(rows, "t string, k string, w map<string,double>, want double")
    for r in df.select(scalars.number(F.col("t"), F.col("k"), F.col("w")).alias("got"), "want").collect():
        assert r["got"] == r["want"]


def test_tlv():
    values = lambda h, m=None: [(k, v) for k, v, _ in decode.tlv(bytes.fromhex(h), m)]
    assert values("01755C03673401046865") == [("battery", 92.0), ("temperature", 30.8), ("humidity", 50.5)]
    assert values("0367F6FF") == [("temperature", -1.0)]
    for bad, model in (("0399", None), ("0175", None), ("01", None), ("087D0100", "AM103")):
        with pytest.raises(ValueError):
            decode.tlv(bytes.fromhex(bad), model)


def test_mapping_errors():
    assert decode.check_mapping({"deviceIdFrom": "topic[1]", "metrics": [{"path": "$.a", "key": "a"}]}) == []
    for bad in ({}, {"deviceIdFrom": "topic[40]", "metrics": {"$.a": "a"}}, {"deviceIdFrom": "$.d"}, {"deviceIdFrom": "$.d", "metrics": [{"path": "$..a", "key": "a"}]}, {"deviceIdFrom": "$.d", "metrics": {"$.a": "x", "$.b": "x"}}, {"deviceIdFrom": "$.d", "metrics": {"$.a": "a"}, "timeFormat": "ISO"}):
        assert decode.check_mapping(bad)


def test_overlay_and_scripted(spark):
    schema = "source_id bigint, topic string, payload binary, topic_attributes map<string,string>"
    m = spark.createDataFrame([(9, "a/b", b"7", {"externalId": "e", "metric": "co2", "room": "1"}), (9, "a/b", b"x", {}), (8, "a/b", b"7", {})], schema)

    def read(topic, payload):
        return {"external_id": topic, "values": [("v", float(payload), "u")]}

    out = {r["external_id"] or r["error"]: r for r in decode.overlay(decode.decode(m, {9: {"decoder": "script:1"}}, {"script:1": read})).collect()}
    assert out["e"]["values"][0]["key"] == "co2" and out["e"]["tags"] == {"room": "1"}
    assert decode.FAILED in out


def test_encoding(spark):
    rows = [(b'{"a":1}', "JSON"), (b" [1]", "JSON"), (b"\x01\x02", "BINARY"), (b"\xff\xfe", "BINARY"), (b"22.5", "TEXT")]
    for r in spark.createDataFrame(rows, "p binary, want string").select(decode.payload_encoding(F.col("p")).alias("got"), "want").collect():
        assert r["got"] == r["want"]


def test_limits(spark):
    v = lambda k, t="1", kind="number": {"key": k, "text": t, "kind": kind, "unit": None}
    rows = [([v("a")] * 100, None), ([v("a")] * 101, "ING_TOO_MANY_VALUES"), ([v("k" * 64)], None), ([v("k" * 65)], "ING_KEY_TOO_LONG"), ([v("a", "가" * 341, "text")], None), ([v("a", "가" * 342, "text")], "ING_VALUE_TOO_LONG")]
    for r in spark.createDataFrame(rows, f"v {decode.VALUES}, want string").select(metrics.over_limits(F.col("v")).alias("got"), "want").collect():
        assert r["got"] == r["want"]


def test_measured_time(spark):
    rows = [(s, r) for s, r in ((300, None), (301, "FUTURE"), (-604800, None), (-604801, "TOO_OLD"))]
    df = spark.createDataFrame([(T0 + dt.timedelta(seconds=s), T0, r) for s, r in rows], "m timestamp, r timestamp, want string")
    time, reason = quality.measured_time(F.col("m"), F.col("r"))
    for x in df.select(reason.alias("got"), "want").collect():
        assert x["got"] == x["want"]


def test_stuck_and_jump(spark):
    at = lambda s: T0 + dt.timedelta(seconds=s)
    rows = [(1, "t", at(60 * i), 22.5) for i in range(13)] + [(2, "t", at(60 * i), v) for i, v in enumerate((20.0, 35.0, 50.1))]
    p = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "device_id bigint, metric_key string, time timestamp, value double, raw_message_id bigint").withColumns({"received_at": F.col("time"), "flags": F.lit(0)})
    d = spark.createDataFrame([("t", -20.0, 60.0, "NUMBER", False)], "metric_key string, valid_min double, valid_max double, value_type string, state_type boolean")
    assert {r["raw_message_id"] for r in quality.suspects(p, d).where("suspect").collect()} == {11, 12, 15}


def test_clock_skew(spark):
    rows = [(7, T0 + dt.timedelta(minutes=i + 7), T0 + dt.timedelta(minutes=i)) for i in range(60)]
    m = spark.createDataFrame(rows, "device_id bigint, measured_at timestamp, received_at timestamp")
    (e,) = quality.skew_events(m).collect()
    assert (e["kind"], e["at"], e["since"], e["skew_sec"]) == ("SUSPECTED", T0 + dt.timedelta(minutes=30), T0, 420.0)


@pytest.mark.parametrize(
    ("interval", "received", "late", "values", "oor", "suspect", "want"),
    [(60, 720, 72, 1440, 144, 36, (50, 90, 90, 98, 76)), (None, 288, 0, 288, 0, 0, (100, 100, 100, 100, 100)), (300, 0, 0, 0, 0, 0, (0, 0, 0, 0, 0))],
)
def test_score(spark, interval, received, late, values, oor, suspect, want):
    c = spark.createDataFrame([(received, late, values, oor, suspect, interval)], "received int, late int, n_values int, out_of_range int, suspect int, i int")
    r = quality.daily_score(c, F.col("i")).first()
    assert tuple(r[x] for x in ("completeness", "timeliness", "validity", "stability", "score")) == want


def test_duplicates(spark):
    at = lambda s: T0 + dt.timedelta(seconds=s)
    m = spark.createDataFrame([(1, "a", at(0), 1), (1, "a", at(600), 2), (1, "a", at(1201), 3), (2, "a", at(1), 4), (1, None, at(1), 5)], "organization_id bigint, dedup_key string, received_at timestamp, message_id bigint")
    assert {r["message_id"] for r in state.duplicates(m).where("duplicate").collect()} == {2}


def test_on_change(spark):
    at = lambda m: T0 + dt.timedelta(minutes=m)
    rows = [(1, "door", at(10 * i), 1.0 if i < 9 else 0.0, 0, at(10 * i), i) for i in range(18)]
    p = spark.createDataFrame(rows, "device_id bigint, metric_key string, time timestamp, value double, flags smallint, received_at timestamp, raw_message_id bigint")
    got = sorted((r["raw_message_id"], r["flags"]) for r in state.stored_on_change(p).collect())
    assert got == [(0, 8), (6, 0), (9, 8), (15, 0)]


def test_late_recompute(spark):
    at = lambda s: T0 + dt.timedelta(seconds=s)
    rows = [(1, "co2", at(60 * i), 600.0) for i in range(60)] + [(1, "co2", at(1830), 1200.0)]
    p = spark.createDataFrame(rows, "device_id bigint, metric_key string, time timestamp, value double").withColumns({"organization_id": F.lit(1), "quality": F.lit(0), "is_virtual": F.lit(False)})
    late = p.where("value = 1200")
    again = rollup.recompute(rollup.minutes(p.where("value < 1200")), rollup.dirty_ranges(late, F.lit(at(3600))), p)
    (h,) = rollup.hours(again).collect()
    assert h["count"] == 61 and h["avg"] == pytest.approx((600 * 60 + 1200) / 61)


def test_hours_with_states_only(spark):
    p = spark.createDataFrame([(1, "door", T0, 1.0)], "device_id bigint, metric_key string, time timestamp, value double").withColumns({"organization_id": F.lit(1).cast("bigint"), "quality": F.lit(0), "is_virtual": F.lit(False)})
    end = F.lit(T0 + dt.timedelta(hours=3))
    out = rollup.hours_with_states(rollup.hours(rollup.minutes(p)), rollup.state_hours(p, end)).orderBy("bucket").collect()
    assert [(r["count"], r["state_on_sec"]) for r in out] == [(1, 3600), (0, 3600), (0, 3600)]


def test_scripts(spark):
    assert scripts.check("def transform(m, c):\n    return m\n", "transform") == []
    for bad in ("def transform(m, c):\n  return eval('1')", "import os\ndef transform(m, c): return m", "def other(): return 1", "def transform(:", "x.__class__\ndef transform(m, c): return m"):
        assert scripts.check(bad, "transform")
    assert scripts.linked({"a@1": ("", ["b@1"]), "b@1": ("", [])}, ["a@1"]) == ["b@1", "a@1"]
    with pytest.raises(ValueError):
        scripts.linked({"a@1": ("", ["a@1"])}, ["a@1"])

    def double(m, ctx):
        return None if m["v"] < 0 else {"v": m["v"] * ctx["by"]}

    def fail(m, ctx):
        raise ValueError("no")

    m = spark.createDataFrame([('{"v": 2}',), ('{"v": -1}',)], "message string")
    got = [tuple(r) for r in scripts.transform(m, [(double, "FAIL_CLOSED"), (fail, "FAIL_OPEN")], context={"by": 3}).collect()]
    assert got[0] == ('{"v": 6}', False, None) and got[1][1] is True
    assert scripts.transform(m, [(fail, "FAIL_CLOSED")]).where("script_error LIKE 'SCRIPT_ERROR%'").count() == 2


def test_percentile(spark):
    r = spark.range(1, 101).select(F.lit("s").alias("script_id"), F.lit(1).alias("version"), F.lit(T0).alias("run_at"), F.col("id").cast("double").alias("elapsed_ms"), F.lit(False).alias("failed"), F.lit(False).alias("timed_out"), F.lit(1).alias("input_bytes"))
    r = r.union(r.limit(1).withColumns({"elapsed_ms": F.lit(150.0), "timed_out": F.lit(True)}))
    s = scripts.minute_stats(r).first()
    assert (s["p95_ms"], s["max_ms"], s["timeouts"]) == (96.0, 150.0, 1) and s["avg_ms"] == pytest.approx(5200 / 101)


def test_progress(spark):
    r = spark.createDataFrame([(1, 3, 33.3), (5, 3, 100.0), (0, 0, 100.0)], "d int, t int, want double")
    for x in r.select(maintenance.progress_percent(F.col("d"), F.col("t")).alias("got"), "want").collect():
        assert x["got"] == x["want"]


def test_store(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 3).alias("device_id"), F.lit("m").alias("metric_key"), F.timestamp_seconds(F.col("id") * 86400).alias("time"))
    path = str(tmp_path / "t")
    by = F.date_format("time", "yyyy-MM")
    store.save(df, path, by)
    store.save(df.where("time < '1970-02-01'").limit(5), path, by)
    assert spark.read.parquet(path).where("month = '1970-01'").count() == 5 and spark.read.parquet(path).count() == 74
    store.archive(df, str(tmp_path / "a"))
    assert store.verified(spark, df, str(tmp_path / "a")) and not store.verified(spark, df.limit(9), str(tmp_path / "a"))
    store.sort_rewrite(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    assert store.verified(spark, df, str(tmp_path / "b"))
