"""Derived points, previews of formulas, partition warnings, and decoding of many configurations at once."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from fluxgrain.functions import formula
from fluxgrain.operators import decode, maintenance

T0 = dt.datetime(2024, 3, 1, 12)
POINT = "device_id bigint, metric_key string, time timestamp, value double, flags smallint"


def at(minute):
    return T0 + dt.timedelta(minutes=minute)


def test_preview_is_capped_and_looks_back(spark):
    p = spark.createDataFrame([(1, "a", at(m), float(m), m % 2) for m in range(-90, 10)] + [(2, "a", at(3), 7.0, 0), (1, "b", at(4), 1.0, 0), (2, "a", at(10), 9.0, 0), (3, "b", at(1), 1.0, 0)], POINT)
    series, inputs = formula.preview(p, "rolling_count(a, 30m)", F.lit(T0), F.lit(at(10)), shown=4)
    assert sorted((r["device_id"], r["time"], r["value"]) for r in series.collect()) == [(1, at(m), 31.0) for m in range(4)] + [(2, at(3), 1.0)]
    assert inputs.count() == 11
    both, _ = formula.preview(p, "a + b", F.lit(T0), F.lit(at(10)))
    assert [(r["device_id"], r["time"], r["value"]) for r in both.collect()] == [(1, at(4), 5.0)]
    assert formula.preview(p.limit(0), "a + 1", F.lit(T0), F.lit(at(10)))[0].count() == 0
    with pytest.raises(formula.FormulaError):
        formula.preview(p, "a +", F.lit(T0), F.lit(at(10)))
    with pytest.raises(formula.FormulaError):
        formula.preview(p, "a + c", F.lit(T0), F.lit(at(10)), known=lambda k: k == "a")


def test_stored_derived(spark):
    shape = "position int, organization_id bigint, device_id bigint, metric_key string, time timestamp, value double"
    rows = [(1, 1, 1, "a", at(0), 1.0), (2, 1, 1, "a", at(0), 2.0), (3, 1, 1, "b", at(0), 3.0), (4, 1, 1, "a", at(1), 4.0), (5, 1, 2, "a", at(-5), 5.0), (6, 1, None, "a", at(0), 6.0), (7, 1, 1, "a", None, 7.0)]
    devices = spark.createDataFrame([(1, 1, "ACTIVE"), (2, 1, "ACTIVE")], "device_id bigint, organization_id bigint, status string")
    now = F.lit(at(60))
    judged = maintenance.derived_points(spark.createDataFrame(rows, shape), devices, now)
    assert {r["position"]: r["reason"] for r in judged.collect()} == {1: None, 2: None, 3: None, 4: None, 5: None, 6: "UNKNOWN_DEVICE", 7: "INVALID_TIME"}
    stored, messages, latest, dirty = maintenance.stored_derived(judged, now, F.lit(at(0)))
    assert sorted((r["device_id"], r["metric_key"], r["time"], r["value"]) for r in stored.collect()) == [(1, "a", at(0), 2.0), (1, "a", at(1), 4.0), (1, "b", at(0), 3.0), (2, "a", at(-5), 5.0)]
    ids = {(r["device_id"], r["measured_at"]): r["message_id"] for r in messages.collect()}
    again = maintenance.stored_derived(judged.where("position > 1"), now)[1]
    assert ids == {(r["device_id"], r["measured_at"]): r["message_id"] for r in again.collect()} and len(set(ids.values())) == 3
    assert sorted((r["device_id"], r["metric_key"], r["value"]) for r in latest.collect()) == [(1, "a", 4.0), (2, "a", 5.0)]
    assert [(r["device_id"], r["start"], r["end"], r["reason"]) for r in dirty.collect()] == [(2, at(-5), at(-4), "LATE")]
    assert maintenance.stored_derived(judged, now)[3].count() == 0
    assert all(df.count() == 0 for df in maintenance.stored_derived(judged.limit(0), now))


def test_partition_warnings(spark):
    there = spark.createDataFrame([("2024-01",)], "month string")
    rows = spark.createDataFrame([("2024-01",), ("2024-02",), ("2024-02",), (None,)], "month string")
    told = maintenance.misplaced(there, rows, "telemetry", F.lit(T0))
    assert [(r["table"], r["n_rows"], str(r["day"])) for r in told.collect()] == [("telemetry", 3, "2024-03-01")]
    assert maintenance.misplaced(there, rows, "telemetry", F.lit(T0), told).count() == 0
    assert maintenance.misplaced(there, rows, "telemetry", F.lit(at(24 * 60)), told).count() == 1
    assert maintenance.misplaced(there, rows.where("month = '2024-01'"), "telemetry", F.lit(T0)).count() == 0


def test_many_configurations_are_one_projection(spark):
    schema = "source_id bigint, topic string, payload binary, topic_attributes map<string,string>"
    config = lambda k: {"deviceIdFrom": "$.d", "metrics": {f"$.m{k}": f"key{k}"}}
    sources = {k: {"decoder": "generic-json", "config": config(k % 30)} for k in range(60)} | {60: {"decoder": "single-value"}, 61: {"decoder": "none"}}
    body = json.dumps({"d": "x", **{f"m{k}": k for k in range(30)}}).encode()
    m = spark.createDataFrame([(k, "a/b/c", bytearray(body), {}) for k in range(60)] + [(3, "a", bytearray(b"no"), {}), (60, "a/b/c", bytearray(b"5"), {}), (61, "a", bytearray(b"5"), {}), (99, "a", bytearray(b"5"), {}), (None, "a", None, None)], schema)
    out = decode.decode(m, sources)
    got = [(r["source_id"], r["error"], [(v["key"], v["text"]) for v in r["values"] or []]) for r in out.collect()]
    assert sorted(x for x in got if x[0] is not None and x[0] < 60 and x[1] is None) == [(k, None, [(f"key{k % 30}", str(k % 30))]) for k in range(60)]
    assert sorted(x[0] if x[0] is not None else -1 for x in got if x[1] == decode.FAILED) == [-1, 3, 61, 99] and len(got) == 65
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Union") <= 2

    codecs = {1: {"config": {"codec": "milesight"}}, 2: {"config": {"codec": "other"}}, 3: {}}
    up = json.dumps({"deviceInfo": {"devEui": "00000000000000AA", "deviceProfileName": "EM300-TH"}, "data": "AXVkA2cRAQ==", "rxInfo": []}).encode()
    rows = spark.createDataFrame([(k, "t", bytearray(up), {}) for k in (1, 2, 3)], schema)
    together = {r["source_id"]: r["values"] for r in decode.decode(rows, codecs).collect()}
    apart = {k: decode.decode(rows.where(F.col("source_id") == k), {k: codecs[k]}).collect()[0]["values"] for k in codecs}
    assert together == apart


def test_decoders_are_given_whole_messages(spark):
    schema = "source_id bigint, source_type string, topic string, payload binary, received_at timestamp, topic_attributes map<string,string>"
    body = [b'{"id": "a", "v": 2}', b"3", b"\x01\x02", b'{"id"', None]
    m = spark.createDataFrame([(1 + k % 2, "HTTP", f"t/{k}", None if x is None else bytearray(x), T0, {}) for k, x in enumerate(body)], schema)

    def read(given):
        p = given["payload"]
        number = p["v"] if isinstance(p, dict) else len(given["payloadBase64"])
        return {"external_id": given["topic"], "values": [("v", number * given["source"]["config"].get("factor", 1), None)], "tags": {"e": given["payloadEncoding"], "t": given.get("payloadText", "-"), "at": given["receivedAt"]}}

    sources = {1: {"decoder": "script:1", "config": {"factor": 10}}, 2: {"decoder": "script:1"}}
    out = {r["external_id"]: (r["values"][0]["text"], r["tags"]["e"], r["tags"]["t"]) for r in decode.decode(m, sources, {"script:1": decode.Whole(read)}).collect()}
    assert out == {"t/0": ("20", "JSON", "-"), "t/1": ("4", "TEXT", "3"), "t/2": ("40", "BINARY", "-"), "t/3": ("8", "TEXT", '{"id"'), "t/4": ("0", "TEXT", "")}
