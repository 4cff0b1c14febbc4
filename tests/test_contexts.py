"""Functions that look back: feedback, order, bounds of windows, policies, and streams whose batches give what one gives."""

import datetime as dt
import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from test_streams import T0, dims, message, stream

from fluxgrain.operators import contexts, state
from fluxgrain.sources import store
from fluxgrain.streaming import ingest

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import tests
COLUMNS = "device_id bigint, id bigint, time timestamp, received_at timestamp, late boolean, device string, message string, extra map<string,array<double>>"


def said(i, device, minute, value, came=None, late=False, model=None):
    t = T0 + dt.timedelta(minutes=minute)
    return (device, i, t, T0 + dt.timedelta(minutes=minute if came is None else came), late, json.dumps({"id": device, "modelId": model}), json.dumps({"messageId": i, "metrics": [{"key": "temp", "value": value, "unit": "C"}]}), {"a": [1.0, float(i)]})


def values(df):
    return {r["id"]: (r["dropped"], r["script_error"], {m["key"]: m["value"] for m in json.loads(r["message"])["metrics"]}) for r in df.collect()}


def smooth(message, context):
    was = context["last"].get("temp")
    v = message["metrics"][0]["value"]
    return {**message, "metrics": [{"key": "temp", "value": v if was is None else (v + was["value"]) / 2}, {"key": "n", "value": len(context["window"]("temp", "10m"))}]}


def test_feedback_order_and_windows(spark):
    rows = [said(1, 1, 0, 8.0), said(2, 1, 5, 4.0), said(3, 1, 3, 2.0, came=6), said(4, 1, 10, 1.0), said(5, 2, 5, 7.0), said(6, 1, 11, 9.0, late=True), said(7, 1, 12, 0.0), said(8, None, 1, 5.0), said(9, None, 2, 6.0)]
    df = spark.createDataFrame(rows, COLUMNS)
    out = contexts.with_past(df, [contexts.Step(smooth)])
    got = values(out)
    assert got[1][2] == {"temp": 8.0, "n": 0}
    assert got[2][2] == {"temp": 6.0, "n": 1}
    assert got[3][2] == {"temp": 4.0, "n": 1}  # older than the newest: seen by no one
    assert got[4][2] == {"temp": 3.5, "n": 2}  # ten minutes before is in the window, the moment itself is not
    assert got[5][2] == {"temp": 7.0, "n": 0}
    assert got[6][2] == {"temp": 6.25, "n": 0}  # late: no window, and in none
    assert got[7][2] == {"temp": 3.125, "n": 2}
    assert got[8][2] == {"temp": 5.0, "n": 0} and got[9][2] == {"temp": 6.0, "n": 0}  # no device: nothing to look back on
    assert {r["id"]: r["extra"] for r in out.collect()} == {i: {"a": [1.0, float(i)]} for i in range(1, 10)}
    assert contexts.with_past(df.limit(0), [contexts.Step(smooth)]).count() == 0


def test_points_and_values_given(spark):
    p = spark.createDataFrame([(1, "temp", T0 - dt.timedelta(minutes=m), 100.0 + m, f, T0 - dt.timedelta(minutes=m), m) for m, f in ((9, 0), (4, 1), (2, 0))], "device_id bigint, metric_key string, time timestamp, value double, flags smallint, received_at timestamp, raw_message_id bigint")
    last = spark.createDataFrame([(1, "old", 7.0, T0 - dt.timedelta(days=90)), (2, "temp", 3.0, T0 - dt.timedelta(days=90))], "device_id bigint, metric_key string, value double, time timestamp")

    def told(message, context):
        with pytest.raises(TypeError):
            context["last"]["x"] = 1
        keys = context["last"]
        return {"metrics": [{"key": k, "value": v["value"]} for k, v in keys.items()] + [{"key": "seen", "value": len(context["window"]("temp", "24h"))}]}

    got = values(contexts.with_past(spark.createDataFrame([said(1, 1, 0, 1.0), said(2, 2, 0, 1.0), said(3, 3, 0, 1.0)], COLUMNS), [contexts.Step(told)], p, last))
    assert got[1][2] == {"old": 7.0, "temp": 102.0, "seen": 2} and got[2][2] == {"temp": 3.0, "seen": 0} and got[3][2] == {"seen": 0}


def test_policies_scopes_and_contract(spark):
    def drop_some(message, context):
        return None if message["messageId"] == 2 else message

    def breaks(message, context):
        return {"metrics": [{"key": "no key", "value": 1}]} if message["messageId"] == 3 else {"metrics": [*message["metrics"], {"key": "f", "value": context["config"]["f"]}, {"key": "f", "value": True}]}

    def window(message, context):
        context["window"]("temp", "25h")

    rows = [said(1, 1, 0, 1.0, model=5), said(2, 1, 1, 2.0, model=5), said(3, 1, 2, 3.0, model=5), said(4, 1, 3, 4.0), said(5, 9, 3, 4.0)]
    df = spark.createDataFrame(rows, COLUMNS)
    steps = [contexts.Step(window, device_id=9), contexts.Step(breaks, config={"f": 3}, model_id=5), contexts.Step(drop_some), contexts.Step(smooth)]
    got = values(contexts.with_past(df, steps))
    assert got[1] == (False, None, {"temp": 1.0, "n": 0, "f": 1}) and got[2][0]
    assert got[3] == (False, None, {"temp": 2.0, "n": 1})  # what breaks the contract is left out, the dropped message is seen by none
    assert got[4] == (False, None, {"temp": 3.0, "n": 2}) and got[5] == (False, None, {"temp": 4.0, "n": 0})
    strict = values(contexts.with_past(df, [contexts.Step(breaks, "FAIL_CLOSED", {"f": 3}, model_id=5), contexts.Step(window, "FAIL_CLOSED", device_id=9), contexts.Step(smooth)]))
    assert strict[3][1] == "SCRIPT_OUTPUT_INVALID: key" and strict[5][1].startswith("SCRIPT_ERROR: 25h")
    assert strict[4][2] == {"temp": 3.0 - 0.25, "n": 2}


def halved(message, context):
    was = context["last"].get("temp")
    return {**message, "metrics": [{"key": "temp", "value": message["metrics"][0]["value"] + (was["value"] / 2 if was else 0)}, {"key": "n", "value": len(context["window"]("temp", "1h"))}]}


def test_streams_look_back(spark):
    rows = [message(1, 0, value="8"), message(2, 5, value="4"), message(3, 5, value="2"), message(4, 40, value="x"), message(5, 50, value="1"), message(6, 60 * 40, value="6")]
    options = {"transforms": [contexts.Step(halved)]}
    given = dims(spark)
    results = []
    for batches in ([rows], [[r] for r in rows]):
        base = store.scratch(spark, "looking")
        stream(spark, base, batches, given, **options)
        results.append({(r["raw_message_id"], r["metric_key"]): r["value"] for r in spark.read.parquet(f"{base}/points").collect()})
    assert results[0] == results[1]
    assert results[0] == {(1, "temp"): 8.0, (1, "n"): 0, (2, "temp"): 8.0, (2, "n"): 1, (3, "temp"): 6.0, (3, "n"): 1, (5, "temp"): 4.0, (5, "n"): 2, (6, "temp"): 8.0, (6, "n"): 0}


def test_latest_after(spark):
    shape = "device_id bigint, metric_key string, value double, time timestamp, raw_message_id bigint, received_at timestamp"
    at = lambda m: T0 + dt.timedelta(minutes=m)
    p = spark.createDataFrame([(1, "a", 1.0, at(0), 1, at(0)), (1, "b", 2.0, at(5), 2, at(5)), (1, "a", 3.0, at(4), 3, at(6)), (1, "b", 4.0, at(5), 4, at(7)), (2, "a", 5.0, at(-9), 5, at(8))], shape)
    none = p.limit(0).select("device_id", "metric_key", "value", "time", "raw_message_id")
    whole = state.latest_after(p, none)
    parts = state.latest_after(p.where("raw_message_id > 2"), state.latest_after(p.where("raw_message_id <= 2"), none))
    got = lambda df: sorted((r["device_id"], r["metric_key"], r["value"]) for r in df.collect())
    assert got(whole) == got(parts) == [(1, "a", 1.0), (1, "b", 4.0), (2, "a", 5.0)]
    assert ingest.looks_back([contexts.Step(smooth)]) and not ingest.looks_back([(smooth, "FAIL_OPEN")])


def test_milliseconds_of_windows(spark):
    assert [contexts.rounded(us) for us in (148_210, 148_499, 148_500, 148_760, -500, -499)] == [148, 148, 149, 149, -1, 0]
    at = lambda i, us: (1, i, T0 + dt.timedelta(microseconds=us), T0 + dt.timedelta(minutes=i), False, None, json.dumps({"messageId": i, "metrics": [{"key": "temp", "value": 1.0}]}), None)
    df = spark.createDataFrame([at(1, 148_210), at(2, 148_760)], COLUMNS)
    n = lambda **options: values(contexts.with_past(df, [contexts.Step(smooth)], **options))[2][2]["n"]
    assert (n(), n(whole=contexts.rounded)) == (0, 1)  # the same whole millisecond, but not the same nearest one
