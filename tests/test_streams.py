"""State across micro-batches: what several batches give is what one gives, with ties, replays and missing ids at their bounds."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from fluxgrain.operators import quality, state
from fluxgrain.sources import store
from fluxgrain.sources.telemetry import TELEMETRY
from fluxgrain.streaming import ingest, series

T0 = dt.datetime(2024, 3, 1, 12)
SOURCES = {1: {"decoder": "single-value"}, 2: {"decoder": "single-value"}}
DEVICE = "source_id bigint, external_id string, device_id bigint, organization_id bigint, status string, ignored boolean"


def message(i, minute, device="a", value="1", key=None, mid="", **more):
    row = {"id": i, "message_id": f"m{i}" if mid == "" else mid, "organization_id": 1, "source_id": 1, "source_type": "MQTT_SUBSCRIBE", "topic": f"x/{device}/temp", "payload": bytearray(value.encode())}
    row |= {"received_at": T0 + dt.timedelta(minutes=minute), "dedup_key": key, "virtual": False, "topic_attributes": {}, "ingress_status": None}
    return row | more


def frame(spark, rows, extra=""):
    names = [x.split()[0] for x in (ingest.ENVELOPE + extra).split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ingest.ENVELOPE + extra)


def dims(spark, devices=(("a", 1, "ACTIVE"),)):
    d = spark.createDataFrame([(1, x, i, 1, s, False) for x, i, s in devices], DEVICE)
    definitions = spark.createDataFrame([], "metric_key string, unit string, valid_min double, valid_max double, status string, enum_map map<string,double>")
    return d, definitions, spark.createDataFrame([], "organization_id bigint, alias string, metric_key string")


def stream(spark, base, batches, dimensions, **options):
    for rows in batches:
        frame(spark, rows).coalesce(1).write.mode("append").parquet(f"{base}/in")
        ingest.run_stored(ingest.read_envelopes(spark, f"{base}/in", 1), base, SOURCES, *dimensions, **options).awaitTermination()
    return {r["id"]: r for r in spark.read.parquet(f"{base}/messages").collect()}


def test_quota_over_batches(spark):
    policies = spark.createDataFrame([(1, "AUTO_REGISTER", 2)], "source_id bigint, policy string, hourly_limit int")
    base = store.scratch(spark, "quota")
    got = stream(spark, base, [[message(1, 0, "x"), message(2, 1, "y")], [message(3, 2, "x"), message(4, 3, "z"), message(5, 61, "z")], [message(6, 62, "v"), message(7, 63, "w"), message(8, 64, "z")]], dims(spark), policies=policies)
    assert [got[i]["status"] for i in range(1, 9)] == ["OK", "OK", "OK", "UNKNOWN_DEVICE_REJECTED", "UNKNOWN_DEVICE_REJECTED", "OK", "OK", "UNKNOWN_DEVICE_REJECTED"]
    assert got[1]["device_id"] == got[3]["device_id"] and got[4]["error"] == "ING_AUTO_REGISTER_QUOTA"
    told = spark.read.parquet(f"{base}/registered").where("alarm").collect()
    assert [(r["external_id"], r["accepted"]) for r in told] == [("z", False), ("z", False)]  # once an hour, in batches 1 and 2


def test_duplicates_over_batches(spark):
    base = store.scratch(spark, "copies")
    first = [message(1, 55, key="k"), message(2, 56, mid=None), message(3, 56, mid=None)]
    second = [message(4, 64, key="k"), message(5, 75, key="k"), message(6, 56, mid=None), message(1, 55, key="k"), message(7, 75, "unknown", key="k"), message(8, 76, key="k", value="no number")]
    got = stream(spark, base, [first, second], dims(spark))
    assert {i: r["status"] for i, r in got.items()} == {1: "OK", 2: "OK", 3: "OK", 4: "DUPLICATE", 5: "OK", 6: "OK", 7: "DUPLICATE", 8: "DUPLICATE"}
    assert spark.read.parquet(f"{base}/messages").count() == 8  # the replayed first message is not stored again
    assert spark.read.parquet(f"{base}/points").count() == 5
    read = ingest.earlier_ids(spark, base, frame(spark, [message(9, 75)]), 2)
    assert sorted(f.rsplit("slot=", 1)[1][:10] for f in read.inputFiles()) == ["2024030113"]  # neither hour 12 nor any other


def test_repeated_batch_changes_nothing(spark):
    base = store.scratch(spark, "again")
    frame(spark, [message(1, 0), message(2, 1)]).write.parquet(f"{base}/in")
    for _ in range(2):  # a new checkpoint: the same batch number comes again
        ingest.run_stored(ingest.read_envelopes(spark, f"{base}/in"), base, SOURCES, *dims(spark)).awaitTermination()
        store_path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/checkpoint")
        store_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(store_path, True)
    assert spark.read.parquet(f"{base}/points").count() == 2 and spark.read.parquet(f"{base}/messages").count() == 2


def test_order_of_judgement(spark):
    rows = [
        message(1, 0, key="k"),
        message(2, 1, "unknown", key="k"),  # a copy, whatever its device
        message(3, 1, key="k", value="??"),  # a copy, whatever its payload
        message(4, 2, "unknown", key="other"),
        message(5, 2, key="third", source_id=9),
        message(6, 3, key="sha256:1"),
        message(7, 5, key="sha256:1"),  # in the next half interval of 150 seconds
        message(8, 6, key="sha256:1"),
        message(9, 4, "unknown", key="sha256:1"),
        message(10, 5, key="third", source_id=9),
    ]
    out, _ = ingest.process(frame(spark, rows), SOURCES, *dims(spark))
    got = {r["id"]: r["status"] for r in out.collect()}
    assert got == {1: "OK", 2: "DUPLICATE", 3: "DUPLICATE", 4: "UNKNOWN_DEVICE_REJECTED", 5: "DECODE_ERROR", 6: "OK", 7: "OK", 8: "DUPLICATE", 9: "UNKNOWN_DEVICE_REJECTED", 10: "DECODE_ERROR"}


def test_signatures(spark):
    own = {"source_type": "PLATFORM_BROKER"}
    rows = [message(i, i, d, signature_status=s, **own) for i, (d, s) in enumerate([("a", "VERIFIED"), ("a", "UNSIGNED"), ("a", "INVALID"), ("p", "UNSIGNED"), ("p", "INVALID"), ("u", "UNSIGNED")])] + [message(6, 6, signature_status=None)]
    d = dims(spark, [("a", 1, "ACTIVE"), ("p", 2, "PENDING")])
    out, points = ingest.process(frame(spark, rows, ", signature_status string"), SOURCES, *d)
    got = {r["id"]: (r["status"], r["error"]) for r in out.collect()}
    refused = ("INVALID", "ING_SIGNATURE_INVALID")
    assert got == {0: ("OK", None), 1: refused, 2: refused, 3: ("OK", None), 4: refused, 5: ("UNKNOWN_DEVICE_REJECTED", "ING_DEVICE_UNKNOWN"), 6: ("OK", None)}
    assert {r["raw_message_id"] for r in points.collect()} == {0, 3, 6}


def test_limits_go_value_by_value(spark):
    from fluxgrain.operators import metrics

    long, short = ("k" * 65, "x", "text"), ("k", "y" * 1025, "text")
    rows = [(1, [short, long]), (2, [long, short]), (3, [("k", "z", "text")] * 101), (4, [("k", "z", "text")])]
    d = spark.createDataFrame(rows, "id int, values array<struct<key:string,text:string,kind:string>>")
    got = [r[0] for r in d.orderBy("id").select(metrics.over_limits(F.col("values"))).collect()]
    assert got == ["ING_VALUE_TOO_LONG", "ING_KEY_TOO_LONG", "ING_TOO_MANY_VALUES", None]


POINT = "device_id, metric_key, time, organization_id, value, quality, flags, is_virtual, received_at, raw_message_id"


def point(i, minute, value, received=None, metric="temp"):
    at = T0 + dt.timedelta(minutes=minute)
    return (1, metric, at, 1, float(value), 0, 0, False, T0 + dt.timedelta(minutes=minute if received is None else received), i)


@pytest.mark.parametrize("cut", [1, 3, 100])
def test_series_state(spark, cut):
    rows = [point(i, i, 20) for i in range(15)] + [point(15, 15, 60), point(16, 14, 61, 16), point(17, 17, 60), point(18, 80, 60), point(19, 80, 60, 81)]
    definitions = spark.createDataFrame([("temp", 0.0, 100.0, None, False)], "metric_key string, valid_min double, valid_max double, value_type string, state_type boolean")
    on_change = spark.createDataFrame([(1, "temp")], "organization_id bigint, metric_key string")
    base = store.scratch(spark, "series")
    for k in range(0, len(rows), cut):
        store.published(spark.createDataFrame(rows[k : k + cut], TELEMETRY).coalesce(1), f"{base}/points/batch={k}")
        if cut > 1:  # restarted after each batch
            series.run_judged(spark, base, definitions, on_change).awaitTermination()
    if cut == 1:
        series.run_judged(spark, base, definitions, on_change, files=1).awaitTermination()
    whole = spark.createDataFrame(rows, TELEMETRY)
    got = {r["raw_message_id"]: (r["suspect"], r["kept"]) for r in spark.read.parquet(f"{base}/judged").collect()}
    suspect = {r["raw_message_id"]: r["suspect"] for r in quality.suspects(whole, definitions).collect()}
    kept = {r["raw_message_id"] for r in state.stored_on_change(whole).collect()}
    assert got == {i: (suspect[i], i in kept) for i in range(20)}
    assert {i for i, (s, _) in got.items() if s} == {11, 12, 13, 14, 15} and {0, 15, 16, 18} == kept


def test_series_starts_from_stored_points(spark):
    definitions = spark.createDataFrame([], "metric_key string, valid_min double, valid_max double, value_type string, state_type boolean")
    on_change = spark.createDataFrame([(1, "temp")], "organization_id bigint, metric_key string")
    base, old = store.scratch(spark, "seeded"), spark.createDataFrame([point(1, 0, 20)], TELEMETRY)
    store.published(spark.createDataFrame([point(2, 1, 20), point(3, 2, 21)], TELEMETRY), f"{base}/points/batch=0")
    series.run_judged(spark, base, definitions, on_change, series.seeds(old)).awaitTermination()
    assert {r["raw_message_id"]: (r["kept"], r["flags"]) for r in spark.read.parquet(f"{base}/judged").collect()} == {2: (False, 0), 3: (True, 8)}


def test_rolling_over_batches(spark):
    base = store.scratch(spark, "rolling")
    batches = [[message(1, 0, value="2")], [message(2, 10, value="4"), message(3, 20, "other", value="9")], [message(4, 65, value="6"), message(5, 30 * 60, value="8")]]
    stream(spark, base, batches, dims(spark), formulas={"mean": "rolling_mean(temp, 1h)"})
    got = {r["raw_message_id"]: r["value"] for r in spark.read.parquet(f"{base}/points").where("metric_key = 'mean'").collect()}
    assert got == {1: 2.0, 2: 3.0, 4: 5.0, 5: 8.0}


def test_late_rows_have_no_window(spark):
    from fluxgrain.functions import formula

    rows = [(1, "a", T0, 1.0, 0), (1, "a", T0 + dt.timedelta(minutes=1), 3.0, 0), (1, "a", T0 + dt.timedelta(minutes=2), 8.0, 1), (1, "b", T0 + dt.timedelta(minutes=3), 5.0, 0), (1, "b", T0 + dt.timedelta(hours=30), 5.0, 0)]
    p = spark.createDataFrame(rows, "device_id bigint, metric_key string, time timestamp, value double, flags int")
    got = {r["time"]: r["value"] for r in formula.evaluate(p, {"m": "rolling_mean(a, 1h)", "x": "b"}).where("metric_key = 'm'").collect()}
    assert got == {T0: 1.0, T0 + dt.timedelta(minutes=1): 2.0, T0 + dt.timedelta(minutes=2): 8.0, T0 + dt.timedelta(minutes=3): 2.0}  # the last has neither value nor window


def test_formulas_by_scope(spark):
    devices, definitions, aliases = dims(spark, [("a", 1, "ACTIVE"), ("b", 2, "ACTIVE")])
    devices = devices.withColumns({"model_id": F.lit(7).cast("bigint"), "space_id": F.when(F.col("device_id") == 1, 5).cast("bigint")})
    rows = [(1, "MODEL", 7, "out", "temp * 2", "u"), (2, "DEVICE", 1, "out", "temp * 3", "v"), (3, "SPACE", 5, "more", "out + 1", None), (4, "MODEL", 7, "bad", "temp +", None), (5, "SPACE", 5, "temp", "temp + 100", None), (6, "DEVICE", 2, None, "temp", None)]
    formulas = spark.createDataFrame(rows, "id bigint, target_type string, target_id bigint, result_key string, expression string, unit string")
    _, points = ingest.process(frame(spark, [message(1, 0, "a", "4"), message(2, 0, "b", "5"), message(3, 0, "a", "6")]), SOURCES, devices, definitions, aliases, formulas=formulas)
    got = {(r["raw_message_id"], r["metric_key"]): (r["value"], r["flags"]) for r in points.collect()}
    # the device's formula comes after its model's; all read the message's own values, so that none sees out
    assert got == {(1, "out"): (12.0, 16), (1, "temp"): (104.0, 16), (2, "temp"): (5.0, 0), (2, "out"): (10.0, 16), (3, "out"): (18.0, 16), (3, "temp"): (106.0, 16)}


def test_unreadable_lines(spark):
    whole = {"id": 1, "message_id": "m", "payload": "MQ==", "received_at": "2024-01-01T00:00:00Z"}
    good, bad = ingest.from_json_lines(spark.createDataFrame([(json.dumps(whole),), ("{",), ('{"id": 2}',), (None,)], "value string"))
    assert [(r["id"], bytes(r["payload"])) for r in good.collect()] == [(1, b"1")] and bad.count() == 3


def test_minutes_advance(spark):
    from fluxgrain.operators import rollup
    from fluxgrain.streaming import aggregation

    base, at = store.scratch(spark, "minutes"), lambda m: T0 + dt.timedelta(minutes=m)
    rows = [point(1, 0, 1), point(2, 0.5, 2), point(3, 3, 4), point(4, 1, 9, 10), point(5, 12, 5)]  # the fourth comes nine minutes late
    p = spark.createDataFrame(rows, TELEMETRY)
    seen = lambda m: p.where(F.col("received_at") <= F.lit(at(m)))
    assert aggregation.advance(seen(0).limit(0), base, at(0)) is None
    assert aggregation.advance(seen(4), base, at(4), dt.timedelta(minutes=2)) == at(3)
    first = {r["bucket"]: r["count"] for r in aggregation.minutes(spark, base).collect()}
    assert first == {at(0): 2}  # minute 3 is open until 4:30
    for _ in range(2):  # a run that comes again changes nothing
        assert aggregation.advance(seen(11), base, at(11), dt.timedelta(minutes=2)) == at(10)
        got = sorted(map(str, aggregation.minutes(spark, base).collect()))
        whole = rollup.minutes(p.where(F.col("time") < F.lit(at(10))))
        assert got == sorted(map(str, whole.select(*aggregation.minutes(spark, base).columns).collect()))
    assert aggregation.last_run(spark, base) == (at(11), at(10))
