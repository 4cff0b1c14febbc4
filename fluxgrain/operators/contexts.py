"""User functions that look back on their device: messages and stored points of a device, merged in order of arrival in one sorted Arrow stream."""

from __future__ import annotations

import datetime
import json
import math
import re
from collections import deque
from collections.abc import Callable, Iterator
from types import MappingProxyType
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxgrain.functions.scalars import METRIC_KEY
from fluxgrain.operators.scripts import INVALID, MAX_DEPTH, MAX_OUTPUT, depth

#: The longest window in milliseconds, its most points, the most metrics of a message, milliseconds of a unit of time.
DAY, MAX_POINTS, MAX_METRICS = 86_400_000, 1_440, 100
UNITS = {"s": 1_000, "m": 60_000, "h": 3_600_000}


class Step(NamedTuple):
    """A function(message, context) -> message or None, for all devices, those of a model or one device; steps run in that order, as given within each."""

    function: Callable
    policy: str = "FAIL_OPEN"
    config: dict | None = None
    model_id: int | None = None
    device_id: int | None = None


def milliseconds(duration: str) -> int:
    """Milliseconds of a duration such as 90s, 15m or 24h, which is the longest."""
    m = re.fullmatch(r"(\d+)([smh])", duration)
    found = int(m[1]) * UNITS[m[2]] if m else 0
    if not 0 < found <= DAY:
        raise ValueError(f"{duration} is no duration of at most 24 hours")
    return found


def instant(us: int) -> str:
    """ISO 8601 with no fraction, milliseconds or microseconds, whatever it takes."""
    t = datetime.datetime(1970, 1, 1) + datetime.timedelta(microseconds=us)
    return t.isoformat(timespec="seconds" if us % 1_000_000 == 0 else "milliseconds" if us % 1_000 == 0 else "microseconds") + "Z"


def metrics_of(result) -> list[dict]:
    """The metrics of what a function returned, flags as 1 and 0, of a repeated key the last at its first place; ValueError if it breaks the contract."""
    if not isinstance(result, dict):
        raise ValueError(f"{INVALID}: not an object")
    items = result.get("metrics")
    if not isinstance(items, list):
        raise ValueError(f"{INVALID}: metrics")
    if len(items) > MAX_METRICS:
        raise ValueError(f"{INVALID}: over {MAX_METRICS} metrics")
    if not all(isinstance(x, dict) and isinstance(x.get("key"), str) and re.fullmatch(METRIC_KEY, x["key"]) for x in items):
        raise ValueError(f"{INVALID}: key")
    if not all(isinstance(x.get("value"), bool | int | float) and math.isfinite(x["value"]) for x in items):
        raise ValueError(f"{INVALID}: value")
    return list({x["key"]: {**x, "value": int(x["value"]) if isinstance(x["value"], bool) else x["value"]} for x in items}.values())


def floored(us: int) -> int:
    return us // 1_000


def rounded(us: int) -> int:
    """The nearest millisecond, halves away from zero, as DuckDB's epoch_ms() has it."""
    return (us + 500) // 1_000 if us >= 0 else -((500 - us) // 1_000)


class Past:
    """What a device's functions may look back on: the newest value of each metric, and each metric's last points that came in time and in order."""

    def __init__(self, whole: Callable[[int], int] = floored) -> None:
        self.whole = whole
        self.last: dict[str, tuple[float, int]] = {}
        self.top: int | None = None
        self.points: dict[str, deque] = {}

    def record(self, key: str, value: float, us: int, late: bool) -> None:
        if self.top is None or us >= self.top:
            self.last[key], self.top = (value, us), us
        if not late:
            held, ms = self.points.setdefault(key, deque(maxlen=MAX_POINTS)), self.whole(us)
            if not held or held[-1][0] < ms:
                held.append((ms, value))
                while held[0][0] < ms - DAY:
                    held.popleft()

    def window(self, us: int, late: bool) -> Callable[[str, str], list[float]]:
        now = self.whole(us)

        def values(key: str, duration: str) -> list[float]:
            first = now - milliseconds(duration)
            return [] if late else [v for ms, v in self.points.get(key, ()) if first <= ms < now]

        return values


def with_past(messages: DataFrame, steps: list[Step], history: DataFrame | None = None, last: DataFrame | None = None, column: str = "message", whole: Callable[[int], int] = floored) -> DataFrame:
    """messages (device_id, id, time, received_at, late, device as JSON text with its modelId, and JSON text in ``column``) with what the steps make of the text, dropped and script_error.

    A function gets the message and a read-only context: device, config of its step, last ({key: {value, measuredAt}}) and window(key, duration), the values of the
    duration before the message's time. Both hold what came before the message in order of (received_at, id): stored points (history: as telemetry, from a day before the
    first message on; last: device_id, metric_key, value, time of the newest values that history does not have) and what the steps made of earlier messages. A message older than the newest
    one of its device does not change last. Late points are in no window, and late messages have none. A step that fails or breaks the contract
    (metrics_of()) leaves its message as it was if its policy is FAIL_OPEN; FAIL_CLOSED makes it a script error. None drops it. Neither of these is seen by later ones.

    What a function returns is what the next message's function looks back on, so a device's messages run one after the other; they pass as a sorted stream, with a state of
    1,440 points a metric, so no task holds a device. Messages without a device look back on nothing and are spread. Columns keep their types and values.
    whole: how microseconds become the milliseconds by which windows are bounded: floored (the product's way) or rounded.
    """
    us = lambda c: F.unix_micros(c)
    own = messages.withColumns({"_kind": F.lit(2), "_id": F.col("id").cast("bigint"), "_came": us("received_at"), "_us": us("time"), "_late": F.coalesce("late", F.lit(False)), "_key": F.lit(None).cast("string"), "_value": F.lit(None).cast("double")})
    rows = own
    shape = lambda df, kind, i, came, late: df.where("device_id IS NOT NULL").select("device_id", F.lit(kind).alias("_kind"), i.cast("bigint").alias("_id"), came.alias("_came"), us("time").alias("_us"), late.alias("_late"), F.col("metric_key").alias("_key"), F.col("value").alias("_value"))
    if history is not None:
        rows = rows.unionByName(shape(history, 1, F.col("raw_message_id"), us("received_at"), F.col("flags").bitwiseAND(1) != 0), allowMissingColumns=True)
    if last is not None:
        rows = rows.unionByName(shape(last, 0, F.lit(None), F.lit(None).cast("bigint"), F.lit(True)), allowMissingColumns=True)
    names = [c for c in messages.columns if c != column]
    steps = [Step(*s) for s in steps]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        device, past, about, mine = None, Past(whole), None, []
        for batch in batches:
            said, mask = [], []
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("device_id", "_kind", "_us", "_late", "_key", "_value", "device", column)]
            for d, kind, t, late, key, value, described, text in zip(*columns):
                if d is None or d != device:
                    device, past, about = d, Past(whole), None
                mask.append(kind == 2)
                if kind == 0:
                    past.last[key] = (value, t)
                    past.top = t if past.top is None else max(past.top, t)
                elif kind == 1:
                    past.record(key, value, t, late)
                else:
                    if about is None or described != about:
                        about = described
                        facts = json.loads(described or "{}")
                        mine = [s for s in steps if s.model_id is None and s.device_id is None]
                        mine += [s for s in steps if s.model_id is not None and str(s.model_id) == str(facts.get("modelId"))]
                        mine += [s for s in steps if s.device_id is not None and s.device_id == d]
                    said.append(judged(past, json.loads(text), mine, about, t, late))
            kept = pa.Table.from_batches([batch]).filter(pa.array(mask, pa.bool_())).select(names)
            for i, (name, kind) in enumerate(((column, pa.string()), ("dropped", pa.bool_()), ("script_error", pa.string()))):
                kept = kept.append_column(name, pa.array([s[i] for s in said], kind))
            yield from kept.to_batches()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in messages.select(*names).schema)
    spread = F.when(F.col("device_id").isNull(), F.col("_id"))
    ordered = rows.repartition("device_id", spread).sortWithinPartitions("device_id", F.col("_kind") > 0, "_came", "_id", "_kind")
    return ordered.mapInArrow(run, f"{fields}, `{column}` string, dropped boolean, script_error string")


def judged(past: Past, message: dict, steps: list[Step], about: str | None, us: int, late: bool) -> tuple[str, bool, str | None]:
    """(message as JSON, dropped, error) after the steps; what is left is recorded for the device's next messages."""
    device = MappingProxyType(json.loads(about or "{}"))
    last = MappingProxyType({k: {"value": v, "measuredAt": instant(t)} for k, (v, t) in past.last.items()})
    window = past.window(us, late)
    for s in steps:
        try:
            result = s.function(json.loads(json.dumps(message)), MappingProxyType({"device": device, "last": last, "window": window, "config": MappingProxyType(s.config or {})}))
            if result is None:
                return json.dumps(message, ensure_ascii=False), True, None
            metrics = metrics_of(result)
            if len(json.dumps(result, ensure_ascii=False).encode()) > MAX_OUTPUT or depth(result) > MAX_DEPTH:
                raise ValueError("the output breaks a limit")
            units = {m["key"]: m.get("unit") for m in message["metrics"]}
            message = {**result, "metrics": [{**m, "unit": m.get("unit") or units.get(m["key"])} for m in metrics]}
        except Exception as e:  # whatever a user's function raises is the function's error
            if s.policy == "FAIL_CLOSED":
                return json.dumps(message, ensure_ascii=False), False, str(e) if str(e).startswith(INVALID) else f"SCRIPT_ERROR: {e}"
    for m in message["metrics"]:
        past.record(m["key"], float(m["value"]), us, late)
    return json.dumps(message, ensure_ascii=False), False, None
