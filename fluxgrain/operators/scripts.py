"""Running of user functions on messages, and the statistics of their runs."""

from __future__ import annotations

import ast
import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluxgrain.functions.scalars import METRIC_KEY

MAX_CODE, MAX_OUTPUT, MAX_DEPTH = 65_536, 65_536, 32
FORBIDDEN = ("eval", "exec", "compile", "open", "__import__", "globals", "locals", "input", "breakpoint", "getattr", "setattr", "delattr", "vars")
MODULES = ("math", "json", "datetime", "base64", "struct")
RESULT = "message string, dropped boolean, error string"


def check(source: str, entry: str) -> list[tuple[str, int, int]]:
    """What is wrong with a function's source: (message, line, column); nothing is run."""
    if len(source.encode()) > MAX_CODE:
        return [(f"the source has over {MAX_CODE} bytes", 1, 1)]
    try:
        tree = ast.parse(source)
    except SyntaxError as e:
        return [(f"syntax: {e.msg}", e.lineno or 1, e.offset or 1)]
    found = []
    for node in ast.walk(tree):
        at = (getattr(node, "lineno", 1), getattr(node, "col_offset", 0) + 1)
        if isinstance(node, ast.Name) and node.id in FORBIDDEN:
            found.append((f"{node.id} is not allowed", *at))
        elif isinstance(node, ast.Attribute) and node.attr.startswith("__"):
            found.append((f"{node.attr} is not allowed", *at))
        elif isinstance(node, ast.Import | ast.ImportFrom):
            names = [node.module or ""] if isinstance(node, ast.ImportFrom) else [a.name for a in node.names]
            found += [(f"module {n} is not allowed", *at) for n in names if n not in MODULES]
        elif isinstance(node, ast.Global):
            found.append(("global is not allowed", *at))
    own = [n for n in tree.body if isinstance(n, ast.FunctionDef) and n.name == entry]
    if not own:
        found.append((f"function {entry} is missing", 1, 1))
    elif not any(isinstance(n, ast.Return) and n.value is not None for n in ast.walk(own[0])):
        found.append((f"warning: {entry} returns nothing", own[0].lineno, 1))
    return sorted(found, key=lambda x: x[1:])


def linked(sources: dict[str, tuple[str, list[str]]], wanted: list[str]) -> list[str]:
    """The order in which modules name@version are to be loaded: sources has each one's text and imports. Unknown ones and cycles are errors."""
    order, open_ = [], []

    def visit(name: str) -> None:
        if name in order:
            return
        if name in open_:
            raise ValueError("modules import one another: " + " -> ".join([*open_, name]))
        if name not in sources:
            raise ValueError(f"unknown module {name}")
        open_.append(name)
        for x in sources[name][1]:
            visit(x)
        open_.pop()
        order.append(name)

    for name in wanted:
        visit(name)
    return order


def depth(value) -> int:
    if isinstance(value, dict):
        return 1 + max(map(depth, value.values()), default=0)
    return 1 + max(map(depth, value), default=0) if isinstance(value, list) else 0


def transform(messages: DataFrame, functions: list[tuple[Callable, str]], column: str = "message", context: dict | None = None) -> DataFrame:
    """JSON messages through functions(message, context) -> message or None (drop), one after the other.

    Each function has a policy: FAIL_OPEN keeps its input when it fails or its output breaks a limit, FAIL_CLOSED makes the message a script error.
    """
    frozen = json.dumps(context or {})

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        ctx = json.loads(frozen)
        for texts in batches:
            out = []
            for text in texts:
                error, dropped = None, False
                for f, policy in functions:
                    try:
                        result = f(json.loads(text), ctx)
                        if result is None:
                            dropped = True
                            break
                        said = json.dumps(result, ensure_ascii=False)
                        if len(said.encode()) > MAX_OUTPUT or depth(result) > MAX_DEPTH or not isinstance(result, dict):
                            raise ValueError("the output breaks a limit")
                        text = said
                    except Exception as e:  # whatever a user's function raises is the function's error
                        if policy == "FAIL_CLOSED":
                            error = f"SCRIPT_ERROR: {e}"
                            break
                out.append((text, dropped, error))
            yield pd.DataFrame(out, columns=["message", "dropped", "error"])

    run_udf = F.pandas_udf(run, RESULT)
    return messages.withColumn("_r", run_udf(F.col(column))).withColumns({column: F.col("_r.message"), "dropped": F.col("_r.dropped"), "script_error": F.col("_r.error")}).drop("_r")


INVALID = "SCRIPT_OUTPUT_INVALID"


def valid_output(output: Column, decodes: bool = False, most: int = 100) -> Column:
    """struct<error, metrics> of a function's output (JSON text) by its contract: an object whose metrics are a list of {key, value, unit}.

    Keys are of a metric's shape, values finite numbers or flags (1 and 0); of a repeated key the last counts, at its first place. What a decoder returns needs an
    externalId of 1 to 128 characters too.
    """
    v = F.try_parse_json(output)
    of = lambda x, name, kind: F.try_variant_get(x, f"$.{name}", kind)
    typed = lambda x, name, *kinds: F.coalesce(F.schema_of_variant(of(x, name, "variant")).rlike("^(" + "|".join(kinds) + ")"), F.lit(False))
    items = of(v, "metrics", "array<variant>")
    number = lambda x: F.when(typed(x, "value", "BOOLEAN"), of(x, "value", "boolean").cast("double")).when(typed(x, "value", "BIGINT", "DECIMAL", "DOUBLE", "FLOAT", "INT"), of(x, "value", "double"))
    read = F.transform(items, lambda x: F.struct(F.when(typed(x, "key", "STRING"), of(x, "key", "string")).alias("key"), number(x).alias("value"), F.when(typed(x, "unit", "STRING"), of(x, "unit", "string")).alias("unit")))
    finite = lambda m: m["value"].isNotNull() & ~F.isnan(m["value"]) & (F.abs(m["value"]) < float("inf"))
    named = lambda m: F.coalesce(m["key"].rlike(METRIC_KEY), F.lit(False))
    own = of(v, "externalId", "string")
    error = F.when(v.isNull() | ~F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)), f"{INVALID}: not an object")
    if decodes:
        error = error.when(~typed(v, "externalId", "STRING") | (F.trim(own) == "") | (F.length(own) > 128), f"{INVALID}: externalId")
    error = error.when(items.isNull(), f"{INVALID}: metrics").when(F.size(items) > most, f"{INVALID}: over {most} metrics").when(~F.forall(read, named), f"{INVALID}: key").when(~F.forall(read, finite), f"{INVALID}: value")
    last = F.transform(F.array_distinct(F.transform(read, lambda m: m["key"])), lambda k: F.element_at(F.filter(read, lambda m: m["key"] == k), -1))
    return F.struct(error.alias("error"), F.when(error.isNull(), last).alias("metrics"))


def part(value, path: str):
    """What a JSON value has at a path such as $.a[0].b; a name in a list is that of the element whose key it is. None if there is nothing."""
    for name, index in re.findall(r"([^.\[\]$]+)|\[(\d+)\]", path):
        if index:
            value = value[int(index)] if isinstance(value, list) and int(index) < len(value) else None
        elif isinstance(value, list):
            value = next((x for x in value if isinstance(x, dict) and x.get("key") == name), None)
        else:
            value = value.get(name) if isinstance(value, dict) else None
    return value


def differences(expected, actual, mode: str = "EXACT", fields: list[str] | None = None, tolerance: float | None = None) -> list[tuple[str, str, str]]:
    """(path, expected, actual) where two JSON values differ: anywhere, or (FIELDS) at some paths only; numbers may differ by the tolerance (TOLERANCE)."""
    allowed = abs(tolerance or 0.0) if mode == "TOLERANCE" else 0.0
    numeric = lambda x: isinstance(x, int | float) and not isinstance(x, bool)
    open_ = [(p, part(expected, p), part(actual, p)) for p in fields] if mode == "FIELDS" and fields else [("$", expected, actual)]
    out = []
    while open_:
        path, e, a = open_.pop()
        if isinstance(e, dict) and isinstance(a, dict):
            open_ += [(f"{path}.{k}", e.get(k, ...), a.get(k, ...)) for k in {**e, **a}]
        elif isinstance(e, list) and isinstance(a, list):
            open_ += [(f"{path}[{i}]", e[i] if i < len(e) else ..., a[i] if i < len(a) else ...) for i in range(max(len(e), len(a)))]
        elif numeric(e) and numeric(a):
            if abs(e - a) > allowed + 1e-12:
                out.append((path, e, a))
        elif type(e) is not type(a) or e != a:
            out.append((path, e, a))
    said = lambda x: None if x is ... else json.dumps(x, ensure_ascii=False)
    return sorted((p, said(e), said(a)) for p, e, a in out)


def compared(cases: DataFrame) -> DataFrame:
    """cases (expected, actual: JSON text, mode, fields: array of paths, tolerance) with passed and differences."""

    @F.pandas_udf("array<struct<path:string,expected:string,actual:string>>")
    def run(expected: pd.Series, actual: pd.Series, mode: pd.Series, fields: pd.Series, tolerance: pd.Series) -> pd.Series:
        rows = zip(expected, actual, mode, fields, tolerance)
        found = [differences(json.loads(e), json.loads(a), m or "EXACT", None if f is None else list(f), None if t is None or t != t else t) for e, a, m, f, t in rows]
        return pd.Series([[dict(zip(("path", "expected", "actual"), d)) for d in ds] for ds in found])

    out = cases.withColumn("differences", run("expected", "actual", "mode", "fields", "tolerance"))
    return out.withColumn("passed", F.size("differences") == 0)


#: Samples of a minute that the percentile is taken of, lines a second that a script may log, and what looks like a loop in its code.
MAX_SAMPLES, LOGS_PER_SECOND = 5_000, 10
LOOP = r"\b(for|while|do)\b\s*[({]|\.(forEach|map|reduce|filter)\s*\("


def minute_stats(runs: DataFrame, logs: DataFrame | None = None, samples: int = MAX_SAMPLES) -> DataFrame:
    """Per script, version and minute: runs, errors, timeouts, mean and nearest-rank 95th percentile of the time, largest time and input.

    runs: (script_id, version, run_at, elapsed_ms, failed, timed_out, input_bytes). The percentile is of the minute's first ``samples`` runs, so that a busy minute's aggregate stays small: exact up to
    that many; beyond them it is that of those runs alone. logs: (script_id, version, at, id), adds logs_dropped (limited_logs()); lines in a minute without runs are not told.
    """
    bucket = F.date_trunc("minute", "run_at")
    first = F.row_number().over(Window.partitionBy("script_id", "version", bucket).orderBy("run_at", "elapsed_ms")) <= samples
    g = runs.withColumn("_sample", F.when(first, F.col("elapsed_ms"))).groupBy("script_id", "version", bucket.alias("bucket"))
    out = g.agg(
        F.count("*").alias("processed"),
        F.count(F.when(F.col("failed"), 1)).alias("errors"),
        F.count(F.when(F.col("timed_out"), 1)).alias("timeouts"),
        (F.sum(F.col("elapsed_ms").cast("decimal(18,6)")).cast("double") / F.count("*")).alias("avg_ms"),
        F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY _sample)").alias("p95_ms"),
        F.max("elapsed_ms").alias("max_ms"),
        F.max("input_bytes").alias("max_input"),
    )
    if logs is None:
        return out
    lost = limited_logs(logs).where("NOT kept").groupBy("script_id", "version", F.date_trunc("minute", "at").alias("bucket")).agg(F.count("*").alias("logs_dropped"))
    return out.join(lost, ["script_id", "version", "bucket"], "left").withColumn("logs_dropped", F.coalesce("logs_dropped", F.lit(0)))


def limited_logs(logs: DataFrame, most: int = LOGS_PER_SECOND) -> DataFrame:
    """logs with kept: a script's first so many lines of each second."""
    second = Window.partitionBy("script_id", F.date_trunc("second", "at")).orderBy("at", "id")
    return logs.withColumn("kept", F.row_number().over(second) <= most)


def merged_stats(rows: DataFrame, unit: str = "hour") -> DataFrame:
    """Statistics of a coarser time from finer ones: sums, weighted means, the largest percentile and maximum."""
    g = rows.groupBy("script_id", "version", F.date_trunc(unit, "bucket").alias("bucket"))
    weighted = F.sum(F.col("avg_ms").cast("decimal(18,6)") * F.col("processed").cast("decimal(12,0)")).cast("double") / F.sum("processed")
    return g.agg(F.sum("processed").alias("processed"), F.sum("errors").alias("errors"), F.sum("timeouts").alias("timeouts"), weighted.alias("avg_ms"), F.max("p95_ms").alias("p95_ms"), F.max("max_ms").alias("max_ms"), F.max("max_input").alias("max_input"))


def hourly(hours: DataFrame, minutes: DataFrame) -> DataFrame:
    """Hour rows with those of minutes whose hour has none yet."""
    fresh = minutes.withColumn("_h", F.date_trunc("hour", "bucket")).join(hours.select("script_id", "version", F.col("bucket").alias("_h")), ["script_id", "version", "_h"], "left_anti").drop("_h")
    return hours.unionByName(merged_stats(fresh).select(*hours.columns))


def advice(stats: DataFrame, code: DataFrame | None = None) -> DataFrame:
    """(script_id, version, type, value, hints) of scripts' latest versions: SLOW with the 95th percentile if that is over 20 ms, hints naming every cause found (else CPU), and
    ERROR_RATE with the share if a tenth of the runs or more fail. code: (script_id, version, source)."""
    latest = stats.groupBy("script_id").agg(F.max_by("version", F.struct("bucket", "version")).alias("version"))
    g = stats.join(latest, ["script_id", "version"]).groupBy("script_id", "version")
    rows = g.agg(F.max("p95_ms").alias("p95_ms"), F.max("max_input").alias("max_input"), F.sum("errors").alias("errors"), F.sum("processed").alias("processed"))
    loop = F.lit(False)
    if code is not None:
        rows = rows.join(code.select("script_id", "version", F.col("source").rlike(LOOP).alias("_loop")), ["script_id", "version"], "left")
        loop = F.coalesce("_loop", F.lit(False))
    causes = F.array_compact(F.array(F.when(F.col("max_input") > 32_768, "LARGE_INPUT"), F.when(loop, "LARGE_LOOP")))
    hints = F.when(F.size(causes) > 0, causes).otherwise(F.array(F.lit("CPU")))
    said = lambda kind, value, why: F.struct(F.lit(kind).alias("type"), value.alias("value"), why.alias("hints"))
    slow = F.when(F.col("p95_ms") > 20, said("SLOW", F.floor(F.col("p95_ms") * 10 + 0.5) / 10.0, hints))
    often = F.when((F.col("processed") > 0) & (F.col("errors") * 10 >= F.col("processed")), said("ERROR_RATE", F.floor(F.col("errors") * 1000.0 / F.col("processed") + 0.5) / 1000.0, F.array().cast("array<string>")))
    return rows.select("script_id", "version", F.inline(F.array_compact(F.array(slow, often))))


def newest_errors(errors: DataFrame, keep: int = 100) -> DataFrame:
    """The newest errors of each script (occurred_at, then id, descending)."""
    order = Window.partitionBy("script_id").orderBy(F.desc("occurred_at"), F.desc("id"))
    return errors.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= keep).drop("_n")


def changed_keys(before: DataFrame, after: DataFrame, key: str = "metric_key") -> DataFrame:
    """(key, change): ADDED, REMOVED or CHANGED between two sets of (key, value)."""
    b, a = before.select(key, F.col("value").alias("_b"), F.lit(1).alias("_inb")), after.select(key, F.col("value").alias("_a"), F.lit(1).alias("_ina"))
    both = b.join(a, key, "full")
    change = F.when(F.col("_inb").isNull(), "ADDED").when(F.col("_ina").isNull(), "REMOVED").when(~F.col("_a").eqNullSafe(F.col("_b")), "CHANGED")
    return both.select(key, change.alias("change")).where("change IS NOT NULL")
