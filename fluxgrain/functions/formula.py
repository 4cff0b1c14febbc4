"""Derived-metric formulas: a small expression language compiled to Columns.

Numbers, metric keys, ``+ - * / % ^`` (``^`` binds tightest and to the right; a sign takes the power behind it), functions and
``rolling_mean|min|max|sum|count(key, 10m)``. A formula's result is null where an input is missing or the result is no
finite number; then the formula is left out for that row. Everything stays in Catalyst: no UDF.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_LENGTH, MAX_POINTS = 500, 1440


class FormulaError(ValueError):
    def __init__(self, message: str, position: int):
        super().__init__(f"{message} (at {position})")
        self.position = position


def _magnus(t: Column, h: Column) -> Column:
    """ln(h / 100) plus the Magnus term of temperature t (fixed values 17.62 and 243.12)."""
    return F.log(h / 100) + 17.62 * t / (243.12 + t)


def dew_point(t: Column, h: Column) -> Column:
    g = _magnus(t, h)
    return F.try_divide(243.12 * g, 17.62 - g)


def thi(t: Column, h: Column) -> Column:
    return 1.8 * t + 32 - 0.55 * (1 - h / 100) * (1.8 * t - 26)


def abs_humidity(t: Column, h: Column) -> Column:
    """Grams of water per cubic metre: vapour pressure over the gas constant of water vapour."""
    return 216.7 * (h / 100 * 6.112 * F.exp(17.62 * t / (243.12 + t)) / (273.15 + t))


def _all(combine: Callable) -> Callable:
    """Null if any argument is (least and greatest skip nulls)."""

    def f(*args: Column) -> Column:
        if len(args) == 1:
            return args[0]
        missing = args[0].isNull()
        for a in args[1:]:
            missing |= a.isNull()
        return F.when(~missing, combine(*args))

    return f


def _round(x: Column, digits: Column | None = None) -> Column:
    scale = F.lit(1.0) if digits is None else F.pow(F.lit(10.0), digits)
    return F.floor(x * scale + 0.5) / scale


#: name -> (least and most arguments, function of Columns)
FUNCTIONS: dict[str, tuple[int, int, Callable]] = {
    "thi": (2, 2, thi),
    "dew_point": (2, 2, dew_point),
    "dewpoint": (2, 2, dew_point),
    "abs_humidity": (2, 2, abs_humidity),
    "round": (1, 2, _round),
    "clamp": (3, 3, lambda x, low, high: _all(F.greatest)(low, _all(F.least)(high, x))),
    "c2f": (1, 1, lambda x: x * 1.8 + 32),
    "f2c": (1, 1, lambda x: (x - 32) / 1.8),
    "min": (1, 10, _all(F.least)),
    "max": (1, 10, _all(F.greatest)),
    "abs": (1, 1, F.abs),
    "sqrt": (1, 1, F.sqrt),
    "pow": (2, 2, F.pow),
    "log": (1, 1, F.log),
    "exp": (1, 1, F.exp),
}
ROLLING = {"rolling_mean": F.avg, "rolling_min": F.min, "rolling_max": F.max, "rolling_sum": F.sum, "rolling_count": F.count}
TOKEN = re.compile(r"\s*(?:(?P<number>\d+(?:\.\d*)?(?:[eE][+-]?\d+)?|\.\d+)|(?P<name>[A-Za-z_][A-Za-z0-9_]*)|(?P<op>[-+*/%^(),]))")
DURATION = re.compile(r"\s*(\d+)([smh])\b")
UNIT_SECONDS = {"s": 1, "m": 60, "h": 3600}


@dataclass
class Formula:
    source: str
    tree: tuple
    inputs: list[str] = field(default_factory=list)
    windows: list[tuple[str, int]] = field(default_factory=list)

    def column(self, metric: Callable[[str], Column], rolling: Callable[[str, str, int], Column] | None = None) -> Column:
        """The formula as a Column: ``metric(key)`` is a value at a row, ``rolling(function, key, seconds)`` one over a window."""
        value = _column(self.tree, metric, rolling)
        return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


class _Parser:
    def __init__(self, source: str, known: Callable[[str], bool]):
        self.source, self.known, self.at = source, known, 0
        self.inputs: list[str] = []
        self.windows: list[tuple[str, int]] = []

    def peek(self) -> tuple[str, str, int]:
        m = TOKEN.match(self.source, self.at)
        rest = self.source[self.at :]
        here = self.at + len(rest) - len(rest.lstrip())
        if not m:
            return ("end", "", here + 1) if not rest.strip() else ("bad", rest.strip()[0], here + 1)
        return m.lastgroup, m[m.lastgroup], m.start(m.lastgroup) + 1

    def take(self, *ops: str) -> str | None:
        kind, text, _ = self.peek()
        if kind == "op" and text in ops:
            self.at = TOKEN.match(self.source, self.at).end()
            return text
        return None

    def need(self, op: str) -> None:
        if self.take(op) is None:
            kind, text, at = self.peek()
            raise FormulaError(f"expected '{op}'" + (f", found '{text}'" if text else ""), at)

    def chain(self, part: Callable, *ops: str) -> tuple:
        left = part()
        while op := self.take(*ops):
            left = (op, left, part())
        return left

    def sum(self) -> tuple:
        return self.chain(self.product, "+", "-")

    def product(self) -> tuple:
        return self.chain(self.signed, "*", "/", "%")

    def signed(self) -> tuple:
        if op := self.take("-", "+"):
            return ("negative", self.signed()) if op == "-" else self.signed()
        base = self.single()
        return ("^", base, self.signed()) if self.take("^") else base

    def single(self) -> tuple:
        kind, text, at = self.peek()
        if kind == "op" and text == "(":
            self.take("(")
            inner = self.sum()
            self.need(")")
            return inner
        if kind == "end":
            raise FormulaError("the formula is not complete", at)
        if kind not in ("number", "name"):
            raise FormulaError(f"unexpected '{text}'", at)
        self.at = TOKEN.match(self.source, self.at).end()
        if kind == "number":
            return ("number", float(text))
        if not self.take("("):
            return self.key(text, at)
        name = text.lower()
        if name in ROLLING:
            kind, key, key_at = self.peek()
            if kind != "name":
                raise FormulaError(f"{name} needs a metric key", key_at)
            self.at = TOKEN.match(self.source, self.at).end()
            self.key(key, key_at)
            self.need(",")
            m = DURATION.match(self.source, self.at)
            size = int(m[1]) * UNIT_SECONDS[m[2]] if m else 0
            if not 60 <= size <= 86400:
                raise FormulaError("a window is 1m to 24h", self.at + 1)
            self.at = m.end()
            self.need(")")
            if (key, size) not in self.windows:
                self.windows.append((key, size))
            return ("rolling", name, key, size)
        if name not in FUNCTIONS:
            raise FormulaError(f"unknown function {text}", at)
        args = [self.sum()]
        while self.take(","):
            args.append(self.sum())
        self.need(")")
        least, most, _ = FUNCTIONS[name]
        if not least <= len(args) <= most:
            raise FormulaError(f"{name} takes {least} to {most} arguments", at)
        return ("call", name, *args)

    def key(self, key: str, at: int) -> tuple:
        if not self.known(key):
            raise FormulaError(f"unknown metric {key}", at)
        if key not in self.inputs:
            self.inputs.append(key)
        return ("metric", key)


def parse(source: str | None, known: Callable[[str], bool] = lambda key: True) -> Formula:
    if source is None or not source.strip():
        raise FormulaError("the formula is empty", 1)
    if len(source) > MAX_LENGTH:
        raise FormulaError(f"a formula has at most {MAX_LENGTH} characters", MAX_LENGTH)
    p = _Parser(source, known)
    tree = p.sum()
    kind, text, at = p.peek()
    if kind != "end":
        raise FormulaError(f"unexpected '{text}'", at)
    return Formula(source, tree, p.inputs, p.windows)


def _column(tree: tuple, metric: Callable, rolling: Callable | None) -> Column:
    kind = tree[0]
    if kind == "number":
        return F.lit(tree[1])
    if kind == "metric":
        return metric(tree[1])
    if kind == "rolling":
        return rolling(*tree[1:])
    if kind == "negative":
        return -_column(tree[1], metric, rolling)
    args = [_column(t, metric, rolling) for t in (tree[2:] if kind == "call" else tree[1:])]
    if kind == "call":
        return FUNCTIONS[tree[1]][2](*args)
    a, b = args
    return {"+": lambda: a + b, "-": lambda: a - b, "*": lambda: a * b, "/": lambda: F.try_divide(a, b), "%": lambda: F.try_mod(a, b), "^": lambda: F.pow(a, b)}[kind]()


#: Seconds of a part of a device's rows, if its windows are not longer.
PART = 24 * 3600
#: Sums are carried as whole millionths in two numbers of which the lower one has so many bits.
LOW_BITS = 31


def _shape(windows: list[tuple[str, int]]) -> str:
    return "".join(f", n_{i} bigint, high_{i} bigint, low_{i} bigint, min_{i} double, max_{i} double" for i in range(len(windows)))


def _range_extremes(values, low, high, combine):
    """combine (np.fmin or np.fmax) of values[low:high] for many ranges at once, each by the two powers of two that cover it; NaN where it is empty."""
    import numpy as np

    out = np.full(len(low), np.nan)
    level, table, size = 0, values, 1
    wide = np.maximum(high - low, 1)
    power = np.floor(np.log2(wide)).astype(np.int64)
    while True:
        at = np.flatnonzero((power == level) & (high > low))
        if len(at):
            out[at] = combine(table[low[at]], table[high[at] - size])
        if level >= power.max(initial=0):
            return out
        table = combine(table[:-size], table[size:])
        level, size = level + 1, size * 2


def windowed(wide: DataFrame, keys: list[str], windows: list[tuple[str, int]], most: int = MAX_POINTS) -> DataFrame:
    """wide (device_id, time, late, asks, v_key and u_key …) with count, sum, least and greatest of each window (key, seconds) before the row.

    A device's rows are cut into parts as long as the longest window (a day at least); each row goes to its own part and, to be looked back on, to the next one, so no
    task holds more than two parts of one device. Within a part a window is two binary searches: sums are differences of running sums of whole numbers, extremes come from a table of
    powers of two. Only the ``most`` latest points of a key count; late rows have no window; rows without asks are only looked back on.
    """
    import numpy as np
    import pandas as pd

    part = max([PART, *[size for _, size in windows]]) * 1_000_000
    own = [c for c in wide.columns if c not in ("asks", *[f"u_{k}" for k in keys])]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("us", kind="stable")
        asked = pdf[pdf["asks"]]
        at, on_time, out = asked["us"].to_numpy(), ~asked["late"].to_numpy(), {}
        for i, (key, size) in enumerate(windows):
            units = pdf[f"u_{key}"]
            points = pdf[units.notna().to_numpy() & ~pdf["late"].to_numpy()].drop_duplicates("us")  # of one instant's values the first
            us, value = points["us"].to_numpy(), points[f"v_{key}"].to_numpy(dtype=np.float64)
            u = np.array([int(x) for x in points[f"u_{key}"]], dtype=np.int64)
            running = [np.r_[0, np.cumsum(u >> LOW_BITS)], np.r_[0, np.cumsum(u & (1 << LOW_BITS) - 1)]]
            high = np.where(on_time, np.searchsorted(us, at, side="left"), 0)
            low = np.minimum(np.maximum(np.searchsorted(us, at - size * 1_000_000, side="left"), high - most), high)
            out |= {f"n_{i}": high - low, f"high_{i}": running[0][high] - running[0][low], f"low_{i}": running[1][high] - running[1][low]}
            out |= {f"min_{i}": _range_extremes(value, low, high, np.fmin), f"max_{i}": _range_extremes(value, low, high, np.fmax)}
        return pd.concat([asked[own].reset_index(drop=True), pd.DataFrame(out)], axis=1)

    rows = wide.withColumn("us", F.unix_micros("time")).withColumn("_part", F.floor(F.col("us") / part))
    rows = rows.withColumn("_to", F.explode(F.array("_part", F.col("_part") + 1))).withColumn("asks", F.col("asks") & (F.col("_to") == F.col("_part")))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wide.schema.fields if f.name in own)
    return rows.drop("_part").groupBy("device_id", "_to").applyInPandas(run, kinds + _shape(windows))


def evaluate(points: DataFrame, formulas: dict[str, str], most: int = MAX_POINTS, by: tuple[str, ...] = (), history: DataFrame | None = None, lists: DataFrame | None = None) -> DataFrame:
    """Derived points (device_id, time, metric_key, value) of points (device_id, metric_key, time, value, flags), one for each formula and
    instant (and values of the columns ``by``, such as a message's id) at which the device has all of its inputs and the result is finite.

    A rolling window of d seconds at t holds the key's points with t - d <= time < t, late ones left out and of the others the ``most``
    latest, and the value at hand; it speaks if it holds any. What is late has no window but the value at hand. history: points of the same kind that
    windows look back on too. lists: (device_id, names as map<string,int>): a device's formulas with an ordinal each, which the result then has; without it every formula applies to
    every device. Inputs are pivoted by a grouped maximum; windows take one more exchange (windowed()).
    """
    parsed = {name: parse(source) for name, source in formulas.items()}
    keys = sorted({k for f in parsed.values() for k in f.inputs})
    windows = sorted({w for f in parsed.values() for w in f.windows})

    def pivoted(rows: DataFrame, extra: tuple[str, ...]) -> DataFrame:
        late = F.bool_or(F.col("flags").bitwiseAND(1) != 0)
        value = {k: F.max(F.when(F.col("metric_key") == k, F.col("value"))).alias(f"v_{k}") for k in keys}
        out = rows.where(F.col("metric_key").isin(*keys)).groupBy("device_id", "time", *extra).agg(late.alias("late"), *value.values())
        return out

    wide = pivoted(points, by)
    if windows:
        wide = wide.withColumn("asks", F.lit(True))
        if history is not None:
            old = pivoted(history.select("device_id", "metric_key", "time", "value", "flags"), ()).withColumn("asks", F.lit(False))
            wide = wide.unionByName(old, allowMissingColumns=True)
        units = {f"u_{k}": (F.col(f"v_{k}").try_cast("decimal(18,6)") * 1_000_000).cast("bigint") for k in {k for k, _ in windows}}
        wide = windowed(wide.withColumns(units), list(dict.fromkeys(k for k, _ in windows)), windows, most)

    def rolling(name: str, key: str, size: int) -> Column:
        i, now = windows.index((key, size)), F.col(f"v_{key}")
        n = F.col(f"n_{i}") + now.isNotNull().cast("int")
        total = (F.col(f"high_{i}").cast("decimal(28,0)") * (1 << LOW_BITS) + F.col(f"low_{i}")) * F.lit("0.000001").cast("decimal(7,6)") + F.coalesce(now.try_cast("decimal(18,6)"), F.lit(0))
        # pandas' NaN is an empty window's extreme
        real = lambda c: F.when(~F.isnan(c), c)
        values = {
            "rolling_mean": total.cast("double") / n,
            "rolling_sum": total.cast("double"),
            "rolling_count": n.cast("double"),
            "rolling_min": F.least(real(F.col(f"min_{i}")), now),
            "rolling_max": F.greatest(real(F.col(f"max_{i}")), now),
        }
        return F.when(n > 0, values[name])

    if lists is not None:
        wide = wide.join(lists.select("device_id", "names"), "device_id")
    own = lambda name: F.lit(True) if lists is None else F.map_contains_key("names", name)
    columns = [F.when(own(name), f.column(lambda k: F.col(f"v_{k}"), rolling)).alias(f"f_{i}") for i, (name, f) in enumerate(parsed.items())]
    wide = wide.select("device_id", "time", *by, *([] if lists is None else ["names"]), *columns)
    results = F.array(*[F.struct(F.lit(name).alias("metric_key"), F.col(f"f_{i}").alias("value")) for i, name in enumerate(parsed)])
    ordinal = [] if lists is None else [F.try_element_at("names", F.col("metric_key")).alias("ordinal")]
    out = wide.select("*", F.inline(results)).where(F.col("value").isNotNull())
    return out.select("device_id", "time", *by, "metric_key", "value", *ordinal)


#: Fixed value: instants that a preview shows.
MAX_PREVIEW = 1_440


def preview(points: DataFrame, source: str, start: Column, end: Column, shown: int = MAX_PREVIEW, known: Callable[[str], bool] = lambda key: True) -> tuple[DataFrame, DataFrame]:
    """(series, inputs) of a formula that is not stored yet: (device_id, time, value) and (device_id, metric_key, time, value) from start to before end.

    Of each device the first ``shown`` instants at which it has any input count; inputs are all of the span. Late points count as others do, and windows look back before
    start, as points are read from there on. Nothing is written.
    """
    f = parse(source, known)
    size = max((w for _, w in f.windows), default=0)
    rows = points.where(F.col("metric_key").isin(*f.inputs) & (F.col("time") >= start - F.make_dt_interval(secs=F.lit(size))) & (F.col("time") < end))
    rows = rows.select("device_id", "metric_key", "time", "value", F.lit(0).alias("flags"))
    inside = rows.where(F.col("time") >= start)
    place = F.dense_rank().over(Window.partitionBy("device_id").orderBy("time"))
    first = inside.withColumn("_n", place).where(F.col("_n") <= shown).drop("_n")
    series = evaluate(first, {"preview": source}, most=1 << 30, history=rows.join(first.select("device_id", "time").distinct(), ["device_id", "time"], "left_anti"))
    return series.select("device_id", "time", "value"), inside.drop("flags")
