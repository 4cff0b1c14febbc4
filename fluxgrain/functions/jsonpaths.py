"""The path language of decoder mappings: ``$``, ``.key``, ``['key']``, ``[0]`` and ``[*]``; no ``..`` and no filters."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

STEP = re.compile(r"""\.(?P<key>[^.\[\]'"*\s]+)|\[(?P<index>\d+)\]|\[(?P<star>\*)\]|\['(?P<single>[^']+)'\]|\["(?P<double>[^"]+)"\]""")


def steps(path: str) -> list[str | int | None]:
    """The steps of a path (None: every element); ValueError if it is not one."""
    if not path or path[0] != "$":
        raise ValueError(f"a path begins with $: {path}")
    at, out = 1, []
    while at < len(path):
        m = STEP.match(path, at)
        if not m:
            raise ValueError(f"bad path at {at + 1}: {path}")
        out.append(int(m["index"]) if m["index"] else None if m["star"] else m["key"] or m["single"] or m["double"])
        at = m.end()
    return out


def spark_path(path: str) -> str:
    """The path as get_json_object reads it."""
    return "$" + "".join(f"[{s}]" if isinstance(s, int) else "[*]" if s is None else f"['{s}']" for s in steps(path))


def first(json: Column, path: str) -> Column:
    """The value at a path as text (of several the first); null where there is none or it is null."""
    parts = steps(path)
    if None not in parts:
        return F.get_json_object(json, spark_path(path))
    at = parts.index(None)
    head = "$" + "".join(f"[{s}]" if isinstance(s, int) else f"['{s}']" for s in parts[:at])
    tail = "$" + "".join(f"[{s}]" if isinstance(s, int) else "[*]" if s is None else f"['{s}']" for s in parts[at + 1 :])
    items = elements(F.get_json_object(json, head))
    found = F.filter(F.transform(items, lambda x: F.get_json_object(x, tail) if tail != "$" else x), lambda x: x.isNotNull())
    return F.get(found, F.lit(0))


def first_of(v: Column, path: str) -> Column:
    """The JSON value (variant) at a path of a variant, of several the first that there is; null where there is none."""
    parts = steps(path)
    said = lambda p: "$" + "".join(f"[{s}]" if isinstance(s, int) else f"['{s}']" for s in p)
    if None not in parts:
        return F.try_variant_get(v, said(parts), "variant")
    at = parts.index(None)
    items = F.coalesce(F.try_variant_get(v, said(parts[:at]), "array<variant>"), F.array().cast("array<variant>"))
    rest = "$" + path_text(parts[at + 1 :])
    return F.get(F.filter(F.transform(items, lambda x: first_of(x, rest)), lambda x: x.isNotNull()), F.lit(0))


def path_text(parts: list[str | int | None]) -> str:
    return "".join(f"[{s}]" if isinstance(s, int) else "[*]" if s is None else f"['{s}']" for s in parts)


def elements(json: Column) -> Column:
    """The elements of a JSON array, each as JSON text (strings lose their quotes); no array: none."""
    return F.coalesce(F.from_json(json, "array<string>"), F.array().cast("array<string>"))
