"""Runs: stretches of words that repeat with a period, found by Main-Lorentz divide and conquer over interned word ids.

A run is a stretch of consecutive words with smallest period q (words q apart are the same), at least max(``least``, ``folds`` * q) words long, which
neither neighbouring word extends. A part of a text is halved; the runs that cross the middle are read off Z-functions: with v the right half and u the left
one turned round, for every q the match of v with what begins q words before the middle, and of u with what ends q words before it (and the same to the
other side), add up to the stretch that keeps period q. What touches its part's edge and goes on beyond it crosses the middle of a larger part, which
reports it whole. Equal intervals are one run, of their smallest period. A part of n words takes n log n steps; only periods up to n / ``folds`` are looked at.

Before that, texts are cut where no run can be: within a run every three words in a row come back at least ``folds`` - 1 times (with period 1: the run's
length less two), so three words that a text has less often are in none. Counts are taken in a table of hashes, where a collision only makes them larger, so
the cut loses nothing; prose that never repeats is left out by it.

Each document is looked at by itself: there is no shuffle, memory holds some hundred texts, and a task that is repeated gives the same rows. Null and empty texts have
no words and no runs; rows without an id and rows that repeat one get a row each; an empty table gives no rows; texts may be of any length; columns but the id and the text are not
read, so their names may be any.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxgrain.llm.rows import map_rows
from fluxgrain.llm.words import mix, ngram_hashes, words

FOLDS, LEAST = 4, 6


def z_values(s: list[int], top: int) -> list[int]:
    """For each place below ``top`` the length of the longest common prefix of s and what begins there; at 0 the length of s."""
    n, left, right = len(s), 0, 0
    z = [n] * min(top, n)
    for i in range(1, len(z)):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def prefixes(pattern: list[int], z: list[int], text: list[int]) -> list[int]:
    """For each place of text the length of the longest common prefix of pattern and what begins there; z are the pattern's Z-values."""
    m, n, left, right = len(pattern), len(text), 0, 0
    out = [0] * n
    for i in range(n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                out[i] = k
                continue
            k = right - i
        while k < m and i + k < n and pattern[k] == text[i + k]:
            k += 1
        out[i] = k
        if i + k > right:
            left, right = i, i + k
    return out


def crossing(s: list[int], low: int, mid: int, high: int, folds: int, least: int, found: dict[tuple[int, int], int]) -> None:
    """Adds the runs of s[low:high] that cross mid to found: (start, end) -> smallest period."""
    v, u = s[mid:high], s[low:mid][::-1]
    most = (high - low) // folds
    zv, zu = z_values(v, most + 1), z_values(u, most + 1)
    before, behind = min(most, len(u)), min(most, len(v))
    ahead = prefixes(v, zv, s[mid - before : mid])  # at before - q: how far v agrees with the last q words before the middle
    back = prefixes(u, zu, v[:behind][::-1])  # at behind - q: the same backwards, with the first q words behind it
    for q in range(1, most + 1):
        right, left = zv[q] if q < len(zv) else 0, zu[q] if q < len(zu) else 0
        spans = []
        if q <= before:
            a = ahead[before - q]
            a += right if a == q else 0
            if a + left >= (folds - 1) * q:
                spans.append((mid - left - q, mid + a))
        if q <= behind:
            b = back[behind - q]
            b += left if b == q else 0
            if b + right >= (folds - 1) * q:
                spans.append((mid - b, mid + q + right))
        for start, end in spans:
            if end - start < least or (start == low > 0 and s[low - 1] == s[low - 1 + q]) or (end == high < len(s) and s[high] == s[high - q]):
                continue
            if found.get((start, end), q + 1) > q:
                found[start, end] = q


def main_lorentz(s: list[int], folds: int = FOLDS, least: int = LEAST) -> list[tuple[int, int, int]]:
    """The runs (start, length, period) of a sequence, by start, then period."""
    found: dict[tuple[int, int], int] = {}
    parts = [(0, len(s))]
    while parts:
        low, high = parts.pop()
        if high - low >= least:
            mid = (low + high) // 2
            crossing(s, low, mid, high, folds, least, found)
            parts += [(low, mid), (mid, high)]
    return sorted((a, b - a, q) for (a, b), q in found.items())


def repeating(ids: np.ndarray, doc: np.ndarray, folds: int, least: int) -> list[tuple[int, int]]:
    """(first, end) of the stretches of words, within one document each, that may hold runs; ids and doc are word ids and document numbers of all words of some texts."""
    if len(ids) < 3:
        return []
    h = ngram_hashes(mix(ids.astype(np.uint64) + (doc.astype(np.uint64) << np.uint64(40))), 3)
    bits = max(10, int(len(h)).bit_length() + 2)
    slot = (h >> np.uint64(64 - bits)).astype(np.int64)
    often = np.bincount(slot, minlength=1 << bits)[slot] >= min(folds - 1, max(least, folds) - 2)
    often &= doc[:-2] == doc[2:]
    edge = np.flatnonzero(np.diff(np.r_[False, often, False]))
    return [(int(a), int(b) + 2) for a, b in zip(edge[::2], edge[1::2]) if b + 2 - a >= max(least, folds)]


def runs_of(texts: list[list[bytes]], folds: int = FOLDS, least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """The runs of each of some texts, given as words."""
    known: dict[bytes, int] = {}
    size = np.array([len(ws) for ws in texts], dtype=np.int64)
    ids = np.fromiter((known.setdefault(w, len(known)) for ws in texts for w in ws), dtype=np.int64, count=int(size.sum()))
    doc, at = np.repeat(np.arange(len(texts)), size), np.r_[0, np.cumsum(size)]
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for first, end in repeating(ids, doc, folds, least):
        d = int(doc[first])
        out[d] += [(a + first - int(at[d]), n, q) for a, n, q in main_lorentz(ids[first:end].tolist(), folds, least)]
    return [sorted(x, key=lambda r: (r[0], r[2])) for x in out]


def collapse(ws: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return ws
    step = np.zeros(len(ws) + 1, dtype=np.int64)
    for start, length, period in runs:
        step[start + period] += 1
        step[start + length] -= 1
    return [w for w, k in zip(ws, np.cumsum(step[:-1]).tolist()) if k == 0]


RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def find(docs: DataFrame, folds: int = FOLDS, least: int = LEAST, change: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """doc_id, n_words, runs (by start, then period) and collapsed (the text without repeated periods, words joined by a space) of every row of docs (doc_id, text).

    change(doc_id, words): what the words become before they are looked at.
    """
    if folds < 2 or least < 3:
        raise ValueError("a run repeats at least twice and has at least three words")

    def run(ids: list, texts: list) -> dict:
        ws = [words(t) for t in texts]
        if change is not None:
            ws = [change(i, w) for i, w in zip(ids, ws)]
        found = runs_of(ws, folds, least)
        told = [[{"start": a, "length": n, "period": q} for a, n, q in r] for r in found]
        return {"doc_id": ids, "n_words": [len(w) for w in ws], "runs": told, "collapsed": [b" ".join(collapse(w, r)).decode("utf-8") for w, r in zip(ws, found)]}

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_rows(rows, run, f"doc_id bigint, n_words bigint, runs {RUNS}, collapsed string", most=256)


def looped(doc_id: int | None, ws: list[bytes]) -> list[bytes]:
    """The change that the query makes: of one document in ten the words from a place on become a cycle of the words there."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not ws:
        return ws
    g, n = h // 10, len(ws)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return ws[:a] + [ws[a + i % p] for i in range(n - a)]


def digest(found: DataFrame) -> DataFrame:
    """find()'s rows as counts, the longest run (ties: smallest start, then period) and hashes of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), F.concat(r["period"].cast("string"), F.lit("\n")))), "")
    return found.withColumn("_b", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("_b.s")).alias("start"),
        F.col("_b.length").alias("length"),
        (-F.col("_b.p")).alias("period"),
        F.expr("(1000 * _b.length) div -_b.p").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
