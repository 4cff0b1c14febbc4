"""Exact top-k search by inner product with block-at-a-time pruning.

Vectors are integers: floor(256 * x) of each component. Rows in order of their id are cut into document-range blocks, and neighbouring
blocks lie together in one row, a range of a few MB. A block's forward index is its ids and its integer matrix; of each block and each range the largest and smallest
value of every term (a component) are known. A query's bound on either is the sum over its terms of the term's value times the larger or, for negative
values, the smaller of both: no vector in it scores higher.

Each query starts in the range with its best bound (wave one), which gives a k-th score to beat, and goes on to those other ranges only whose bound
is not below that (wave two). Within a range it takes the blocks by falling bound and stops as soon as a bound falls below its k-th score so far. What is left cannot enter the
result, not even by a tie, which the smaller id wins. Bounds of ranges are computed twice instead of being stored. Queries travel in chunks, and only those rows of a chunk that
want a range meet it: a task holds one range and one chunk at a time, both limited in bytes, however many rows share an id.

Products of integers below 2**53 are taken in floating point, where they are exact; larger ones in 64-bit integers up to 2**63, and beyond
in Python's, block by block. A score that 64 bits cannot hold becomes the largest or smallest number that they can.

Rows without an id, and vectors null or with null or non-finite components, take no part; vectors of each length are
searched among themselves (an inner product between lengths is undefined). Rows that repeat an id are candidates each for itself, but
never for a query of the same id; each row that is a query gets an answer of its own. An
empty table gives no rows. Columns but the id and the vector are not read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluxgrain.llm.lineage import kept, stored


def integers(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("bigint"))


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v array<bigint>) of the rows that take part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    some = rows.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("e"))
    return some.where(F.col("vec_id").isNotNull() & F.col("e").isNotNull() & F.forall("e", finite)).select("vec_id", integers(F.col("e")).alias("v"))


LOWEST = np.iinfo(np.int64).min
RANGE = "range bigint, ids binary, matrix binary, highs binary, lows binary, high binary, low binary"
PACK = "ranges binary, high binary, low binary"
WANTED = "range bigint, q_block bigint, at binary, q_ids binary, q binary, kth binary"
FOUND = "query_id bigint, query_row bigint, vec_id bigint, score bigint"


def names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def ints(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype="<i8")


def matrix(data: bytes, n: int) -> np.ndarray:
    return ints(data).reshape(n, -1)


def ranges(rows: DataFrame, size: int, per: int) -> DataFrame:
    """Rows of neighbouring ids, ``per`` blocks of ``size`` rows at most in one, with the maxima and minima of each block and of all."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made, left = TaskContext.get().partitionId() << 32, None
        for b in batches:
            left = b if left is None else pd.concat([left, b], ignore_index=True)
            while len(left) >= size * per:
                yield one(made, left.iloc[: size * per])
                made, left = made + 1, left.iloc[size * per :]
        if left is not None and len(left):
            yield one(made, left)

    def one(number: int, part: pd.DataFrame) -> pd.DataFrame:
        m = np.stack(part["v"].to_list()).astype("<i8") if len(part["v"].iloc[0]) else np.zeros((len(part), 0), dtype="<i8")
        starts = np.arange(0, len(m), size)
        highs, lows = np.maximum.reduceat(m, starts, axis=0), np.minimum.reduceat(m, starts, axis=0)
        return pd.DataFrame([(number, part["vec_id"].to_numpy("<i8").tobytes(), *(x.tobytes() for x in (m, highs, lows, highs.max(0), lows.min(0))))], columns=names(RANGE))

    order = rows.withColumn("_h", F.xxhash64("v"))
    return order.repartitionByRange("vec_id", "_h").sortWithinPartitions("vec_id", "_h").select("vec_id", "v").mapInPandas(run, RANGE)


def packed(batches: Iterator[pd.DataFrame], most: int) -> Iterator[pd.DataFrame]:
    """Numbers, maxima and minima of ranges, up to ``most`` ranges in a row."""
    for b in batches:
        for at in range(0, len(b), most):
            own = b.iloc[at : at + most]
            yield pd.DataFrame([(own["range"].to_numpy("<i8").tobytes(), b"".join(own["high"]), b"".join(own["low"]))], columns=names(PACK))


def exact(*parts: np.ndarray) -> list[np.ndarray]:
    """The first matrix and those it is multiplied with, as numbers in which the products are exact: doubles, 64-bit integers or, where they may be larger, Python's."""
    top = lambda x: max(int(x.max(initial=0)), -int(x.min(initial=0)))
    most = top(parts[0]) * max(map(top, parts[1:])) * parts[0].shape[-1]
    return [x.astype(np.float64 if most < 1 << 53 else np.int64 if most < 1 << 63 else object) for x in parts]


def within(products: np.ndarray) -> np.ndarray:
    """Products of Python's integers as 64-bit ones: what is beyond them becomes the largest or smallest score (LOWEST + 1)."""
    if products.dtype != object:
        return products
    return np.clip(products, LOWEST + 1, np.iinfo(np.int64).max).astype(np.int64)


def bounds(q: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """No vector between low and high (a row each) scores higher for the queries (rows of q); exact numbers go in, integers come out."""
    return within(np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T).astype(np.int64)


class Best:
    """The k best candidates of each query so far, by falling score and rising id, and the score that a further one must reach."""

    def __init__(self, own: np.ndarray, kth: np.ndarray, k: int):
        self.own, self.kth, self.k = own, kth.copy(), k
        self.scores, self.ids = np.full((len(own), k), LOWEST), np.full((len(own), k), np.iinfo(np.int64).max)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """scores of the candidates ids (ascending) for the queries at rows."""
        first, last = np.searchsorted(ids, self.own[rows]), np.searchsorted(ids, self.own[rows], "right")
        for i in np.flatnonzero(last > first):
            scores[i, first[i] : last[i]] = LOWEST
        limit = self.kth[rows]
        new = np.flatnonzero(limit == LOWEST)
        if len(new) and len(ids) > self.k:
            limit[new] = np.partition(scores[new], -self.k, axis=1)[:, -self.k].astype(np.int64)
        r, c = np.nonzero((scores >= limit[:, None]) & (scores > LOWEST))
        if not len(r):
            return
        met = np.unique(r)
        who = np.concatenate([r, np.repeat(met, self.k)])
        score = np.concatenate([scores[r, c].astype(np.int64), self.scores[rows[met]].ravel()])
        cand = np.concatenate([ids[c], self.ids[rows[met]].ravel()])
        order = np.lexsort((cand, ~score, who))
        start = np.searchsorted(who[order], met)
        take = order[(start[:, None] + np.arange(self.k)).ravel()]
        self.scores[rows[met]], self.ids[rows[met]] = score[take].reshape(-1, self.k), cand[take].reshape(-1, self.k)
        self.kth[rows[met]] = np.maximum(self.kth[rows[met]], self.scores[rows[met], self.k - 1])


def searched(r, size: int, k: int, slice_rows: int = 512) -> tuple[np.ndarray, Best]:
    """The rows of a chunk against one range, by blocks of falling bounds; r has the columns of WANTED and RANGE. Also the number of rows scored with each block."""
    own, ids = ints(r.q_ids), ints(r.ids)
    n = -(-len(ids) // size)
    q, m, highs, lows = exact(matrix(r.q, len(own)), matrix(r.matrix, len(ids)), matrix(r.highs, n), matrix(r.lows, n))
    best, every, scored = Best(own, ints(r.kth), k), np.arange(len(own)), np.zeros(n, dtype=np.int64)
    bound = bounds(q, highs, lows)
    order = np.argsort(~bound, axis=1, kind="stable")
    for step in range(n):
        block = order[:, step]
        alive = bound[every, block] >= best.kth
        if not alive.any():
            break
        for b in np.unique(block[alive]):
            rows = np.flatnonzero(alive & (block == b))
            scored[b] += len(rows)
            for at in range(0, len(rows), slice_rows):
                part = rows[at : at + slice_rows]
                best.add(part, within(q[part] @ m[b * size : (b + 1) * size].T), ids[b * size : (b + 1) * size])
    return scored, best


def top_k(rows: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", size: int = 1024, chunk: int = 1024, range_bytes: int = 4 << 20) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of each query; is_query is a condition on the column ``vec_id``. Vectors of each length are searched among themselves.

    size, chunk: vectors of a block and of a chunk of queries, at most; range_bytes: of a range of blocks and of a chunk.
    """
    good = usable(rows, id_col, vector_col)
    lengths = sorted(r[0] for r in good.select(F.size("v")).distinct().collect()) or [0]
    return reduce(DataFrame.unionByName, [top_k_alike(good.where(F.size("v") == n), is_query, n, k, size, chunk, range_bytes) for n in lengths])


def top_k_alike(good: DataFrame, is_query: Column, length: int, k: int, size: int, chunk: int, range_bytes: int) -> DataFrame:
    """top_k for usable vectors of one length."""
    fit = max(1, range_bytes // (8 * max(1, length)))
    size, chunk = min(size, fit), min(chunk, fit, 4096)
    forward = stored(ranges(good, size, max(1, fit // size)))
    queries = stored(ranges(good.where(is_query), chunk, 1).select(F.col("range").alias("q_block"), F.col("ids").alias("q_ids"), F.col("matrix").alias("q")))
    # maxima of many ranges in one row; every chunk of queries meets all of them, in lanes of a few chunks
    most = max(1, fit // 8)
    tops = forward.select("range", "high", "low")
    tops = tops.repartition(-(-max(1, tops.count()) // most), "range").mapInPandas(lambda batches: packed(batches, most), PACK)
    lanes = -(-max(1, queries.select("q_block").count()) // 4)
    lane = F.pmod(F.xxhash64("q_block"), F.lit(lanes)).alias("lane")
    tops = kept(tops).withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))).withColumn("lane", F.col("lane").cast("bigint"))

    def range_bounds(r) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        number, q = ints(r.ranges), matrix(r.q, len(r.q_ids) // 8)
        return number, q, bounds(*exact(q, matrix(r.high, len(number)), matrix(r.low, len(number))))

    def leaders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """For each query of a chunk the best bound and its range, over the rows of one partition or group."""
        top: dict[int, tuple] = {}
        for b in batches:
            for r in b.itertuples(index=False):
                if hasattr(r, "lead"):
                    new, which = ints(r.bound), ints(r.lead)
                else:
                    number, q, bound = range_bounds(r)
                    at = bound.argmax(axis=1)
                    new, which = bound[np.arange(len(q)), at], number[at]
                was, were = top.get(r.q_block, (new, which))
                win = (new > was) | ((new == was) & (which < were))
                top[r.q_block] = np.where(win, new, was), np.where(win, which, were)
        yield pd.DataFrame([(q, v.astype("<i8").tobytes(), i.astype("<i8").tobytes()) for q, (v, i) in top.items()], columns=["q_block", "bound", "lead"])

    lead = "q_block bigint, bound binary, lead binary"
    ahead = tops.join(queries.select("*", lane), "lane").mapInPandas(leaders, lead)
    leads = kept(ahead.groupBy("q_block").applyInPandas(lambda part: next(leaders(iter([part]))), lead).drop("bound"))

    def rows_for(number: int, r, at: np.ndarray, q: np.ndarray, kth: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame([(number, r.q_block, at.astype("<i8").tobytes(), ints(r.q_ids)[at].tobytes(), q[at].tobytes(), kth[at].tobytes())], columns=names(WANTED))

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples(index=False):
                which, q = ints(r.lead), matrix(r.q, len(r.q_ids) // 8)
                for number in np.unique(which):
                    yield rows_for(number, r, np.flatnonzero(which == number), q, np.full(len(q), LOWEST))

    def others(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples(index=False):
                number, q, bound = range_bounds(r)
                kth = np.full(len(q), LOWEST)
                for s in r.kths if r.kths is not None else []:
                    kth[s["at"]] = s["kth"]
                want = (bound >= kth[:, None]) & (ints(r.lead)[:, None] != number[None, :])
                for j in np.flatnonzero(want.any(axis=0)):
                    yield rows_for(number[j], r, np.flatnonzero(want[:, j]), q, kth)

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples(index=False):
                best = searched(r, size, k)[1]
                i, j = np.nonzero((best.scores > LOWEST) & (best.scores >= ints(r.kth)[:, None]))
                yield pd.DataFrame(dict(zip(names(FOUND), (best.own[i], (r.q_block << 12) + ints(r.at)[i], best.ids[i, j], best.scores[i, j]))))

    def of_ranges(wanted: DataFrame) -> DataFrame:
        return wanted.join(forward.drop("high", "low"), "range").mapInPandas(scored, FOUND)

    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    asked = queries.join(leads, "q_block")
    found = kept(of_ranges(asked.mapInPandas(first, WANTED)))  # one range each: at most k rows a query
    kth = found.groupBy("query_row").agg(F.min("score").alias("kth"), F.count("*").alias("n")).where(F.col("n") >= k)
    kth = kth.groupBy(F.shiftright("query_row", 12).alias("q_block")).agg(F.collect_list(F.struct(F.col("query_row").bitwiseAND(4095).alias("at"), "kth")).alias("kths"))
    wanted = tops.join(asked.join(kth, "q_block", "left").select("*", lane), "lane").mapInPandas(others, WANTED)
    both = found.unionByName(of_ranges(wanted)).withColumn("rank", F.row_number().over(order))
    return both.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
