"""Toxicity by a factorization machine over hashed terms.

A text's terms are its words (lower case, punctuation at the ends off) and the 4- to 7-byte beginnings of longer words,
hashed to 2**bits indices, each counted once. The model is
``w0 + sum w[i] + (|sum V[i]|^2 - sum |V[i]|^2) / 2`` over a text's terms, so that pairs of terms (an insult with a mention
of a group) weigh more or less than both alone. It is fitted by AdaGrad on at most ``rows`` labelled texts (of each label up to
half of them, those with the smallest hash of their id): that sample's hashed terms are all that reaches the driver.
Terms take part if they are in three sampled texts or more and tell something about the label: by themselves (log odds
between the labels over three standard errors from 0), or together with another term, although they may say nothing alone: among the texts with the
other term, the label must depend on this one (likelihood ratio over ``PAIR``; terms in at least ``OFTEN`` of the sample; tested as Spark
tasks over chunks of terms). All others keep the weight 0, so that chance words do not speak.

Null texts and texts without terms get the score of no terms at all. Repeated rows are scored each for itself; rows without an id too. Without
labelled rows, or with one label only, the scores are that label's share (0 if there is none). An empty table gives no rows. Columns but the id
and the text are not read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fluxgrain.llm.rows import map_rows

#: Lengths, in bytes, of the beginnings of words that are terms too; and how many standard errors a term's log odds must be from 0.
PREFIXES = (4, 5, 6, 7)
SIGNIFICANT = 3.0
#: Likelihood ratio from which a term matters beside another, the share of sampled texts (and their number) that terms so tested are in, and terms a task.
PAIR, OFTEN, LEAST, CHUNK = 60.0, 0.02, 15, 256
EDGE = b".,;:!?\"'()[]{}*#$%&<>|-"


def terms(text: str | None, bits: int = 18) -> np.ndarray:
    """Sorted distinct indices of a text's terms."""
    if not text:
        return np.empty(0, dtype=np.int64)
    found = set()
    for w in set(text.lower().encode("utf-8", "replace").split()):
        if w := w.strip(EDGE):
            found.add(w)
            found.update(b"%d" % n + w[:n] for n in PREFIXES if len(w) > n)
    return np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, found), dtype=np.uint64, count=len(found)) >> np.uint64(64 - bits)).astype(np.int64)


def ratio(k: np.ndarray, n: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Twice the log likelihood ratio of k toxic ones of n texts against the rate p."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return 2 * (np.where(k > 0, k * np.log(k / (n * p)), 0) + np.where(n > k, (n - k) * np.log((n - k) / (n * (1 - p))), 0))


def often(texts: list[np.ndarray], size: int) -> np.ndarray:
    """The terms that are tested together with others."""
    n = np.bincount(np.concatenate([*texts, np.empty(0, dtype=np.int64)]), minlength=size)
    return np.flatnonzero(n >= max(LEAST, OFTEN * len(texts)))


def dense(texts: list[np.ndarray], columns: np.ndarray) -> np.ndarray:
    every = np.concatenate([*texts, np.empty(0, dtype=np.int64)])
    place = np.full(int(max(every.max(initial=0), columns.max(initial=0))) + 1, -1)
    place[columns] = np.arange(len(columns))
    row, column = np.repeat(np.arange(len(texts)), [len(t) for t in texts]), place[every]
    out = np.zeros((len(texts), len(columns)), dtype=np.float32)
    out[row[column >= 0], column[column >= 0]] = 1
    return out


def beside_others(texts: list[np.ndarray], labels: list[int], terms: np.ndarray, chunk: int) -> np.ndarray:
    """Those of the chunk-th CHUNK of terms on which the label depends among the texts with some other of the terms."""
    y = np.asarray(labels, dtype=bool)
    own = terms[chunk * CHUNK : (chunk + 1) * CHUNK]
    a, found = dense(texts, own), np.zeros(len(own), dtype=bool)
    for at in range(0, len(terms), 4 * CHUNK):
        b = dense(texts, terms[at : at + 4 * CHUNK])
        n, k, both, toxic = b.sum(0), b[y].sum(0), a.T @ b, a[y].T @ b[y]
        rate = np.clip(k / np.maximum(n, 1), 1e-9, 1 - 1e-9)[None, :]
        enough = (both >= LEAST) & (n - both >= LEAST)
        found |= (np.where(enough, ratio(toxic, both, rate) + ratio(k - toxic, n - both, rate), 0) >= PAIR).any(axis=1)
    return own[found]


class Machine:
    def __init__(self, bits: int = 18, factors: int = 8):
        rng = np.random.default_rng(7)
        self.bits, self.w0 = bits, 0.0
        self.w = np.zeros(1 << bits, dtype=np.float32)
        self.v = rng.normal(0, 0.02, (1 << bits, factors)).astype(np.float32)

    def raw(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the sigmoid, and the summed factors, of texts whose terms lie one after the other (none empty)."""
        v = self.v[ids]
        total = np.add.reduceat(v, starts, axis=0)
        return self.w0 + np.add.reduceat(self.w[ids], starts) + ((total**2).sum(1) - np.add.reduceat((v**2).sum(1), starts)) / 2, total

    def fit(self, texts: list[np.ndarray], labels: list[int], epochs: int = 6, rate: float = 0.1, decay: float = 1e-4, batch: int = 64, balance: float = 0.5, beside: np.ndarray | None = None) -> "Machine":
        """beside: the terms that matter beside others, if they are known already."""
        y = np.array(labels, dtype=np.float64)
        ones, zeros = (np.bincount(np.concatenate([*(t for t, x in zip(texts, labels) if x == k), np.empty(0, dtype=np.int64)]), minlength=1 << self.bits) for k in (1, 0))
        odds = np.log((ones + 0.5) / (y.sum() + 1)) - np.log((zeros + 0.5) / (len(y) - y.sum() + 1))
        chance = np.abs(odds) < SIGNIFICANT * np.sqrt(1 / (ones + 0.5) + 1 / (zeros + 0.5))
        if beside is None:
            tested = often(texts, 1 << self.bits)
            beside = np.concatenate([np.empty(0, dtype=np.int64), *(beside_others(texts, labels, tested, c) for c in range(-(-len(tested) // CHUNK)))])
        chance[beside] = False
        chance |= ones + zeros < 3
        self.v[chance] = 0
        texts = [t[~chance[t]] for t in texts]
        share = y.mean() if len(y) else 0.0
        self.w0 = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
        if share in (0.0, 1.0):
            self.v[:] = 0
            return self
        heavy = np.where(y == 1, ((1 - share) / share) ** balance, 1.0)  # errors on the rarer label weigh more
        self.w0 *= 1 - balance
        gw, gv, g0 = np.full(len(self.w), 1e-6), np.full(self.v.shape, 1e-6), 1e-6
        rng = np.random.default_rng(11)
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for at in range(0, len(order), batch):
                own = order[at : at + batch]
                bare = np.array([i for i in own if not len(texts[i])], dtype=np.int64)  # these teach the constant only
                own = np.array([i for i in own if len(texts[i])], dtype=np.int64)
                alone = (1 / (1 + np.exp(-np.clip(self.w0, -30, 30))) - y[bare]) * heavy[bare]
                if not len(own):
                    g0 += alone.mean() ** 2
                    self.w0 -= rate * alone.mean() / np.sqrt(g0)
                    continue
                ids, lens = np.concatenate([texts[i] for i in own]), np.array([len(texts[i]) for i in own])
                z, total = self.raw(ids, np.cumsum(lens) - lens)
                err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[own]) * heavy[own]
                each = np.repeat(err, lens)
                touched, back = np.unique(ids, return_inverse=True)
                dw = np.bincount(back, weights=each) / len(own) + decay * self.w[touched]
                pull = each[:, None] * (np.repeat(total, lens, axis=0) - self.v[ids])
                dv = np.stack([np.bincount(back, weights=pull[:, f]) for f in range(pull.shape[1])], axis=1) / len(own) + decay * self.v[touched]
                gw[touched] += dw**2
                gv[touched] += dv**2
                mean = (err.sum() + alone.sum()) / (len(own) + len(bare))
                g0 += mean**2
                self.w[touched] -= rate * dw / np.sqrt(gw[touched])
                self.v[touched] -= rate / 2 * dv / np.sqrt(gv[touched])
                self.w0 -= rate * mean / np.sqrt(g0)
        return self

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        z = np.full(len(texts), self.w0)
        full = [i for i, t in enumerate(texts) if len(t)]
        for at in range(0, len(full), 256):
            own = full[at : at + 256]
            lens = np.array([len(texts[i]) for i in own])
            z[own] = self.raw(np.concatenate([texts[i] for i in own]), np.cumsum(lens) - lens)[0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, rows: int = 12_000, bits: int = 18) -> Machine:
    """The machine fitted on docs (doc_id, text) with labels (doc_id, toxic 0/1); null labels teach nothing, of several labels of a document the largest counts."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    rate = F.when(F.col("toxic") == 1, min(1.0, 0.6 * rows / max(1, counts.get(1, 0)))).otherwise(min(1.0, 0.6 * rows / max(1, counts.get(0, 0))))
    some = known.where(drawn < rate * (1 << 30)).withColumn("d", drawn)
    some = some.withColumn("n", F.row_number().over(Window.partitionBy("toxic").orderBy("d", "doc_id"))).where(F.col("n") <= rows // 2)

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "toxic": b["toxic"], "ids": [terms(t, bits).astype("<i4").tobytes() for t in b["text"]]})

    found = docs.select("doc_id", "text").join(F.broadcast(some.select("doc_id", "toxic")), "doc_id").mapInPandas(hashed, "doc_id bigint, toxic int, ids binary")
    got = sorted((r["doc_id"], r["toxic"], bytes(r["ids"])) for r in found.collect())
    texts, toxic = [np.frombuffer(x[2], dtype="<i4").astype(np.int64) for x in got], [x[1] for x in got]
    tested = often(texts, 1 << bits)
    spark = docs.sparkSession
    sample = spark.sparkContext.broadcast((got, tested))

    def tests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, which = sample.value
        ids, y = [np.frombuffer(x[2], dtype="<i4").astype(np.int64) for x in own], [x[1] for x in own]
        for b in batches:
            for chunk in b["id"]:
                yield pd.DataFrame({"term": beside_others(ids, y, which, int(chunk))})

    chunks = -(-len(tested) // CHUNK)
    found = spark.range(0, chunks, 1, max(1, chunks)).mapInPandas(tests, "term bigint").collect() if len(set(toxic)) > 1 else []
    return Machine(bits).fit(texts, toxic, beside=np.array(sorted(r["term"] for r in found), dtype=np.int64))


def score(docs: DataFrame, model: Machine) -> DataFrame:
    """doc_id and score (0 to 1) of every row of docs; the model (fixed size, 2**bits weights and factors) is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast((model.bits, model.w0, model.w, model.v))

    def run(batches: Iterator[tuple[list, list]]) -> Iterator[dict]:
        own = Machine.__new__(Machine)
        own.bits, own.w0, own.w, own.v = shared.value
        for ids, texts in batches:
            yield {"doc_id": ids, "score": np.concatenate([np.empty(0), *(own.score([terms(t, own.bits) for t in texts[at : at + 256]]) for at in range(0, len(texts), 256))])}

    return map_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), run, "doc_id bigint, score double", streamed=True)
