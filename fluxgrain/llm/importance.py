"""Importance resampling towards a target: documents are drawn by how much likelier their hashed word runs are in the target's texts.

Features are all runs of one to ``n`` words. Texts are taken in blocks of about ``block`` words. In a block the distinct words get integer ids; a run of words
is the tuple of the id of the run without its last word and the last word's id, so that runs of any length are pairs of integers, and equal ones are found by
sorting numbers. Only of each distinct tuple the bytes are put together and hashed, once, and the buckets are joined back to the places of the
block. A dictionary of the whole corpus would have to be shuffled to every word of it, which costs more than hashing a tuple once in each
block; the result does not depend on the blocks.

Each document's buckets are written once, two bytes a feature, and read twice: for the counts, which every task adds up before a shuffle of at most ``buckets`` rows
each, and for the weights, with a table of ``buckets`` gains (its size is a parameter and does not grow with the input). Ranks come from a histogram of scores: the number
of documents with a higher score is a running sum over distinct scores (integers in a range of some ten thousand, summed within and over groups of 64), and within
a score documents are numbered by id. Because of the added noise no score holds more than about 0.04 per cent of the documents, even if all texts are the same.

Null and empty texts have no features and weight 0. Rows without an id count in the corpus's features but are not drawn and have neither score nor rank; rows that
repeat an id are ranked each for itself. An empty table gives no rows. Texts may be of any length: one longer than a block is a block of its own.
Columns but the id and the text are not read, so their names may be any.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluxgrain.llm.lineage import stored
from fluxgrain.llm.rows import map_rows

BUCKETS, GRAMS, BLOCK = 10_000, 2, 1 << 20
#: Bytes of words ([0-9a-z] and all beyond ASCII), with A-Z in lower case; all others part words.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def plain_words(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode("utf-8", "replace").translate(LOWER).split()


def block_buckets(texts: list[list[bytes]], n: int = GRAMS, buckets: int = BUCKETS) -> list[np.ndarray]:
    """The bucket of every feature of each text: those of its words, then of its pairs and so on, in order."""
    size = np.array([len(ws) for ws in texts], dtype=np.int64)
    coded = pa.array([w for ws in texts for w in ws], type=pa.binary()).dictionary_encode()
    ids, known = coded.indices.to_numpy().astype(np.int64), np.array([*coded.dictionary.to_pylist(), None], dtype=object)[:-1]
    doc = np.repeat(np.arange(len(texts)), size)
    at = np.arange(len(ids))  # where each run begins; runs of k words: the id of its first k - 1, and of its last
    run, said = ids, known
    parts = []
    for k in range(1, n + 1):
        if k > 1:
            whole = np.flatnonzero(at + k - 1 < len(ids))
            whole = whole[doc[at[whole]] == doc[at[whole] + k - 1]]
            at = at[whole]
            pairs, run = np.unique(run[whole] * max(1, len(known)) + ids[at + k - 1], return_inverse=True)
            first, last = said[pairs // max(1, len(known))], known[pairs % max(1, len(known))]
            said = np.array([*(a + b" " + b for a, b in zip(first, last)), None], dtype=object)[:-1]
        hashed = np.fromiter(map(crc32, said), dtype=np.int64, count=len(said)) % buckets
        parts.append((doc[at], hashed[run]))
    own = np.concatenate([d for d, _ in parts])
    order = np.argsort(own, kind="stable")
    found = np.concatenate([b for _, b in parts])[order].astype("<u2" if buckets <= 1 << 16 else "<u4")
    return np.split(found, np.cumsum(np.bincount(own, minlength=len(texts)))[:-1]) if texts else []


def encode(docs: DataFrame, n: int = GRAMS, buckets: int = BUCKETS, block: int = BLOCK) -> DataFrame:
    """doc_id, n_words and the buckets of all features (packed, two bytes each, four beyond 65,536 buckets) of every row of docs (doc_id, text)."""

    def run(lists: Iterator[tuple[list, list]]) -> Iterator[dict]:
        ids, texts, held = [], [], 0
        done = lambda: {"doc_id": ids, "n_words": [len(t) for t in texts], "features": [b.tobytes() for b in block_buckets(texts, n, buckets)]}
        for some, said in lists:
            for i, t in zip(some, said):
                ws = plain_words(t)
                if held and held + len(ws) > block:
                    yield done()
                    ids, texts, held = [], [], 0
                ids.append(i)
                texts.append(ws)
                held += len(ws)
        yield done()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_rows(rows, run, "doc_id bigint, n_words bigint, features binary", streamed=True)


def unpacked(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """All buckets of a column of packed ones, and where each row's begin (with the end)."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")
    ends = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, dtype=np.int64)
    data = column.buffers()[2]
    all_ = np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]].view(kind) if data is not None and ends[-1] > ends[0] else np.empty(0, dtype=kind)
    return all_, (ends - ends[0]) // kind.itemsize


def bucket_counts(coded: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: features of all rows of encode()'s table by bucket; added up in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            total += np.bincount(unpacked(b.column(0).cast(pa.binary()), buckets)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, type=pa.int64()), pa.array(total[at], type=pa.int64())], names=["bucket", "n"])

    return coded.select("features").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, gain: floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) of every bucket, from bucket_counts() of both."""
    both = corpus.select("bucket", F.col("n").alias("s"), F.lit(0).cast("bigint").alias("t")).unionByName(target.select("bucket", F.lit(0).cast("bigint").alias("s"), F.col("n").alias("t")))
    every = corpus.sparkSession.range(buckets).select(F.col("id").alias("bucket"), F.lit(0).cast("bigint").alias("s"), F.lit(0).cast("bigint").alias("t"))
    each = both.unionByName(every).groupBy("bucket").agg(F.sum("s").cast("double").alias("s"), F.sum("t").cast("double").alias("t"))
    total = each.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    ratio = (F.col("t") + 1) * (F.col("all_s") + buckets) / ((F.col("s") + 1) * (F.col("all_t") + buckets))
    return each.join(F.broadcast(total)).select("bucket", F.floor(1000 * F.log(ratio)).cast("bigint").alias("gain"))


def weights(coded: DataFrame, gain: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_words, n_features, weight: the floored mean of a row's features' gains (none: 0). gain has a row per bucket, a number fixed by parameter."""
    table = np.zeros(buckets, dtype=np.int64)
    for r in gain.collect():
        table[r["bucket"]] = r["gain"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, ends = unpacked(b.column(2).cast(pa.binary()), buckets)
            sums, n = np.r_[0, np.cumsum(table[found])][ends], np.diff(ends)
            mean = np.diff(sums) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, type=pa.int64()), pa.array(mean, type=pa.int64())], names=["doc_id", "n_words", "n_features", "weight"])

    return coded.select("doc_id", "n_words", "features").mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise of a document in thousandths, from a hash of its id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def ranked(scored: DataFrame, share: int, least_words: int) -> DataFrame:
    """scored (doc_id, n_words, score, …; read several times) with rank: 1, 2, 3 … of the floor(share per cent) best of the rows with an id and at least so many words, else null."""
    may = F.col("doc_id").isNotNull() & (F.col("n_words") >= least_words)
    some = scored.where(may)
    drawn = some.count() * share // 100
    counts = some.groupBy("score").agg(F.count("*").alias("n")).withColumn("g", F.floor(F.col("score") / 64))
    above = Window.orderBy(F.desc("g")).rowsBetween(Window.unboundedPreceding, -1)  # over groups of 64 scores: some hundred rows
    groups = counts.groupBy("g").agg(F.sum("n").alias("n")).select("g", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("_far"))
    higher = Window.partitionBy("g").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("_near", F.coalesce(F.sum("n").over(higher), F.lit(0))).join(groups, "g").select("score", (F.col("_near") + F.col("_far")).alias("_before"))
    place = F.col("_before") + F.row_number().over(Window.partitionBy("score").orderBy("doc_id"))
    best = some.join(before, "score").withColumn("rank", F.when(place <= drawn, place).cast("bigint")).select(*scored.columns, "rank")
    rest = scored.where(~may).withColumn("rank", F.lit(None).cast("bigint"))
    return best.unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, share: int = 25, least_words: int = 20, seed: int = 7, n: int = GRAMS, buckets: int = BUCKETS, block: int = BLOCK) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every row of docs (doc_id, text); drawn are those with a rank. target: rows with a text."""
    coded = stored(encode(docs, n, buckets, block))
    wanted = encode(target.select(F.lit(0).alias("doc_id"), "text"), n, buckets, block)
    gain = gains(bucket_counts(coded, buckets), bucket_counts(wanted, buckets), buckets)
    found = weights(coded, gain, buckets).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    return ranked(stored(found), share, least_words)
