"""Mixing of sources to target weights by temperature.

A source's share of all tokens (words) is raised to an exponent and normalised: at 1 sources keep their shares, at 0 all
weigh the same. The exponent is bisected to the least one at which the weights' entropy is at most ``entropy`` times that of equal weights
and no source is read more than ``repeats`` times. The budget is as large as it must be for every source to be read once in full, so nothing is
dropped; a source's budget over its tokens is how often it is read.

The budget is realised in blocks: a source's documents fall by a hash of their id into blocks of about ``block`` documents.
Each block is read in whole passes, each in a permutation of its own, and once more up to the remaining share of its
tokens; the document at the edge is taken with the probability of its part that fits, drawn from its hash. The passes of all blocks and sources are dealt among
each other by a hash, so that neighbouring passes are of different sources. No step gathers a source: shares are grouped sums, the
table of sources is counted and then broadcast (or, if large, sources are salted), and ordering is within a block.

Only built-in functions run. Null texts and texts without words have no tokens and are read once, as are sources without tokens; null
sources are one source. Rows that repeat an id, and rows without one, are documents each for itself. An empty table gives no rows. Columns of any name pass through mix().
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fluxgrain.llm.joins import with_groups
from fluxgrain.llm.lineage import kept

WORD = "[^ \t\n\x0b\f\r]+"
ENTROPY, REPEATS, BLOCK, SEED = 0.97, 2.0, 512, 17


def exponent(shares: DataFrame, entropy: float, repeats: float, turns: int = 10, cuts: int = 8) -> float:
    """The least exponent in 0..1 that keeps both limits (1 if only that, or not even that, does); shares has p > 0 of each source.

    Each turn halves the interval three times at once: the limits are tested at eight points by one grouped sum over the sources.
    """
    top = shares.agg(F.max("p"), F.count("*")).first()
    if not top[1] or top[1] == 1:
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(turns):
        points = [low + (high - low) * i / cuts for i in range(cuts + 1)]
        each = shares.select("p", F.explode(F.array(*map(F.lit, points))).alias("x")).withColumn("q", F.pow("p", "x"))
        # the entropy of q / sum(q), and how often the rarest source is read when the largest is read once
        sums = each.groupBy("x").agg((F.log(F.sum("q")) - F.sum(F.col("q") * F.log("q")) / F.sum("q")).alias("h"), F.max(F.pow(top[0] / F.col("p"), 1 - F.col("x"))).alias("r"))
        fine = {r["x"]: r["h"] <= entropy * math.log(top[1]) + 1e-12 and r["r"] <= repeats + 1e-12 for r in sums.collect()}
        first = next((i for i, x in enumerate(points) if fine[x]), None)
        if first is None:
            return 1.0
        if first == 0:
            return points[0]
        low, high = points[first - 1], points[first]
    return high


def planned(docs: DataFrame, entropy: float, repeats: float, block: int, seed: int, whole_rows: bool) -> DataFrame:
    """One row per reading of a document in the order of its block's permutations; whole_rows adds ``row``, the document's own columns."""
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if whole_rows else []
    alone = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).alias("_alone")  # rows without an id are dealt out by a running number
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), alone, "source", key.alias("g"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("n_tokens"), *row)
    rows = rows if whole_rows else kept(rows)
    sizes = kept(rows.groupBy("g").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n")))
    total = sizes.agg(F.sum("t")).first()[0] or 0
    shares = kept(sizes.where("t > 0").select("g", (F.col("t") / F.lit(float(max(total, 1)))).alias("p")))
    x = exponent(shares, entropy, repeats)
    norm = shares.agg(F.sum(F.pow("p", F.lit(x))), F.max("p")).first()
    reads = F.pow(F.lit(norm[1] or 1.0) / F.col("p"), F.lit(1 - x))
    mixed = sizes.join(shares, "g", "left").select(
        "g",
        F.greatest(F.lit(1), F.ceil(F.col("n") / block)).alias("blocks"),
        F.coalesce(F.pow("p", F.lit(x)) / F.lit(norm[0] or 1.0), F.lit(0.0)).alias("weight"),
        F.coalesce(reads, F.lit(1.0)).alias("reads"),
    )
    drawn = lambda *c: F.pmod(F.xxhash64(F.lit(seed), *c), F.lit(1 << 40))
    dealt = with_groups(rows, kept(mixed), ["g"]).withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text_hash", "_alone"), "blocks"))
    whole = F.floor(F.col("reads") + 1e-9)
    every = dealt.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(whole < F.col("reads") - 1e-9, whole + 1).otherwise(whole).cast("int")))).withColumn("order", drawn("copy", "doc_id", "text_hash", "_alone"))
    every = every.withColumn("deal", drawn("g", "block", "copy"))
    own = Window.partitionBy("deal", "g", "block", "copy")  # sorted by deal first: passes of all sources come in the order of their draws
    order = own.orderBy("order", "doc_id", "text_hash", "_alone")
    every = every.withColumns({"place": F.row_number().over(order), "upto": F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)), "all": F.sum("n_tokens").over(own)})
    room = (F.col("reads") - whole) * F.col("all") - (F.col("upto") - F.col("n_tokens"))
    part = (room >= F.col("n_tokens")) | (drawn(F.lit("edge"), "doc_id", "text_hash", "_alone") / float(1 << 40) < room / F.col("n_tokens"))
    return every.where((F.col("copy") <= whole) | ((F.col("n_tokens") > 0) & (room > 0) & part))


def plan(docs: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """One row per reading of a document: doc_id, text_hash, source, n_tokens, copy (from 1), block, place (from 1, in the block's permutation), weight."""
    return planned(docs, entropy, repeats, block, seed, False).select("doc_id", "text_hash", "source", "n_tokens", "copy", "block", "place", "weight")


def mix(docs: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """docs with each row as often as the plan reads it: passes of blocks of all sources in a drawn order, dealt among each other, each pass in its permutation."""
    return planned(docs, entropy, repeats, block, seed, True).select("row.*")
