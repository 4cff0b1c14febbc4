"""Connected components of links between documents, as grouped minima; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxgrain.llm.lineage import kept


def components(links: DataFrame) -> DataFrame:
    """links (a, b), undirected, in any number and order -> (v, root) of every end: root is the smallest id of its component.

    Each turn takes the least label of the neighbours and then the label's own label, so that chains halve. A hub's links
    are summed up where they lie. Without links there are no rows; links of a document to itself give it as its own root.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = kept(both)
    state = kept(both.groupBy("a").agg(F.min("b").alias("l")).select(F.col("a").alias("v"), F.least("a", "l").alias("l")))
    while True:
        near = both.join(state, both["b"] == state["v"]).groupBy("a").agg(F.min("l").alias("m"))
        lower = kept(state.join(near, state["v"] == near["a"]).select("v", F.col("l").alias("was"), F.least("l", "m").alias("l")))
        if lower.where("l <> was").isEmpty():
            return lower.select("v", F.col("l").alias("root"))
        jump = lower.select(F.col("v").alias("x"), F.col("l").alias("far"))
        state = kept(lower.join(jump, lower["l"] == jump["x"]).select("v", F.least("l", "far").alias("l")))
