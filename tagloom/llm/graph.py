"""Connected components by random contraction.

Every node points at the neighbour (or itself) whose hash is smallest; edges are
rewritten to the nodes pointed at and the next round uses other hashes, so a
constant part of the nodes goes in each round whatever the shape of the graph.
A hot node is never gathered: its smallest neighbour is an aggregate with
map-side combine, and the rewriting joins are plain joins that adaptive
execution may split. Each round is a table in the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.sources.sinks import materialise


def components(edges: DataFrame) -> DataFrame:
    """``edges`` with long columns ``a``, ``b``; returns ``node``, ``root`` of every node with an edge to another.

    Nulls, self loops and repeated edges do not matter; no edges give no rows.
    """
    links = materialise(_clean(edges))
    steps = []
    while not links.isEmpty():
        seed = F.lit(len(steps))
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = F.min(F.struct(F.xxhash64("b", seed).alias("h"), F.col("b").alias("n")))
        found = both.groupBy("a").agg(best.alias("m"))
        own = F.struct(F.xxhash64("a", seed).alias("h"), F.col("a").alias("n"))
        step = materialise(found.select(F.col("a").alias("node"), F.least("m", own)["n"].alias("to")))
        steps.append(step)
        left = links.join(step.select(F.col("node").alias("a"), F.col("to").alias("a2")), "a")
        right = left.join(step.select(F.col("node").alias("b"), F.col("to").alias("b2")), "b")
        links = materialise(_clean(right.select(F.col("a2").alias("a"), F.col("b2").alias("b"))))
    if not steps:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    labels = steps[0].withColumnRenamed("to", "root")
    for step in steps[1:]:
        onward = step.select(F.col("node").alias("root"), "to")
        labels = labels.join(onward, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return labels


def _clean(edges: DataFrame) -> DataFrame:
    pair = edges.filter(F.col("a") != F.col("b"))
    return pair.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
