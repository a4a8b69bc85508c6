"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import written


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step. Every node finds the least id among itself and its
    neighbours (all of them, or only the smaller ones) and hands it to its
    larger (or smaller) neighbours. The least id is an aggregate joined back,
    so no neighbour list is ever gathered."""
    if larger:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        out = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        out = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = out.union(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame, parts: int | None = None, rounds: int | None = None) -> DataFrame:
    """(node, label) for every node of ``edges`` (columns a, b); the label is the
    least node id of the component. Alternates large-star and small-star steps
    (Kiveris et al. 2014) until the edge list no longer changes, or for so many
    ``rounds``: then nodes with one label are connected, but a component may
    still have several. ``parts`` is the largest number of files to write."""
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct(), "edges", parts)
    seen = None
    while True:
        now = written(_stars(_stars(now, True), False), "edges", parts)
        if rounds is not None and (rounds := rounds - 1) == 0:
            break
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    # a node may still have several edges when the rounds were limited: it takes the least
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("label"))).groupBy("node").agg(F.min("label").alias("label"))
