"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.llm.common import written

MAX_ROUNDS = 100


def _large_star(links: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("_a")).agg(F.min("b").alias("_least"))
    return (
        both.filter("b > a").join(least, F.col("a") == F.col("_a"))
        .select(F.col("b").alias("a"), F.least("_least", "_a").alias("b")).distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them. Rows have ``b < a``."""
    least = links.groupBy(F.col("a").alias("_a")).agg(F.min("b").alias("_least"))
    joined = links.join(least, F.col("a") == F.col("_a"))
    moved = joined.select(F.col("b").alias("a"), F.col("_least").alias("b")).filter("a <> b")
    return moved.union(least.select(F.col("_a").alias("a"), F.col("_least").alias("b"))).distinct()


def _state(links: DataFrame):
    return links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b``); the root is the smallest node of its component.

    Each step aggregates before its shuffle and joins on nodes, which adaptive execution splits
    where one node has very many links. Links are written after every round.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    links = written(links, "links")
    before = _state(links)
    for _ in range(MAX_ROUNDS):
        links = written(_small_star(_large_star(links)), "links")
        after = _state(links)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
