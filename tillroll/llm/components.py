"""Connected components of a link table, as alternating star contractions.

Each round rewrites the links so that every node points at the smallest node
it can see: first among its larger neighbours, then among its smaller ones.
The rounds needed grow with the logarithm of the longest chain. Links,
labels and components stay distributed; each round is cut with a reliable
checkpoint, and only one row (a count and two hashes) reaches the driver to
tell whether anything moved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import cut


def _signature(links: DataFrame):
    return links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("long"))).first()


def components(links: DataFrame) -> DataFrame:
    """``links`` (a long, b long; either order, repeats allowed) to (node,
    root): every linked node with the smallest node it can reach. Links of a
    node to itself are ignored; an empty table gives an empty table."""
    # a > b throughout
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = cut(edges)
    before = _signature(edges)
    while before[0]:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # larger neighbours of each node go to the smallest of its neighbourhood
        smallest = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        smallest = smallest.select("u", F.least("u", "m").alias("m"))
        large = edges.join(smallest, edges.b == smallest.u).select(edges.a.alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # a node and its smaller neighbours go to the smallest of them
        small = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        moved = large.join(small, large.a == small.u).select(large.b.alias("a"), F.col("m").alias("b"))
        kept = small.select(F.col("u").alias("a"), F.col("m").alias("b"))
        edges = cut(moved.unionAll(kept).where("a <> b").distinct())
        after = _signature(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
