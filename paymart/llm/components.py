"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.llm.shared import staged


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); component is the smallest node.

    Each round hooks every larger neighbour of a node to the smallest one
    (large star), then every smaller neighbour (small star), until nothing
    changes; the number of rounds grows with the logarithm of the number of
    nodes. Every half round is written to the shared folder. Both sides of its
    join are written too, so that a node with very many links is split.
    Self links and nulls are ignored; a node without other links gets no row.
    """
    edges = links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    edges = staged(edges.distinct(), "links")
    seen = None
    while True:
        mark = edges.agg(F.count("u").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if tuple(mark) == seen or not mark["n"]:
            break
        seen = tuple(mark)
        both = staged(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "both")
        least = staged(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.distinct(), "large-star")
        least = staged(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
