"""Connected components of a table of links, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from taxaloom.session import cut


def components(links: DataFrame) -> DataFrame:
    """(id, component) of all ends of ``links`` (a, b): the least id reachable.

    Alternates two steps until nothing changes: every node passes its least
    neighbour to its larger neighbours, then to its smaller ones. The number of
    rounds grows with the logarithm of the longest path. Least neighbours are
    aggregated in map tasks and joined back, so a node with very many links is
    split by adaptive execution. No links give no rows.
    """
    spark = links.sparkSession
    edges = cut(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    seen = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.join(least, "a")
            .filter("b > a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
            .distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(
                F.array(
                    F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))
                )
            ).alias("e")
        )
        edges = cut(small.select("e.a", "e.b").filter("a <> b").distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
        if state == seen:
            break
        seen = state
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)
