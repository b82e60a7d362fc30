"""Connected components of a graph given by its edges, by contraction in few rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from entitylake.session import materialized


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``; equal roots mean one component.

    Each round, every node moves to the least node among itself and its neighbours, least by a
    hash, and the edges move along. Nodes that nobody moves to disappear, so a round shrinks
    even a long chain by a constant share, and a hub's edges collapse in the first round.
    A round's edges and moves are written to the shared folder. Nodes may be of any type that
    can be compared; loops and repeated edges are allowed, null ends are ignored.
    """
    both = [F.col("a").isNotNull() & F.col("b").isNotNull(), F.col("a") != F.col("b")]
    edges = materialized(edges.select("a", "b").where(both[0] & both[1]).distinct(), "edges")
    moves = []
    while not edges.isEmpty():
        ends = edges.select("a", "b").union(edges.select("b", "a"))
        rank = lambda c: F.struct(F.xxhash64(c).alias("rank"), F.col(c).alias("id"))
        least = ends.groupBy("a").agg(F.min(rank("b")).alias("near"))
        move = materialized(
            least.select(F.col("a").alias("node"), F.least("near", rank("a"))["id"].alias("root")), "moves"
        )
        moves.append(move)
        edges = materialized(
            edges.join(move.select(F.col("node").alias("a"), F.col("root").alias("c")), "a")
            .join(move.select(F.col("node").alias("b"), F.col("root").alias("d")), "b")
            .where(F.col("c") != F.col("d"))
            .select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b"))
            .distinct(),
            "edges",
        )
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = moves.pop()
    while moves:  # a root of one round may have moved on in the next
        last = found.select(F.col("node").alias("root"), F.col("root").alias("final"))
        found = moves.pop().join(last, "root", "left").select("node", F.coalesce("final", "root").alias("root"))
    return found
