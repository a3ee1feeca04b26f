"""Connected components of an edge table by repeated contraction, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.runtime import materialized


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that edges (a, b) of long ids lead to, for each node.

    In each round every node moves to the neighbour that comes first in an order drawn anew for the
    round, or stays when it comes first itself; edges are rewritten to the new names and equal
    edges merge. The order keeps long chains from shrinking by one node a round. Rounds end when no
    edge is left; every round is stored. Nodes without an edge to another node are not in the
    result.
    """
    left = materialized(edges.filter("a != b").select("a", "b").distinct(), "graph-edges")
    moves: list[DataFrame] = []
    while not left.isEmpty():

        def ranked(node: str, turn: int = len(moves)) -> Column:
            return F.struct(
                F.xxhash64(F.col(node), F.lit(turn)).alias("rank"), F.col(node).alias("node")
            )

        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        move = materialized(
            both.groupBy("a").agg(F.min(ranked("b")).alias("best"))
            .select(F.col("a").alias("node"), F.least(ranked("a"), "best")["node"].alias("to")),
            "graph-moves",
        )
        moves.append(move)
        a = move.select(F.col("node").alias("a"), F.col("to").alias("new_a"))
        b = move.select(F.col("node").alias("b"), F.col("to").alias("new_b"))
        left = materialized(
            left.join(a, "a").join(b, "b")
            .select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b"))
            .filter("a != b").distinct(),
            "graph-edges",
        )
    if not moves:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    # Follow the moves of the later rounds; a node that a later round does not name stays.
    out = moves[-1].select("node", F.col("to").alias("end"))
    for move in reversed(moves[:-1]):
        later = out.select(F.col("node").alias("to"), "end")
        out = materialized(
            move.join(later, "to", "left").select("node", F.coalesce("end", "to").alias("end")),
            "graph-ends",
        )
    lowest = out.groupBy("end").agg(F.min("node").alias("component"))
    return out.join(lowest, "end").select("node", "component")
