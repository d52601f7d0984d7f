"""Connected components by repeated contraction of the edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmart.llm.shared import stored


def components(edges: DataFrame) -> DataFrame:
    """node and comp (a node of its component) of every node of ``edges`` (a, b), both long.

    Each round a node moves to the neighbour, or itself, that a hash of the round puts first, and on to where that one
    moves, and the edges between moved nodes go on; the number of nodes falls by a constant factor, so rounds grow with its logarithm.
    No edges give no rows; loops and repeated edges change nothing.
    """
    moves: list[DataFrame] = []
    left = stored(edges.where("a <> b").distinct(), "edges")
    while not left.isEmpty():
        turn = len(moves)
        place = lambda c: F.struct(F.xxhash64(F.lit(turn), F.col(c)).alias("h"), F.col(c).alias("id"))  # noqa: B023, E731
        both = left.select(F.col("a").alias("v"), F.col("b").alias("u")).union(left.select("b", "a"))
        best = both.groupBy("v").agg(F.min(place("u")).alias("n"))
        near = best.select("v", F.least("n", place("v"))["id"].alias("to"))
        far = near.select(F.col("v").alias("to"), F.col("to").alias("far"))
        move = stored(near.join(far, "to").select("v", F.col("far").alias("to")), "moves")
        moves.append(move)
        new_a = move.select(F.col("v").alias("a"), F.col("to").alias("to_a"))
        new_b = move.select(F.col("v").alias("b"), F.col("to").alias("to_b"))
        moved = left.join(new_a, "a").join(new_b, "b").where("to_a <> to_b")
        left = stored(
            moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "edges"
        )
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("comp")).limit(0)
    out = moves[0].select(F.col("v").alias("node"), F.col("to").alias("comp"))
    for move in moves[1:]:
        step = move.select(F.col("v").alias("comp"), "to")
        out = out.join(step, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp"))
    return stored(out, "components")
