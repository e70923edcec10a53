"""Connected components of an edge table, by repeated contraction on all executors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import cut


def components(edges: DataFrame) -> DataFrame:
    """id and root of every vertex that has an edge (a, b) to another; equal roots mean one component.

    In each round every vertex moves to the neighbour of least hash (or stays, if its own is least), and edges between
    vertices that have met vanish. Hashes differ per round, so that no order of ids makes rounds many: the number of
    vertices falls by a constant factor. Each round is cut in the shared folder; nothing is collected.
    """
    open_edges = cut(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    moves: list[DataFrame] = []
    while not open_edges.isEmpty():
        rank = F.xxhash64(F.lit(len(moves)), F.col("b"))
        both = open_edges.unionByName(open_edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        own = F.struct(F.xxhash64(F.lit(len(moves)), F.col("a")).alias("rank"), F.col("a").alias("b"))
        near = both.groupBy("a").agg(F.min(F.struct(rank.alias("rank"), "b")).alias("near"))
        move = cut(near.select(F.col("a").alias("id"), F.least(own, F.col("near"))["b"].alias("root")), "moves")
        moved = open_edges.join(move.select(F.col("id").alias("a"), F.col("root").alias("x")), "a")
        moved = moved.join(move.select(F.col("id").alias("b"), F.col("root").alias("y")), "b")
        open_edges = cut(
            moved.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            "edges")
        moves.append(move)
    if not moves:
        return open_edges.select(F.col("a").alias("id"), F.col("b").alias("root"))
    roots = moves[0]
    for move in moves[1:]:
        later = move.select(F.col("root").alias("later"), F.col("id").alias("root"))
        roots = roots.join(later, "root", "left").select("id", F.coalesce("later", "root").alias("root"))
    return cut(roots, "roots")


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For rows 0 .. n-1 of one task: the least row that the pairs (left, right) connect each row with."""
    parent = np.arange(n)
    while len(left):
        a, b = parent[left], parent[right]
        differ = a != b
        left, right, a, b = left[differ], right[differ], a[differ], b[differ]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            above = parent[parent]
            if (above == parent).all():
                break
            parent = above
    return parent
