"""Distributed connected components by contraction to the smallest neighbour.

Each round every node points to the smallest node among itself and its neighbours, and every edge is replaced by the
edge between the two pointed-at nodes. Rounds keep components connected and their smallest node, and shrink the graph
geometrically when node order is unrelated to the graph, as for hashes (callers with ordered ids hash them first).
All work is partial aggregates and equi-joins over edges; a hub's edges collapse in the aggregate before the shuffle,
and the joins are plain sort-merge joins whose hot partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialguard.llm.common import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the undirected ``edges(a, b)``.

    ``component`` is the smallest node of the component. Nulls, loops and repeated edges are ignored; an empty edge
    table gives an empty result. Every round is written to the shared folder, so a lost executor repeats one round.
    """
    pairs = edges.select(F.col("a"), F.col("b")).where("a != b")
    both = staged(pairs.unionAll(pairs.select(F.col("b"), F.col("a"))).distinct(), "edges")
    rounds: list[DataFrame] = []
    while not both.isEmpty():
        to = staged(both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("to")), "pointers")
        rounds.append(to)
        left = to.select(F.col("a"), F.col("to").alias("to_a"))
        right = to.select(F.col("a").alias("b"), F.col("to").alias("to_b"))
        moved = both.join(left, "a").select("b", "to_a").join(right, "b").where("to_a != to_b")
        both = staged(moved.select(F.col("to_a").alias("a"), F.col("to_b").alias("b")).distinct(), "edges")
    if not rounds:
        return both.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = rounds[-1].select(F.col("a").alias("node"), F.col("to").alias("component"))
    for to in reversed(rounds[:-1]):
        later = found.select(F.col("node").alias("to"), F.col("component"))
        found = to.join(later, "to", "left").select(
            F.col("a").alias("node"), F.coalesce("component", "to").alias("component")
        )
    return found
