"""Connected components of a distributed graph, by repeated contraction."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

# Links that one task may finish: some 10 MB, whatever the graph was at first.
FEW_LINKS = 1 << 16


def connected_components(links: DataFrame, *, few: int = FEW_LINKS) -> DataFrame:
    """`node`, `component` for each node of `links` (`a`, `b`); nodes of one component share a
    value, which is one of its nodes.

    In each round every node moves to the least of its neighbours and itself, in an order that is
    drawn anew, so that a round takes a share of the nodes away whatever their shape (a star in
    one round, a chain in some log n). Each round is stored; nothing comes to the driver but
    how many links are left. Partial minima keep a node with very many links from being a hot key.
    At most `few` links that are left are followed by one task in the last round.
    """
    links = stored(links.where("a != b").select("a", "b").distinct(), "links")
    moves: list[DataFrame] = []
    while left := links.count():
        if left <= few:
            last = links.coalesce(1).mapInPandas(_followed, links.select(F.col("a").alias("node"), F.col("b").alias("to")).schema)
            moves.append(stored(last, "moves"))
            break
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))

        def ranked(node: str):
            return F.struct(F.xxhash64(F.lit(len(moves)), node), F.col(node))

        least = both.groupBy("a").agg(F.min(ranked("b")).alias("least"))
        move = stored(
            least.select(
                F.col("a").alias("node"),
                F.when(F.col("least") < ranked("a"), F.col("least.b"))
                .otherwise(F.col("a"))
                .alias("to"),
            ),
            "moves",
        )
        moves.append(move)
        links = stored(
            links.join(move.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
            .join(move.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
            .where("x != y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct(),
            "links",
        )
    if not moves:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = moves[0].withColumnRenamed("to", "component")
    for move in moves[1:]:
        later = move.select(F.col("node").alias("component"), "to")
        found = found.join(later, "component", "left").select(
            "node", F.coalesce("to", "component").alias("component")
        )
    return found


def _followed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All of a few links followed to the end: each node with the first node of its component."""
    to: dict = {}

    def root(node):
        while to[node] != node:
            to[node] = to[to[node]]
            node = to[node]
        return node

    for frame in frames:
        for a, b in zip(frame["a"], frame["b"]):
            to.setdefault(a, a)
            to.setdefault(b, b)
            one, two = root(a), root(b)
            to[max(one, two)] = min(one, two)
    yield pd.DataFrame({"node": list(to), "to": [root(node) for node in to]})
