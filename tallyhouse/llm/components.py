"""Connected components of a graph that is only ever held as tables.

Alternating star operations: a large star links every larger neighbour of a node to the least of its neighbourhood, a
small star links the smaller neighbours and the node itself to the least one. Every round is joins and minima, so a hub
with millions of neighbours is a pre-aggregated group; about log(size) rounds leave a forest of stars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.shared import discard, stored


def _ordered(links: DataFrame) -> DataFrame:
    """Links (u, v) with u > v, each once."""
    return links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct()


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _ordered(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    return _ordered(links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.toDF("u", "v")))


def _state(links: DataFrame) -> tuple:
    """Number of links and a digest of them: equal before and after a round once all are stars."""
    return tuple(links.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.sum(F.xxhash64("v", "u") % 1_000_003)).first())


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of the nodes in edges (a, b): the least node that can be reached.

    Null ends are ignored. Nodes without an edge to another node, and components' least nodes, have no row: they are
    their own component. No edges give no rows.
    """
    current = stored(_ordered(edges.dropna(subset=["a", "b"]).select(F.col("a").alias("u"), F.col("b").alias("v"))), "links")
    state = _state(current)
    for _ in range(rounds):
        if not state[0]:
            break
        after = stored(_small_star(_large_star(current)), "links")
        discard(current)
        before, state, current = state, _state(after), after
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
