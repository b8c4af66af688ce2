"""Connected components of an edge table by alternating large and small stars.

Every round is two grouped minima and joins; no neighbourhood is ever collected. A round's edges
are written to the shared checkpoint folder, which cuts the lineage and survives lost executors. The number
of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverframe.operators.settle import settle

ROUNDS = 60


def connected(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (smallest node reachable) for every node of ``edges`` (a, b longs).

    Loops, repeated edges, either direction and null ends are allowed (null ends are no edge); an empty
    table gives an empty result. Nodes without an edge are not in the result.
    """
    now = settle(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = _state(now)
    for _ in range(ROUNDS):
        if not state[0]:
            break
        now = settle(_small_star(_large_star(now)), "edges")
        last, state = state, _state(now)
        if state == last:
            break
    else:
        raise RuntimeError(f"no fixed point after {ROUNDS} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)


def _state(edges: DataFrame) -> tuple:
    """Number of edges and two checks on them: equal when the edges are the same."""
    x = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.sum(F.pmod(x, F.lit(1 << 31))), F.bit_xor(x)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(low.select("u", F.col("m").alias("v"))).distinct()
