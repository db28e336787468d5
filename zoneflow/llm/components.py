"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.scratch import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, component)`` of every node of ``edges(a, b)``; a component is named by its smallest node.

    A large-star step links each larger neighbour of a node to the smallest node around it, a small-star step does so
    for the smaller neighbours.  Both need only minima per node, which are combined before the shuffle, so a node with
    a third of all edges is no heavier than another.  Every step is written to the shared folder.

    Self links and repeated edges change nothing; edges with a null end are ignored; no edges give no rows.
    """
    current = scratch.keep(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    state = _state(current)
    while state[0]:
        large = scratch.keep(_large_star(current))
        small = scratch.keep(_small_star(large))
        scratch.drop(current, large)
        current, before, state = small, state, _state(small)
        if state == before:
            break
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _state(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    row = edges.agg(F.count("*"), F.bit_xor(h), F.sum(F.pmod(h, F.lit(2**40)))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("v"), F.least("u", "m").alias("m"))
    return edges.join(least, "v").select("u", F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
