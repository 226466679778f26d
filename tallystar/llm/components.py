"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step links the neighbours of a vertex to the smallest vertex known there. The minimum of a
vertex is written before it is joined back, so that adaptive execution can split the edges of a
vertex that holds a large part of them. Nothing but one count and one checksum per step reaches
the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.llm.tables import Scratch


def connected(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Edges (a, b), longs -> (v, c): the smallest vertex c of each vertex's component.

    The result is the scratch table `<name>-labels`. Vertices without edges are not returned. Null ends, loops and repeated edges don't matter;
    an empty table gives an empty result.
    """
    found = scratch.saved(_small_star(edges.where("a <> b"), scratch, f"{name}-0"), f"{name}-0")
    scratch.drop(f"{name}-0-least")
    mark, step = _mark(found), 0
    while True:
        step += 1
        large = scratch.saved(
            _large_star(found, scratch, f"{name}-{step}"), f"{name}-{step}-large"
        )
        scratch.drop(f"{name}-{step}-around", f"{name}-{step - 1}")
        found = scratch.saved(_small_star(large, scratch, f"{name}-{step}"), f"{name}-{step}")
        scratch.drop(f"{name}-{step}-least", f"{name}-{step}-large")
        last, mark = mark, _mark(found)
        if mark == last:
            break
    roots = found.select(F.col("b").alias("v"), F.col("b").alias("c")).distinct()
    labels = scratch.saved(
        found.select(F.col("a").alias("v"), F.col("b").alias("c")).union(roots), f"{name}-labels"
    )
    scratch.drop(f"{name}-{step}")
    return labels


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def _small_star(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The smaller neighbours of a vertex, and itself, go to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    least = scratch.saved(down.groupBy("u").agg(F.min("v").alias("m")), f"{name}-least")
    return (
        least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        .union(
            down.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        )
        .distinct()
    )


def _large_star(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The larger neighbours of a vertex go to the smallest of its neighbours and itself."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = scratch.saved(
        both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{name}-around"
    )
    return (
        both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    )
