"""Connected components of an edge table, by alternating stars, and of one tile, in numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from argulith.session import stage


def tile_roots(left: np.ndarray, right: np.ndarray, nodes: int) -> np.ndarray:
    """Smallest node reachable from every node of a small graph, by hooking and pointer jumping."""
    root = np.arange(nodes)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        while True:
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        if np.array_equal(new, root):
            return root
        root = new


def _digest(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    )


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges with a > b: link a node's larger (or smaller) neighbours to its least.

    The least neighbour is an ordinary aggregate, combined before the shuffle; it is joined back to
    the edges, so the neighbours of a node are never gathered in one place.
    """
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    around = edges.unionByName(turned) if large else edges
    least = around.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m")) if large else least
    met = (turned if large else edges).join(least, "a")
    if large:  # a is the smaller end: its larger neighbours go to the least one
        moved = met.select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:  # a is the larger end: its smaller neighbours, and itself, go to the least one
        moved = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return moved.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the edge table ``(a, b)`` of longs, roots included.

    ``root`` is the smallest node reachable. Edges may be repeated, loops and edges with a null
    are ignored; nodes without an edge are not in the result. Every round is written to the shared
    folder, so a lost executor costs one round at most. Ends when the edges no longer change, which
    takes about log(longest path) squared rounds.
    """
    current = stage(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    before = _digest(current)
    while before[0]:
        current = stage(_star(_star(current, large=True), large=False), "stars")
        after = _digest(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
