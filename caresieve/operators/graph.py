"""Connected components of a graph that is only held in distributed tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caresieve.operators.skew import Steps, cut, salted_join


def joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In one task: the smallest place that each place reaches, when links (a, b) are added to those that gave root."""
    while len(a):
        x, y = root[a], root[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        if (low == high).all():
            break
        new = root.copy()
        np.minimum.at(new, high, low)
        while (new != new[new]).any():
            new = new[new]
        root = new
    return root


def _stars(edges: DataFrame, small: bool, steps: Steps) -> DataFrame:
    """One star operation: each node's neighbours are linked to its smallest one instead.

    edges: rows (a, b), a > b. small: only neighbours below the node move, else
    only those above it. Minima are aggregated before the shuffle, and a node
    with very many neighbours is dealt over tasks when its minimum goes to them.
    """
    sides = edges if small else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = steps.keep(sides.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count(F.lit(1)).alias("n")))
    moved = salted_join(sides, least, ["a"], "n", "b")
    if small:
        out = moved.select(F.col("b").alias("x"), "m").unionByName(least.select(F.col("a").alias("x"), "m"))
    else:
        out = moved.where("b > a").select(F.col("b").alias("x"), "m")
    return out.where("x <> m").select(F.greatest("x", "m").alias("a"), F.least("x", "m").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge, root being the smallest node that it reaches.

    edges: columns a and b of one orderable type; direction and repeats don't
    matter, loops are ignored. Large-star and small-star alternate until nothing
    changes: O(log^2 n) rounds, each a few shuffles of at most the edges. Each is
    written to the shared folder, so lost executors cost one round at most; what a
    round no longer needs is removed.
    """
    steps = Steps(edges.sparkSession)
    try:
        now = steps.keep(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        mark = _mark(now)
        while True:
            now = steps.keep(_stars(now, False, steps))
            now = steps.keep(_stars(now, True, steps))
            steps.forget(before=steps.held)
            before, mark = mark, _mark(now)
            if mark == before:
                break
        both = now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        return cut(both)
    finally:
        steps.forget()


def _mark(edges: DataFrame) -> tuple:
    """Count and an order-free checksum of the edges."""
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(F.shiftright(h, 32))).first())
