"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, staged


def _lowest(neighbours: DataFrame) -> DataFrame:
    """u, low: the smallest of u and its neighbours (combined before the shuffle)."""
    return neighbours.groupBy("u").agg(F.least("u", F.min("v")).alias("low"))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """node, component (its smallest node) for every node of ``edges`` (columns u, v).

    A star step is an aggregate and a join, never a list of neighbours, so a
    node with very many of them is no hot spot; the number of rounds grows
    with the logarithm of the longest path.
    """
    stars = staged(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name
    )
    mark = None
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_lowest(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        )
        low = _lowest(large)
        small = large.join(low, "u").select("u", "v", "low")
        before = stars
        stars = staged(
            small.filter("v <> low")
            .select(F.col("v").alias("u"), F.col("low").alias("v"))
            .unionByName(low.select("u", F.col("low").alias("v")))
            .filter("u <> v")
            .distinct(),
            name,
        )
        discard(before)
        now = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    roots = stars.select("v").distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("component"))
    )


def merge_classes(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the classes of the places i and j, pair by pair; labels stay places of their own class."""
    while len(i):
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:  # every label a root
            root = label[label]
            if np.array_equal(root, label):
                break
            label[:] = root
