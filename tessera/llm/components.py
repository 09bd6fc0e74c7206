"""Connected components of a graph given as edges, by alternating star contractions.

Every round links all larger neighbours of a node to its smallest neighbour
(large star), then all smaller ones (small star); components become stars
around their smallest node after a number of rounds that grows with the
logarithm of their size. Minima are partial aggregates and the joins are plain
equi-joins, which adaptive execution splits at skewed nodes. Each round is
written to the shared scratch folder; two numbers a round reach the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for every node that has an edge; ``root`` is its component's smallest
    node. Loops and repeated edges do no harm; null ends are left out."""
    pairs = edges.where((F.col(a) != F.col(b))).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now = materialize(pairs.distinct(), "components")
    seen = _signature(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(low, "u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where(F.col("v") != F.col("m")).select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(),
                          "components")
        after = _signature(now)
        if after == seen:
            break
        seen = after
    roots = now.select("v").distinct().select(F.col("v").alias("u"), "v")
    return now.unionByName(roots).select(F.col("u").alias("node"), F.col("v").alias("root"))


def merge_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """In one task: give linked members ``a[i]``, ``b[i]`` one label, the least of theirs."""
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            jump = label[label]
            if (jump == label).all():
                break
            label[:] = jump
        differ = label[a] != label[b]
        a, b = a[differ], b[differ]
