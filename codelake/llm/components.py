"""Connected components of a link table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codelake.llm.common import stored


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star for each component of the links ``a[i] - b[i]``: every node but the smallest, with the smallest."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = ends[: len(a)], ends[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    child = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[child], nodes[label[child]]


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (src, dst) but the roots, the smallest nodes of their components.

    Alternates two steps until nothing changes: link the larger neighbours of each node with its smallest one, then the
    smaller ones. A round is stored, so a lost executor repeats no earlier one. Rounds grow with the logarithm of the
    longest chain. Smallest neighbours are stored before the join: hubs are split by the adaptive skew join.
    """
    edges = links.where("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct()
    edges, before = stored(edges, "components-links"), None
    while True:
        edges = stored(smaller(larger(edges)), "components-round")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("src").alias("node"), F.col("dst").alias("root"))
        before = now


def larger(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = stored(both.groupBy(F.col("src").alias("centre")).agg(F.min("dst").alias("low")).select(
        "centre", F.least("centre", "low").alias("low")), "components-low")
    up = both.where("dst > src").join(least, F.col("src") == F.col("centre"))
    return up.select(F.col("dst").alias("src"), F.col("low").alias("dst")).distinct()


def smaller(edges: DataFrame) -> DataFrame:
    edges = stored(edges, "components-large")
    least = stored(edges.groupBy(F.col("src").alias("centre")).agg(F.min("dst").alias("low")), "components-low")
    met = edges.join(least, F.col("src") == F.col("centre"))
    moved = met.where("dst <> low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    return moved.unionAll(least.select(F.col("centre").alias("src"), F.col("low").alias("dst"))).distinct()
