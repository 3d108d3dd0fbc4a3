"""Connected components of links, in tasks (numpy) and over the cluster (star contractions)."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrocar.session import stage


def local_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node reachable from each of ``n`` nodes over the links (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def _to_minimum(neighbours: DataFrame) -> DataFrame:
    """Each neighbour of (u, v) with the minimum of u's neighbourhood, u included."""
    least = neighbours.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return neighbours.join(least, "u")


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, component): the smallest node reachable, for each node of the links (u, v).

    Alternates large-star and small-star contractions until every node hangs below the smallest
    of its component. A hub's links are spread by the join's skew handling; each round is written
    to the shared folder, so a lost executor costs at most a round. Nodes without links are not
    returned; links with a null end are none.
    """
    edges = stage(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_minimum(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.where("u <> v")
        met = _to_minimum(down)
        small = met.select(F.col("v").alias("u"), F.col("m").alias("v")).union(met.select("u", F.col("m").alias("v")))
        edges = stage(small.where("u <> v").distinct(), "links")
        heads = edges.select(F.col("v").alias("u")).distinct()
        if edges.join(heads, "u", "left_semi").isEmpty() and edges.groupBy("u").count().where("count > 1").isEmpty():
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
