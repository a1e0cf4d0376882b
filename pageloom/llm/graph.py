"""Connected components of a table of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.session import shared_table

MAX_ROUNDS = 100


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node of its component) of the links ``a`` - ``b``, in arrays."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    root = np.arange(len(nodes))
    while len(x):
        low = np.minimum(root[x], root[y])
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        while True:
            above = root[root]
            if np.array_equal(above, root):
                break
            root = above
        open_ = root[x] != root[y]
        x, y = x[open_], y[open_]
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[child], nodes[root[child]]


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Links every neighbour of a node to the smallest of the node and its neighbours.

    A large star takes the neighbours above the node, a small star those below it.
    """
    both = links.select("a", "b")
    if large:
        both = both.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    found = both.join(least, "a")
    if large:
        found = found.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        found = found.select("b", "low").unionAll(least.select("a", "low")).toDF("a", "b")
    return found.where("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node of ``links`` but the smallest ones.

    ``links`` holds two BIGINT columns ``a`` and ``b``; either order, repeats and self-links are
    allowed, links with a null are left out. Alternates large and small stars, each a
    partial aggregate and a join that the planner may split, until the links no longer change: a
    number of rounds that grows with the logarithm of the nodes. Rounds are written to the shared folder.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), (F.col("a") != F.col("b")).alias("two"))
    links = shared_table(links.where("two").select("a", "b").distinct())
    state = None
    for _ in range(MAX_ROUNDS):
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or now[0] == 0:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = now
        links = shared_table(_stars(_stars(links, large=True), large=False))
    raise RuntimeError("the components did not settle")
