"""Connected components: a vectorised step inside tasks, and star contraction across them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import pinned


def spanning(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (u, v) -> one link (node, smallest node of its component) per node that isn't the smallest.

    What a task has found shrinks to at most one link a node, however many pairs it saw.
    """
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def components(links: DataFrame) -> DataFrame:
    """(u, v) links -> (node, root): the smallest node of its component, for every node that isn't it.

    Alternates large-star and small-star contraction until nothing changes (a number of
    rounds that grows with the logarithm of the component size). Each round is a few
    aggregations and joins over the links left, at most one per node after the first, and
    is written to the shared checkpoint folder. Self-links and nulls are ignored.

    A link (a, b), a > b, is kept at a. Large-star hands it on to the least neighbour of b, if b has one below
    itself; the least node of a component has none, so a hub's links stay as they are. That join
    is a left one on b with few rows on its other side, which adaptive execution splits where a hub
    that isn't the least yet has most of the links.
    """
    edges = pinned(links.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b"))
                   .filter("a is not null and b is not null and a != b").distinct())
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.shiftright(F.xxhash64("a", "b"), 20))).first()
        if state == seen or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
        least = pinned(edges.groupBy(F.col("a").alias("_b")).agg(F.min("b").alias("_least")))      # so a hub's side can be split
        large = edges.join(least, F.col("b") == F.col("_b"), "left").select("a", F.coalesce("_least", "b").alias("b"))
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        edges = pinned(large.join(lowest, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                       .union(lowest.select("a", F.col("m").alias("b"))).distinct())
