"""Connected components of a large set of links, without collecting them.

Rounds of large-star and small-star joins until nothing changes; each round is written to the shared folder, which
cuts the lineage.  Before the first round every task contracts its own links to stars, so few links and few rounds
remain.  A node with very many links meets one row per other node at most in the joins, which adaptive execution
splits, and its minimum is a partial aggregate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.sources.scratch import stored


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links with the same components: every node to the smallest node it reaches, itself left out."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        while (jump := new[new]).tobytes() != new.tobytes():
            new = jump
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size >= 1 << 20:
            joined = pd.concat(held)
            high, low = stars(joined["a"].to_numpy(), joined["b"].to_numpy())
            yield pd.DataFrame({"a": high, "b": low})
            held, size = [], 0
    if held:
        joined = pd.concat(held)
        high, low = stars(joined["a"].to_numpy(), joined["b"].to_numpy())
        yield pd.DataFrame({"a": high, "b": low})


def components(links: DataFrame) -> DataFrame:
    """`node` and `component` (the smallest node reachable) of every node in `links` (columns `a`, `b`, long).

    Nodes that are their component's smallest are left out; an empty table of links gives an empty table.
    """
    edges = stored(links.mapInPandas(_contract, "a long, b long").distinct(), "links")
    size = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    while size[0]:
        # Large star: every larger neighbour of a node goes to the smallest neighbour.
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        # Small star: every smaller neighbour, and the node itself, goes to the smallest of them.
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("low").alias("b")).union(least.toDF("a", "b"))
        edges = stored(small.where("a <> b").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == size:
            break
        size = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
