"""Connected components by randomised contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinspark.shared import table

LOCAL = 1 << 20  #: links that one task closes


def local_components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Label of each of n places: the smallest place that links (i, j) reach; for links that one task holds."""
    label = np.arange(n)
    while True:
        was = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == was).all():
            return label


def _closed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All links (u, v) to (node, to): the smallest node that each one reaches."""
    e = pd.concat(list(batches))
    code, nodes = pd.factorize(pd.concat([e["u"], e["v"]]), sort=True)
    to = local_components(len(nodes), code[: len(e)], code[len(e) :])
    yield pd.DataFrame({"node": nodes, "to": nodes[to]})


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(u long, v long) links to (node, component), component = the smallest node reachable.

    Each round hooks every node to the neighbour (or itself) of lowest pseudo-random priority and
    contracts, so that any graph, long paths included, shrinks by a constant factor a round. Only
    nodes that occur in a link are returned. Null ends and self links are ignored. What is left of at most ``LOCAL``
    links is closed in one task, with the same result.
    """
    e = table(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u is not null and v is not null and u <> v").distinct(),
        "edges",
    )
    hops: list[DataFrame] = []
    for r in range(max_rounds):
        n = e.count()
        if n <= LOCAL:
            if n:
                hops.append(table(e.coalesce(1).mapInPandas(_closed, e.select(F.col("u").alias("node"), F.col("v").alias("to")).schema), "hop"))
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(r)).alias("h"), F.col(c).alias("n"))  # noqa: B023,E731
        hop = table(both.groupBy("u").agg(F.min(rank("v")).alias("m")).select(F.col("u").alias("node"), F.least("m", rank("u"))["n"].alias("to")), "hop")
        hops.append(hop)
        near = e.join(hop.select(F.col("node").alias("u"), F.col("to").alias("a")), "u").join(hop.select(F.col("node").alias("v"), F.col("to").alias("b")), "v")
        e = table(near.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    else:
        if not e.isEmpty():
            raise RuntimeError("components did not converge")
    if not hops:
        return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    label = hops[-1].select("node", F.col("to").alias("root"))
    if len(hops) == 1 and n:  # closed at once: roots are smallest nodes
        return label.withColumnRenamed("root", "component")
    for hop in reversed(hops[:-1]):
        up = label.select(F.col("node").alias("to"), "root")
        label = hop.join(up, "to", "left").select("node", F.coalesce("root", "to").alias("root"))
    least = label.groupBy("root").agg(F.min("node").alias("component"))
    return label.join(least, "root").select("node", "component")
