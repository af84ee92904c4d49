"""Connected components of an edge table, as Spark joins and aggregations.

Each round contracts the graph.  Every node is merged into the neighbour (or
itself) that has the least random rank of the round; the edges are then
rewritten to the merged nodes and deduplicated.  The random ranks make the
expected number of rounds logarithmic whatever the ids look like (a path
with ascending ids included).  Before each round a task replaces the edges
that it holds by a spanning forest of them, which changes no component and
takes most of the edges away.

Aggregations are partial before the shuffle and joins are plain joins that
adaptive execution can split, so a hub node with a third of all edges does
not end in one task.  Nothing but the count of edges left reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.common import stored

FOREST_ROWS = 500_000


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Least node reachable from each of the nodes 0..n-1 over edges a-b."""
    low = np.arange(n)
    while len(a):
        m = np.minimum(low[a], low[b])
        np.minimum.at(low, low[a], m)
        np.minimum.at(low, low[b], m)
        while True:
            up = low[low]
            if np.array_equal(up, low):
                break
            low = up
        open_ = low[a] != low[b]
        a, b = a[open_], b[open_]
    return low


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, root) with the same components as the edges u-v."""
    codes, names = pd.factorize(np.concatenate([u, v]))
    low = roots(codes[:len(u)], codes[len(u):], len(names))
    keep = low != np.arange(len(names))
    return names[keep], names[low[keep]]


def _forests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: list[pd.DataFrame] = []
    rows = 0
    for b in batches:
        held.append(b)
        rows += len(b)
        if rows >= FOREST_ROWS:
            u, v = forest(pd.concat(held).u.to_numpy(), pd.concat(held).v.to_numpy())
            held, rows = [pd.DataFrame({"u": u, "v": v})], 0
    if held:
        whole = pd.concat(held)
        u, v = forest(whole.u.to_numpy(), whole.v.to_numpy())
        yield pd.DataFrame({"u": u, "v": v})


def connected_components(edges: DataFrame, src: str = "u", dst: str = "v") -> DataFrame:
    """(node, component) for every node of an edge; the component is named by
    one of its nodes.  Ids may be long or string.  Edges with a null end and
    loops are left out; an empty table gives an empty result.
    """
    kind = edges.schema[src].dataType.simpleString()
    cur = edges.select(F.col(src).alias("u"), F.col(dst).cast(kind).alias("v")).where("u <> v")
    maps: list[DataFrame] = []
    for turn in range(200):
        cur = stored(cur.mapInPandas(_forests, f"u {kind}, v {kind}"), "edges")
        if cur.isEmpty():
            break
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("r"), c.alias("id"))
        both = cur.union(cur.select("v", "u"))
        up = stored(
            both.groupBy(F.col("u").alias("node")).agg(F.min(rank(F.col("v"))).alias("m"))
            .select("node", F.least(F.col("m"), rank(F.col("node")))["id"].alias("up")), "up")
        maps.append(up)
        cur = (cur.join(up.select(F.col("node").alias("u"), F.col("up").alias("a")), "u")
               .join(up.select(F.col("node").alias("v"), F.col("up").alias("b")), "v")
               .where("a <> b")
               .select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct())
    if not maps:
        return edges.sparkSession.createDataFrame([], f"node {kind}, component {kind}")
    out = maps[0].select("node", F.col("up").alias("component"))
    for up in maps[1:]:
        step = up.select(F.col("node").alias("component"), "up")
        out = (out.join(step, "component", "left")
               .select("node", F.coalesce("up", "component").alias("component")))
    return stored(out, "components")
