"""Connected components of a distributed edge table, of which the driver holds no more than FEW_EDGES edges."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut, release


#: Edges that the driver joins itself at most, 16 bytes each: the rounds over a small table cost more than its rows.
FEW_EDGES = 200_000


def labels(src: np.ndarray, dst: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of edges src, dst, and the smallest node reachable from each."""
    nodes, at = np.unique(np.concatenate([src, dst]), return_inverse=True)
    u, v = at[: len(src)], at[len(src) :]
    least = np.arange(len(nodes))
    while True:
        low = np.minimum(least[u], least[v])
        now = least.copy()
        for side in (u, v):  # what is reached lowers a node, and the node that it was led to
            np.minimum.at(now, side, low)
            np.minimum.at(now, least[side], low)
        while (now[now] != now).any():
            now = now[now]
        if (now == least).all():
            return nodes, nodes[least]
        least = now


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable from each node of edges(src, dst).

    Alternates large-star and small-star steps (Kiveris et al. 2014) until the edge table is a
    forest of stars. Each step shuffles the edges twice and is cut to the shared folder; a node
    of very many edges is pre-aggregated (min) and its join can be split by AQE. Edges from a
    node to itself, and repeated ones, do no harm. An empty table gives an empty one. A table of
    FEW_EDGES edges at most, which is to be cheap to count, is labelled by the driver.
    """
    edges = edges.where("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
    if edges.count() <= FEW_EDGES:
        held = edges.toArrow()
        node, comp = labels(*(held.column(c).to_numpy() for c in ("u", "v")))
        return edges.sparkSession.createDataFrame(pa.table({"node": pa.array(node, pa.int64()), "comp": pa.array(comp, pa.int64())}))
    edges = cut(edges.distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        old, edges = edges, cut(small)
        release(old)
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
        if before == now or not now[0]:
            break
        before = now
    return edges.groupBy("u").agg(F.min("v").alias("comp")).select(F.col("u").alias("node"), "comp").unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
