"""Problem 5: consolidating pairwise matches into groups.

Method: low-diameter decomposition. Every vertex draws an exponential shift and starts a
cluster that much earlier; clusters grow along edges and a vertex joins the one that
reaches it first (the largest ``shift - distance``). Clusters contract to super-vertices,
the edges between clusters form the next, geometrically smaller graph, and the
assignments of all levels are composed.

A level grows until fewer than one vertex in ``SETTLED`` still changes its cluster; a
cluster is connected at every step, so edges cut early only go to the next level. Only
vertices that changed send on, messages are reduced on the map side, and labels are
written every ``STEPS`` steps. What is left when at most ``LOCAL_EDGES`` edges remain
(counted first) is decomposed by one task with the same shifts. Maps are composed from the
smallest level down, so the vertices themselves are joined once; clusters that hold a
large share of a level go by ``join_sized``. The driver sees row counts only.

Edge cases: null ends and self-links are left out; repeated and reversed links count
once; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaloom.runtime import Scratch, join_sized

#: Rate of the shifts: the mean lead is 1 / BETA steps, and about BETA of the edges are cut.
BETA = 0.1
STEPS = 3
SETTLED = 50
LOCAL_EDGES = 20_000


def _grown(edges: DataFrame, level: int, beta: float, scratch: Scratch) -> DataFrame:
    """``a, centre``: the cluster of each vertex when next to none changes any more."""
    both = scratch.put(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    unit = F.pmod(F.xxhash64("a", F.lit(level)), F.lit(1 << 52)).cast("double") / float(1 << 52)
    labels = both.select("a").distinct().select("a", (-F.log(1 - unit) / beta).alias("lead"), F.col("a").alias("centre"), F.lit(True).alias("moved"))
    last = None
    while True:
        for _ in range(STEPS):
            sent = both.join(labels.filter("moved"), "a").select(F.col("b").alias("a"), (F.col("lead") - 1).alias("lead"), "centre", F.lit(True).alias("moved"))
            met = labels.withColumn("moved", F.lit(False)).unionByName(sent).groupBy("a")
            # The largest lead wins, on a tie the label held so far, then the larger centre.
            labels = met.agg(F.max(F.struct("lead", (~F.col("moved")).alias("held"), "centre")).alias("x"))
            labels = labels.select("a", "x.lead", "x.centre", (~F.col("x.held")).alias("moved"))
        written = scratch.put(labels)
        scratch.drop(last)
        last = written
        n, moved = written.agg(F.count("*"), F.count_if("moved")).first()
        if moved * SETTLED < n:
            scratch.drop(both)
            return written.select("a", "centre")
        labels = written


def _local(pdf: pd.DataFrame, level: int, beta: float) -> pd.DataFrame:
    """``a, centre`` of a bounded graph: all its levels, composed."""
    a, b = pdf["a"].to_numpy(), pdf["b"].to_numpy()
    nodes = np.unique(np.concatenate([a, b]))
    at = np.arange(len(nodes))
    u, v = np.searchsorted(nodes, a), np.searchsorted(nodes, b)
    rng = np.random.default_rng(level)
    while len(u):
        lead = rng.exponential(1 / beta, len(nodes))
        centre = np.arange(len(nodes))
        start, end = np.concatenate([u, v]), np.concatenate([v, u])
        while True:
            order = np.argsort(lead[start], kind="stable")  # the largest lead is written last
            reach, by = np.full(len(nodes), -np.inf), np.zeros(len(nodes), int)
            reach[end[order]], by[end[order]] = lead[start[order]] - 1, centre[start[order]]
            better = reach > lead
            if not better.any():
                break
            lead[better], centre[better] = reach[better], by[better]
        at = centre[at]
        u, v = centre[u], centre[v]
        u, v = u[u != v], v[u != v]
    return pd.DataFrame({"a": nodes, "centre": nodes[at]})


def groups(links: DataFrame, i: str, j: str, beta: float = BETA, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """``node, group``: each linked node with the smallest node of its component."""
    scratch = Scratch(links.sparkSession, "linkage")
    ends = links.filter(F.col(i).isNotNull() & F.col(j).isNotNull() & (F.col(i) != F.col(j)))
    edges = scratch.put(ends.select(F.least(i, j).alias("a"), F.greatest(i, j).alias("b")).distinct())
    maps: list[tuple[DataFrame, DataFrame, int]] = []
    while left := edges.count():
        level = len(maps)
        if left <= local_edges:
            solve = lambda pdf: _local(pdf, level, beta)  # noqa: B023, E731
            whole = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).withColumn("all", F.lit(0)).groupBy("all")
            at = scratch.put(whole.applyInPandas(solve, "a long, centre long"))
        else:
            at = _grown(edges, level, beta, scratch)
        # Of the smallest node below each vertex, the smallest names the cluster.
        least = at.withColumn("low", F.col("a")) if not maps else at.join(maps[-1][1].select(F.col("centre").alias("a"), "low"), "a")
        sized = scratch.put(least.groupBy("centre").agg(F.min("low").alias("low"), F.count("*").alias("size")))
        maps.append((at, sized, at.count()))
        if left <= local_edges:
            break
        one = edges.join(at.withColumnRenamed("centre", "ca"), "a")
        two = one.join(at.select(F.col("a").alias("b"), F.col("centre").alias("cb")), "b").filter("ca <> cb")
        nxt = scratch.put(two.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct())
        scratch.drop(edges)
        edges = nxt
    if not maps:
        return links.select(F.col(i).alias("node"), F.col(i).alias("group")).limit(0)
    # From the last level down: the vertices of a level are the clusters of the one below.
    above = None
    for at, sized, n in reversed(maps):
        named = sized.select("centre", F.col("low").alias("group"), "size")
        if above is not None:
            named = sized.join(above.select(F.col("a").alias("centre"), F.col("group").alias("far")), "centre", "left")
            named = named.select("centre", F.coalesce("far", "low").alias("group"), "size")
        above = join_sized(at, scratch.put(named), ["centre"], "size", n).select("a", "group")
    return above.select(F.col("a").alias("node"), "group")
