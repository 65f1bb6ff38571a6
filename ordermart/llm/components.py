"""Connected components by repeated contraction.

Each round gives every node the neighbour (or itself) of the smallest
per-round hash as parent, then contracts the edges along it.  Random
priorities shrink any graph - long paths and large stars alike - by a constant
share per round, so the rounds grow with the logarithm of the largest
component.  Minima are pre-aggregated before the shuffle, and both inputs of
every join are plain scans, so the planner can split a hot node's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ordermart.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edge table (a, b).

    Two nodes share a root exactly when a path joins them; the root is some
    node of the component.  Null ends and self loops are ignored; an empty
    edge table gives an empty result.  Repeated and reversed edges are fine.
    """
    edges = stored(_tidy(edges.select("a", "b")), "edges")
    labels = None
    turn = 0
    while True:
        parents = stored(_parents(edges, turn), "parents")
        if labels is None:
            labels = parents.select("node", F.col("parent").alias("root"))
        else:
            step = parents.select(F.col("node").alias("root"), "parent")
            labels = (labels.join(step, "root", "left")
                      .select("node", F.coalesce("parent", "root").alias("root")))
        edges = stored(_contract(edges, parents), "edges")
        if edges.isEmpty():
            return stored(labels, "labels")
        turn += 1


def _tidy(edges: DataFrame) -> DataFrame:
    return (edges.where("a <> b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .distinct())


def _parents(edges: DataFrame, turn: int) -> DataFrame:
    rank = F.xxhash64("other", F.lit(turn))
    own = F.xxhash64("node", F.lit(turn))
    ends = (edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
            .unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other"))))
    best = ends.groupBy("node").agg(F.min(rank).alias("low"), F.min_by("other", rank).alias("other"))
    return best.select("node", F.when(own <= F.col("low"), F.col("node"))
                       .otherwise(F.col("other")).alias("parent"))


def _contract(edges: DataFrame, parents: DataFrame) -> DataFrame:
    pa = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
    pb = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
    return _tidy(edges.join(pa, "a").join(pb, "b")
                 .select(F.col("pa").alias("a"), F.col("pb").alias("b")))
