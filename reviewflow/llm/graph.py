"""Connected components of a link table, by contraction over staged tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from reviewflow.llm.common import stage

MAX_ROUNDS = 200


def _staged_count(df: DataFrame, count: Column, name: str) -> tuple[DataFrame, int]:
    """Staged ``df`` and a sum over its rows, observed on the write."""
    seen = Observation()
    out = stage(df.observe(seen, F.sum(count.cast("long")).alias("n")), name)
    return out, seen.get.get("n") or 0


def _roots(edges: DataFrame, name: str) -> DataFrame:
    """(node, root): every node's smallest neighbour or itself, followed down until nothing changes."""
    ends = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # the minimum is combined before the shuffle, so a node that a large part of all links touch is one row per task
    roots = stage(ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root")),
                  f"{name}-lowest")
    for k in range(MAX_ROUNDS):
        below = roots.select(F.col("node").alias("root"), F.col("root").alias("next"))
        roots, moved = _staged_count(roots.join(below, "root").select("node", F.col("next").alias("root"), (F.col("next") < F.col("root")).alias("moved")),
                                     F.col("moved"), f"{name}-jump{k}")
        roots = roots.drop("moved")
        if not moved:
            return roots
    raise RuntimeError(f"no roots after {MAX_ROUNDS} rounds")


def components(edges: DataFrame, name: str = "links") -> DataFrame:
    """(node, label): the smallest node reachable, for every node in ``edges`` (a, b).

    Each round hangs every node under its smallest neighbour, follows these
    pointers to their roots by doubling, and contracts the links to links
    between roots.  A dense group falls to one node in the first round, so
    its links are read once; rounds and doublings are logarithmic in the
    nodes.  All joins read staged tables, which lets AQE split a node with a
    large part of all links.  No links: an empty table.
    """
    pair = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    edges = stage(edges.where("a <> b").select(*pair).distinct(), f"{name}-edges")
    labels = None
    for k in range(MAX_ROUNDS):
        roots = _roots(edges, f"{name}-{k}")
        if labels is None:
            labels = roots.withColumnRenamed("root", "label")
        else:
            moved = roots.select(F.col("node").alias("label"), F.col("root").alias("lower"))
            labels = stage(labels.join(moved, "label", "left").select("node", F.coalesce("lower", "label").alias("label")), f"{name}-labels{k}")
        left = (edges.join(roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
                .join(roots.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b").where("ra <> rb")
                .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
        edges, n = _staged_count(left, F.lit(1), f"{name}-contracted{k}")
        if not n:
            return labels
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
