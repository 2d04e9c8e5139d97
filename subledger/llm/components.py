"""Connected components by hooking and contraction, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subledger.session import shared_dir


def _jumped(parents: DataFrame) -> DataFrame:
    """Each node's grandparent; the root of a tree is its own parent."""
    above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("further"))
    return parents.join(above, "parent").select("node", F.col("further").alias("parent"))


def _renamed(edges: DataFrame, parents: DataFrame) -> DataFrame:
    """Edges between the new names of their ends."""
    a = parents.select(F.col("node").alias("a"), F.col("parent").alias("ra"))
    b = parents.select(F.col("node").alias("b"), F.col("parent").alias("rb"))
    return edges.join(a, "a").join(b, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))


def _one_way(edges: DataFrame) -> DataFrame:
    least, most = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    return edges.where("a <> b").select(least, most).distinct().checkpoint()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, label)`` of all nodes of an undirected graph; the label is one
    node of the component, the same one for all.

    In each round every node hooks onto its least neighbour, in the order of a
    hash, and takes the name of an ancestor in the tree that this makes; edges
    between new names are the next round's graph, a fraction of this one.
    Lineage is cut in the shared folder; the driver learns only whether a table
    is empty. Null ends and loops are left out, repeated edges count once.
    """
    shared_dir(edges.sparkSession)
    left = _one_way(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a IS NOT NULL AND b IS NOT NULL"))
    labels = None
    while True:
        both = left.union(left.select("b", "a"))
        place = [F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("n")) for c in ("a", "b")]
        near = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min(place[1]), F.min(place[0]))["n"].alias("parent"))
        parents = _jumped(_jumped(near)).checkpoint()
        if labels is None:
            labels = parents.withColumnRenamed("parent", "label")
        else:
            further = parents.select(F.col("node").alias("label"), "parent")
            labels = labels.join(further, "label", "left").select("node", F.coalesce("parent", "label").alias("label"))
            labels = labels.checkpoint()
        left = _one_way(_renamed(left, parents))
        if left.isEmpty():
            return labels
