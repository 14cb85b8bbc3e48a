"""Connected components of an undirected graph by Boruvka hooking and contraction.

Every component selects its smallest outgoing edge. As the order of edges is total and the same seen
from both ends, the selected edges form trees with exactly one mutual pair each; the smaller end of
that pair becomes the root. Trees collapse by pointer jumping, edges take the labels of their ends'
trees, and repeated and inner ones drop out, so finished components leave and components at least halve
in each round. What each round merged is put together at the end, from the smallest table back.

Defined results: edges with a NULL end are ignored; a self edge makes its node a component of its own;
repeated and reversed edges count once; no edges give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, cut_counted
from .ordering import places


#: Pointers that are followed before a table is written.
HOPS = 4


def _selected(edges: DataFrame) -> DataFrame:
    """(v, p): for each component the other end of its smallest edge; edges (a, b) have a < b.

    The order of edges is (a, b) itself, and the smallest edge of v in it is the one to v's smallest
    neighbour. A hub is combined on the map side, so it never meets in one task.
    """
    both = edges.select(F.col("a").alias("v"), F.col("b").alias("w")).union(edges.select("b", "a"))
    return both.groupBy("v").agg(F.min("w").alias("p"))


def _roots(parents: DataFrame) -> DataFrame:
    """(v, p) with p the root of v's tree: breaks mutual pairs, then follows ``HOPS`` pointers at a time, and theirs."""
    other = parents.select(F.col("v").alias("p"), F.col("p").alias("pp"))
    tree = cut(
        parents.join(other, "p").select(
            "v", F.when((F.col("pp") == F.col("v")) & (F.col("v") < F.col("p")), F.col("v")).otherwise(F.col("p")).alias("p")
        )
    )
    moved = 1
    while moved:
        far = tree.select("v", F.col("p").alias("first"), F.col("p").alias("h0"))
        for i in range(HOPS):
            far = far.join(tree.select(F.col("v").alias(f"h{i}"), F.col("p").alias(f"h{i + 1}")), f"h{i}").drop(f"h{i}")
        far = far.select("v", F.col(f"h{HOPS}").alias("p"), (F.col(f"h{HOPS}") != F.col("first")).alias("moved"))
        tree, moved = cut_counted(far, F.col("moved"), drop=(tree,))
    return tree.select("v", "p")


def labels(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of an edge; label is the smallest node of its component."""
    raw = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    raw = cut(raw.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    nodes = raw.select(F.col("a").alias("node")).union(raw.select("b")).distinct()
    live, n = raw.where("a <> b"), 1
    merged: list[DataFrame] = []
    while n:
        if not merged and not live.head(1):
            break
        roots = _roots(_selected(live))
        merged.append(roots)
        nxt = (
            live.join(roots.select(F.col("v").alias("a"), F.col("p").alias("ra")), "a")
            .join(roots.select(F.col("v").alias("b"), F.col("p").alias("rb")), "b")
            .where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        )
        live, n = cut_counted(nxt, F.lit(True), drop=(live,) if len(merged) > 1 else ())
    if not merged:
        return nodes.withColumn("label", F.col("node"))
    whole = merged[-1]
    for step in reversed(merged[:-1]):
        last = whole.select(F.col("v").alias("p"), F.col("p").alias("top"))
        whole = step.join(last, "p", "left").select("v", F.coalesce("top", "p").alias("p"))
    top = nodes.join(whole.withColumnRenamed("v", "node"), "node", "left").select("node", F.coalesce("p", "node").alias("c"))
    top = cut(top)
    smallest = top.groupBy("c").agg(F.min("node").alias("label"))
    return top.join(smallest, "c").select("node", "label")


def ordered_ids(keys: DataFrame, by: list[str], id_col: str = "nid") -> DataFrame:
    """Distinct ``keys`` with a long id in the order of ``by`` (code points for text).

    Rows are range-partitioned and sorted, and an id is partition number and position: no task sees
    more than its range. Cut at once, as ids of a recomputed plan could differ.
    """
    return cut(keys.distinct().orderBy(*by).withColumn(id_col, F.monotonically_increasing_id()))


def components(edges: DataFrame) -> DataFrame:
    """(node, cluster_id): ids 1.. in the order of each component's smallest node.

    Nodes of any type become longs in their order first. The ids are the places of labels.
    """
    known = cut(edges.select("a", "b").where("a is not null and b is not null").distinct())
    nodes = ordered_ids(known.select(F.col("a").alias("node")).union(known.select("b")), ["node"])
    ends = known.join(nodes.select(F.col("node").alias("a"), F.col("nid").alias("ia")), "a").join(nodes.select(F.col("node").alias("b"), F.col("nid").alias("ib")), "b")
    found = cut(labels(ends, "ia", "ib").withColumnRenamed("node", "nid"))
    ids = places(found.select("label").distinct(), [F.col("label")], "cluster_id")
    return nodes.join(found, "nid").join(ids, "label").select("node", "cluster_id")
