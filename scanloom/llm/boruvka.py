"""Consolidating pairwise matches into groups: deterministic Boruvka hooking.

Every component selects its smallest outgoing edge. As the order of edges is total and the same seen
from both ends, the selected edges form trees with exactly one mutual pair each; the smaller end of
that pair becomes the root. Trees collapse by pointer jumping, the remaining edges take the labels of
their components and repeated ones drop out, until no edge is left. Components at least halve in each
round, so rounds grow with the logarithm of the largest group, also for long chains and stars. The rounds
are those of ``operators.components``, which the duplicate report of the core uses too.

Defined results: edges with a NULL end are ignored; a self edge makes its node a group of its own;
repeated and reversed edges count once; no edges give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import labels, ordered_ids
from ..session import cut


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node of its group."""
    return labels(edges, a, b).withColumnRenamed("label", "component")


def clean_source(text):
    return F.lower(F.trim(text))


def clean_path(text):
    """Without leading ``./`` and with single slashes."""
    return F.regexp_replace(F.regexp_replace(text, "/+", "/"), r"^(\./)+", "")


def match_groups(matches: DataFrame) -> DataFrame:
    """(source, relpath, group_source, group_relpath) of every file in a match with both files known.

    A file is (source, path); a match is ignored when a path, or the source of one, is NULL.
    """
    pairs = matches.select(
        clean_source(F.col("source_a")).alias("sa"), clean_path(F.col("file_a")).alias("fa"),
        clean_source(F.col("source_b")).alias("sb"), clean_path(F.col("file_b")).alias("fb"),
    ).where("sa is not null and fa is not null and sb is not null and fb is not null").distinct()
    pairs = cut(pairs)
    files = ordered_ids(
        pairs.select(F.col("sa").alias("source"), F.col("fa").alias("relpath")).union(pairs.select("sb", "fb")), ["source", "relpath"]
    )
    ea = files.select(F.col("source").alias("sa"), F.col("relpath").alias("fa"), F.col("nid").alias("a"))
    eb = files.select(F.col("source").alias("sb"), F.col("relpath").alias("fb"), F.col("nid").alias("b"))
    groups = components(pairs.join(ea, ["sa", "fa"]).join(eb, ["sb", "fb"]).select("a", "b"))
    names = files.select(F.col("nid").alias("component"), F.col("source").alias("group_source"), F.col("relpath").alias("group_relpath"))
    return (
        files.join(groups.withColumnRenamed("node", "nid"), "nid").join(names, "component")
        .select("source", "relpath", "group_source", "group_relpath")
    )
