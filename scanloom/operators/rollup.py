"""From near-identical frames to file pairs, flagged files and clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .components import components

MIN_SERIES = 5
MANIFEST = ("source", "relpath", "mrn", "accession", "series", "frame_pos", "n_frames", "fp_hex")


def frame_pairs(rows: DataFrame, near: DataFrame) -> DataFrame:
    """Pairs of frames of different files: (source, relpath, series) of both, dist, smaller file first.

    ``rows`` has (cid, source, relpath, series); ``near`` has (a, b, dist) over cids. Frames with one
    code are at distance 0. Equal frames of a file are counted first and their counts multiplied later.
    """
    unit = rows.groupBy("cid", "source", "relpath", "series").agg(F.count(F.lit(1)).alias("k"))
    unit = stored(unit, "frames")
    side = lambda s, c: unit.select(F.col("cid").alias(c), F.struct("source", "relpath").alias(f"f{s}"), F.col("series").alias(f"s{s}"), F.col("k").alias(f"k{s}"))
    across = near.join(side("a", "a"), "a").join(side("b", "b"), "b").drop("a", "b")
    same = side("a", "c").join(side("b", "c"), "c").where("fa < fb").drop("c").withColumn("dist", F.lit(0))
    cols = ["fa", "sa", "ka", "fb", "sb", "kb", "dist"]
    pairs = across.select(*cols).union(same.select(*cols)).where("fa <> fb")
    swap = F.col("fa") > F.col("fb")
    pick = lambda x, y: F.when(swap, F.col(y)).otherwise(F.col(x))
    return pairs.select(
        pick("fa", "fb").alias("file_a"), pick("sa", "sb").alias("series_a"), pick("fb", "fa").alias("file_b"), pick("sb", "sa").alias("series_b"),
        (F.col("ka") * F.col("kb")).alias("frames"), "dist",
    )


def file_pairs(pairs: DataFrame, rows: DataFrame, min_series: int = MIN_SERIES, new_sources: DataFrame | None = None) -> DataFrame:
    """The duplicate manifest: one row per file pair with enough matching series.

    Matching series are counted on the first file. The fraction is over the smaller file, may exceed 1,
    and is rounded half to even. The example is the closest pair of series, ties by name. With a table of
    new sources (source) only pairs with a file of one of them stay.
    """
    if new_sources is not None:
        new = new_sources.select("source").distinct()
        for side in ("a", "b"):
            marked = new.select(F.col("source").alias(f"new_{side}"))
            pairs = pairs.join(marked, F.col(f"file_{side}.source") == F.col(f"new_{side}"), "left")
        pairs = pairs.where("new_a is not null or new_b is not null").drop("new_a", "new_b")
    counts = rows.groupBy(F.struct("source", "relpath").alias("f")).agg(F.countDistinct("series").alias("n"))
    rolled = pairs.groupBy("file_a", "file_b").agg(
        F.countDistinct("series_a").alias("matching_series"), F.sum("frames").alias("matching_frames"),
        F.min(F.struct("dist", "series_a", "series_b")).alias("best"),
    ).where(F.col("matching_series") >= min_series)
    named = rolled.join(counts.select(F.col("f").alias("file_a"), F.col("n").alias("n_series_a")), "file_a").join(counts.select(F.col("f").alias("file_b"), F.col("n").alias("n_series_b")), "file_b")
    fraction = F.bround(F.col("matching_series") / F.greatest(F.least("n_series_a", "n_series_b"), F.lit(1)), 4)
    return named.select(
        "file_a", "file_b", "matching_series", "n_series_a", "n_series_b", fraction.alias("match_fraction"), F.col("best.dist").alias("min_hamming"),
        "matching_frames", F.col("best.series_a").alias("example_series_a"), F.col("best.series_b").alias("example_series_b"),
    )


def clustered(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(duplicate manifest, flagged files) with cluster ids 1.. in the order of their smallest files."""
    pairs = stored(pairs, "pairs")
    label = stored(components(pairs.select(F.col("file_a").alias("a"), F.col("file_b").alias("b"))), "labels")
    both = pairs.select(F.col("file_a").alias("f"), F.col("file_b").alias("g")).union(pairs.select("file_b", "file_a"))
    partners = both.groupBy("f").agg(F.countDistinct("g").alias("n_partners"))
    manifest = pairs.join(label.select(F.col("node").alias("file_a"), "cluster_id"), "file_a").select(
        "cluster_id", F.col("file_a.source").alias("source_a"), F.col("file_a.relpath").alias("file_a"), F.col("file_b.source").alias("source_b"), F.col("file_b.relpath").alias("file_b"),
        "matching_series", "n_series_a", "n_series_b", "match_fraction", "min_hamming", "matching_frames", "example_series_a", "example_series_b",
    )
    flagged = label.join(partners.withColumnRenamed("f", "node"), "node").select(F.col("node.source").alias("source"), F.col("node.relpath").alias("relpath"), "cluster_id", "n_partners")
    return manifest, flagged


def report_order(manifest: DataFrame) -> DataFrame:
    return manifest.orderBy(F.desc("match_fraction"), "min_hamming", "source_a", "file_a", "source_b", "file_b")


def flagged_order(flagged: DataFrame) -> DataFrame:
    return flagged.orderBy("cluster_id", "source", "relpath")
