"""Comparing what should be there with what is: manifests, safelists, completeness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compare_manifests(old: DataFrame, new: DataFrame, key: str = "file", value: str = "checksum", missing: bool = True) -> DataFrame:
    """(key, old, new, status): ``changed`` files, and with ``missing`` also ``removed`` and ``added`` ones.

    Without ``missing`` it is the compatible inner comparison, which passes over files on one side only.
    NULL values equal each other.
    """
    a = old.select(F.col(key), F.col(value).alias("old"), F.lit(True).alias("in_old"))
    b = new.select(F.col(key), F.col(value).alias("new"), F.lit(True).alias("in_new"))
    joined = a.join(b, key, "full_outer" if missing else "inner")
    status = (
        F.when(F.col("in_old").isNull(), "added").when(F.col("in_new").isNull(), "removed")
        .when(~F.col("old").eqNullSafe(F.col("new")), "changed")
    )
    return joined.withColumn("status", status).where("status is not null").select(key, "old", "new", "status")


def safelisted(files: DataFrame, safelist: DataFrame, key: str, listed: str = "filenames") -> DataFrame:
    """Distinct files that the safelist names."""
    return files.select(key).distinct().join(safelist.select(F.col(listed).alias(key)), key, "left_semi")


def incomplete(inputs: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    """Distinct inputs without an output."""
    return inputs.select(key).distinct().join(outputs.select(key), key, "left_anti")


def audit_counts(inputs: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    """One row: n_inputs, n_processed (not distinct, as reported), n_incomplete."""
    names = ("n_inputs", "n_processed", "n_incomplete")
    parts = (inputs.agg(F.countDistinct(key).alias("n")), outputs.agg(F.count(F.lit(1)).alias("n")), incomplete(inputs, outputs, key).agg(F.count(F.lit(1)).alias("n")))
    rows = None
    for i, part in enumerate(parts):
        row = part.select(*[(F.col("n") if i == j else F.lit(0).cast("bigint")).alias(c) for j, c in enumerate(names)])
        rows = row if rows is None else rows.union(row)
    return rows.agg(*[F.sum(c).alias(c) for c in names])


def union_manifests(parts: list[DataFrame]) -> DataFrame:
    """Bag union over the union of columns."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
