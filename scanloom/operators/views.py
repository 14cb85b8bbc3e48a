"""Series to canonical views, by a map of series descriptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def map_views(series: DataFrame, view_map: DataFrame, raw: str, keys: list[str], order: list[Column], views: list[str] | None = None, first_only: bool = True) -> DataFrame:
    """The series with their ``view``; of several series of one view the first of the map's order, unless all are wanted.

    ``view_map`` has (raw, view) and one row per raw name; names it lacks or maps to NULL drop out.
    """
    table = view_map.where(F.col("view").isNotNull())
    if views is not None:
        table = table.where(F.col("view").isin(views))
    joined = series.join(table, raw)
    if not first_only:
        return joined
    w = Window.partitionBy(*keys, "view").orderBy(*order)
    return joined.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def view_coverage(mapped: DataFrame, file_key: str) -> DataFrame:
    """(view, n_files): distinct files per view."""
    return mapped.groupBy("view").agg(F.countDistinct(file_key).alias("n_files"))
