"""Metadata catalogues: projections by tag, frequencies, summaries, plans and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REQUIRED = {"mrn": "PatientID", "accession": "AccessionNumber"}
OPTIONAL = {"series_description": "SeriesDescription", "frame_loc": "SliceLocation", "scanner": "ManufacturerModelName", "field_strength": "MagneticFieldStrength"}
CHUNK = 1000


def tag_columns(options: list[str] | None) -> dict[str, str]:
    """Column to tag: the two ids, then the ``column:Tag`` options, which replace the default ones."""
    if not options:
        return REQUIRED | OPTIONAL
    pairs = [o.split(":") for o in options]
    if any(len(p) != 2 or not all(p) for p in pairs):
        raise ValueError("a field option is column:Tag")
    return REQUIRED | {c: t for c, t in pairs if c not in REQUIRED}


def project_tags(headers: DataFrame, options: list[str] | None = None) -> DataFrame:
    """The catalogue columns as text; tags that the headers lack are NULL."""
    wanted = tag_columns(options)
    return headers.select(*[(F.col(f"`{t}`") if t in headers.columns else F.lit(None)).cast("string").alias(c) for c, t in wanted.items()])


def first_of_study(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per study: its first by the order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def frequency(df: DataFrame, column: str, nulls: bool = False) -> DataFrame:
    """(column, frequency), most frequent first, ties by value; NULL counts only if asked for."""
    rows = df if nulls else df.where(F.col(column).isNotNull())
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("frequency")).orderBy(F.desc("frequency"), F.asc_nulls_first(column))


def study_summary(df: DataFrame, institution: str, order: list[Column]) -> DataFrame:
    """(institution, parent_folder, accession): one row per accession, its first."""
    return first_of_study(df, ["accession"], order).select(F.lit(institution).alias("institution"), F.col("mrn").alias("parent_folder"), "accession")


def chunk_plan(n: Column, size: int = CHUNK) -> Column:
    """array of the 1-based first rows of chunks over n rows; empty for none."""
    return F.when(n >= 1, F.sequence(F.lit(1).cast("bigint"), n.cast("bigint"), F.lit(size).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))


def video_counts(series: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n_boundaries, n_slices, n_frames): both ways to count the videos of a file.

    n_boundaries counts a series without boundaries as one and others by their boundaries; n_slices is
    one more than the boundaries.
    """
    n = F.size("slice_frames")
    return series.groupBy(*keys).agg(
        F.sum(F.greatest(n, F.lit(1))).alias("n_boundaries"), F.sum(n + 1).alias("n_slices"), F.sum("n_frames").alias("n_frames")
    )


def sample_rows(df: DataFrame, k: int, key: Column, seed: int = 0) -> DataFrame:
    """k rows in a seeded random order that repeats: by hash of the key."""
    return df.orderBy(F.xxhash64(F.lit(seed), key), key).limit(k)


def top_rows(df: DataFrame, order: list[Column], k: int = 10) -> DataFrame:
    return df.orderBy(*order).limit(k)
