"""The series store: frames as rows of Parquet, a folder per batch and institution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FRAMES = "institution string, mrn string, accession string, series string, frame_idx int, h int, w int, dtype string, pixels binary"
SERIES = "institution string, mrn string, accession string, series string, total_images int, n_frames int, slice_frames array<int>, vmin double, vmax double"
KEY = ["institution", "mrn", "accession", "series"]


def read_frames(spark: SparkSession, path: str, prefix: str | None = None) -> DataFrame:
    """All frames; a prefix selects the partitions of matching institutions."""
    df = spark.read.schema(FRAMES + ", batch string").parquet(f"{path}/frames").drop("batch")
    return df.where(F.col("institution").startswith(prefix)) if prefix else df


def read_series(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SERIES + ", batch string").parquet(f"{path}/series").drop("batch")


def relpath() -> Column:
    return F.concat(F.col("institution"), F.lit("_"), F.col("mrn"), F.lit("/"), F.col("accession"), F.lit(".h5"))


def catalog(series: DataFrame) -> DataFrame:
    """(relpath, series): one row per stored series, in order."""
    return series.select(relpath().alias("relpath"), "series").distinct().orderBy("relpath", "series")


def one_frame(frames: DataFrame, index: int) -> DataFrame:
    """A single plane of each series; the index reaches the Parquet row groups."""
    return frames.where(F.col("frame_idx") == index)
