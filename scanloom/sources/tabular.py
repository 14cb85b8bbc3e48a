"""Delimited tables with text columns: ids keep their leading zeros, and the words for missing are NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Tokens that table tools read as missing.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
MANIFEST_DEFAULTS = {"source": None, "relpath": "", "mrn": "", "accession": "", "series": "", "frame_pos": "", "n_frames": 0, "fp_hex": ""}


def read_csv(spark: SparkSession, path: str, missing: tuple[str, ...] = MISSING, sep: str = ",") -> DataFrame:
    """A table with a header, all columns text, missing tokens NULL; byte order marks and CRLF are fine."""
    raw = spark.read.csv(path, header=True, sep=sep, inferSchema=False, multiLine=True, escape='"')
    cols = [c.lstrip("﻿") for c in raw.columns]
    raw = raw.toDF(*cols)
    return raw.select(*[F.when(~F.col(f"`{c}`").isin(*missing), F.col(f"`{c}`")).alias(c) for c in cols])


ROW = "__row"


def numbered_csv(spark: SparkSession, path: str) -> DataFrame:
    """``read_csv`` with the place of each row, so that the first of several can be told."""
    return read_csv(spark, path).withColumn(ROW, F.monotonically_increasing_id())


def read_bulk(spark: SparkSession, path: str) -> DataFrame:
    """A bulk list: blank-separated, without header."""
    return spark.read.csv(path, sep=" ", schema="eid string, data_item string")


def read_safelist(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path).select("filenames").where("filenames is not null").distinct()


def load_manifest(df: DataFrame, label: str) -> DataFrame:
    """A fingerprint manifest in the fixed columns; absent ones get their defaults, an absent source the label."""
    out = []
    for c, default in MANIFEST_DEFAULTS.items():
        kind = "int" if c == "n_frames" else "string"
        out.append((F.col(c) if c in df.columns else F.lit(label if c == "source" else default)).cast(kind).alias(c))
    return df.select(*out)


def write_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """A folder of files with headers, a file per partition; one file, written by one task, on request only."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
