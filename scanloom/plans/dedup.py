"""Fingerprints of stored series and the duplicate report over manifests."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bits, pixels
from ..operators import hamming_join, ordering, rollup
from ..session import stored
from ..sources.store import KEY, relpath


def fingerprint_manifest(frames: DataFrame, series: DataFrame, label: str, positions: tuple[str, ...] = ordering.POSITIONS) -> DataFrame:
    """The manifest of a store: first, middle and last frame of each series with their codes.

    Which frames are wanted is known from the series' frame counts, so only those planes are read. Planes
    without contrast have an empty code.
    """
    wanted = ordering.check_positions(positions)
    at = {"first": F.lit(0), "middle": F.floor(F.col("n_frames") / 2), "last": F.col("n_frames") - 1}
    picks = F.array(*[F.struct(F.lit(i).alias("o"), F.lit(p).alias("frame_pos"), at[p].cast("int").alias("frame_idx")) for i, p in enumerate(wanted)])
    chosen = series.select(*KEY, "n_frames", F.explode(picks).alias("p")).select(*KEY, "n_frames", "p.*")
    chosen = chosen.groupBy(*KEY, "n_frames", "frame_idx").agg(F.min(F.struct("o", "frame_pos")).alias("p")).select(*KEY, "n_frames", "frame_idx", "p.frame_pos")
    rows = frames.join(chosen, [*KEY, "frame_idx"]).select(
        F.lit(label).alias("source"), relpath().alias("relpath"), "mrn", "accession", "series", "frame_pos", "n_frames", "h", "w", "dtype", "pixels"
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            codes = []
            for p, h, w, t in zip(b["pixels"], b["h"], b["w"], b["dtype"]):
                code = pixels.fingerprint(np.frombuffer(p, "<f4" if t == "f4" else "u1").reshape(int(h), int(w)))
                codes.append(code.hex() if code else "")
            yield b.drop(columns=["h", "w", "dtype", "pixels"]).assign(fp_hex=codes)

    return rows.mapInPandas(run, "source string, relpath string, mrn string, accession string, series string, frame_pos string, n_frames int, fp_hex string")


def report(manifest: DataFrame, reference: DataFrame | None = None, threshold: float = 99.0, min_series: int = rollup.MIN_SERIES, max_bucket: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(duplicate manifest, flagged files) of a manifest, also against reference manifests.

    With a reference only pairs with a file of the scanned sources are reported. Codes of another width
    are an error.
    """
    new_sources = None
    rows = manifest.select(*rollup.MANIFEST)
    if reference is not None:
        new_sources = manifest.select("source")
        rows = rows.union(reference.select(*rollup.MANIFEST))
    hamming_join.guard_width(rows)
    valid = hamming_join.valid_codes(rows).withColumn("row_id", F.monotonically_increasing_id())
    valid = stored(valid, "valid")
    codes = valid.groupBy("fp_hex").agg(F.min("row_id").alias("cid"))
    named = stored(valid.join(codes, "fp_hex").select("cid", "source", "relpath", "series"), "named")
    near = hamming_join.near_codes(valid, "row_id", "fp_hex", bits.allowed_bits(threshold), max_bucket)
    pairs = rollup.file_pairs(rollup.frame_pairs(named, near), named, min_series, new_sources)
    duplicates, flagged = rollup.clustered(pairs)
    return rollup.report_order(duplicates), rollup.flagged_order(flagged)


def skipped(manifest: DataFrame, max_bucket: int, threshold: float = 99.0) -> DataFrame:
    """(unit, status, detail): the buckets that a report with a bucket limit leaves out."""
    valid = hamming_join.valid_codes(manifest.select(*rollup.MANIFEST)).withColumn("row_id", F.monotonically_increasing_id())
    return hamming_join.skipped_buckets(stored(valid, "valid"), "row_id", "fp_hex", bits.allowed_bits(threshold), max_bucket)
