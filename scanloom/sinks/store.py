"""Writers: the series store, outcome logs, verified copies and exports."""

from __future__ import annotations

import os
import shutil
import subprocess
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import pixels
from ..session import cut_counted
from ..sources import files
from ..sources.store import KEY, read_series

OUTCOMES = "unit string, status string, detail string"


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def batch_name(series: DataFrame, order: str = "archive") -> str:
    """A name for what a run brings: the same archives with the same series have the same name."""
    seen = series.select(*KEY, order).distinct().agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*KEY, order)).alias("x")).first()
    return f"{seen['n']}-{(seen['x'] or 0) & (1 << 64) - 1:016x}"


def write_store(frames: DataFrame, series: DataFrame, path: str, order: str = "archive", batch: str | None = None) -> DataFrame:
    """Adds series to a store; the first writer of a key wins. Returns outcomes (unit, status, detail).

    A key that the store already has, or that an earlier archive of the same run has, is
    ``already_exists``. Each batch has folders of its own, named by its content unless named here. Its
    series are written last and make it complete: a batch that failed before leaves nothing that counts,
    and overwrites its folders when it runs again.
    """
    spark = series.sparkSession
    batch = batch or batch_name(series, order)
    w = Window.partitionBy(*KEY).orderBy(order)
    ranked = series.withColumn("__rn", F.row_number().over(w))
    if _exists(spark, f"{path}/series"):
        have = read_series(spark, path).select(*KEY).distinct().withColumn("__have", F.lit(True))
    else:
        have = spark.createDataFrame([], ", ".join(f"{k} string" for k in KEY) + ", __have boolean")
    judged, stale = cut_counted(ranked.join(have, KEY, "left").withColumn("fresh", (F.col("__rn") == 1) & F.col("__have").isNull()), ~F.col("fresh"))
    fresh = judged.where("fresh").drop("__rn", "__have", "fresh")
    if not _exists(spark, f"{path}/series/batch={batch}"):
        def write(rows: DataFrame, name: str) -> None:
            rows.write.mode("overwrite").partitionBy("institution").option("compression", "zstd").parquet(f"{path}/{name}/batch={batch}")

        # frames are only joined, and then shuffled, where some of them must not be written
        kept = frames.join(fresh.select(*KEY, order), [*KEY, order], "left_semi") if stale else frames
        write(kept.drop(order), "frames")
        write(fresh.drop(order), "series")
    unit = F.concat_ws("/", *KEY)
    return judged.select(unit.alias("unit"), F.when(F.col("fresh"), "written").otherwise("already_exists").alias("status"), F.col(order).alias("detail"))


def append_outcomes(outcomes: DataFrame, path: str) -> None:
    outcomes.select("unit", "status", "detail").write.mode("append").parquet(path)


def copy_verified(resolved: DataFrame, source: str, target: str) -> DataFrame:
    """(row_id, status, target): copies found files under their new names and compares digests.

    ``resolved`` has row_id, status, relpath and new_path; source and target are paths or URIs. Copies go
    to a temporary name first, so a task that runs twice leaves whole files only. Rows that are not ``found`` keep their status.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                status, to = r.status, None
                if status == "found":
                    to = f"{target.rstrip('/')}/{r.new_path}"
                    try:
                        status = "copied" if files.copy(f"{source.rstrip('/')}/{r.relpath}", to) else "checksum_fail"
                    except FileNotFoundError:
                        status = "not_found"
                    except OSError:
                        status = "error"
                out.append((r.row_id, status, to))
            yield pd.DataFrame(out, columns=["row_id", "status", "target"])

    return resolved.select("row_id", "status", "relpath", "new_path").mapInPandas(run, "row_id bigint, status string, target string")


def export_video(frames: DataFrame, target: str, fps: int = 24, ffmpeg: str = "ffmpeg", series: DataFrame | None = None) -> DataFrame:
    """(unit, status, detail): one MP4 per series, through ffmpeg where it is installed.

    Frames arrive sorted and are piped one by one. Planes that are not 8 bits are scaled by the bounds of
    their series where ``series`` has them, else by their own. Without ffmpeg the status is ``error``.
    """
    bounds = series.select(*KEY, "vmin", "vmax") if series is not None else None
    rows = frames.join(bounds, KEY, "left") if bounds is not None else frames.withColumns({"vmin": F.lit(None).cast("double"), "vmax": F.lit(None).cast("double")})
    sorted_ = rows.select(*KEY, "frame_idx", "h", "w", "dtype", "pixels", "vmin", "vmax").repartition(*KEY).sortWithinPartitions(*KEY, "frame_idx")

    def grey(data: bytes, dtype: str, low: float, high: float) -> bytes:
        known = low == low and low is not None
        return data if dtype == "u1" else pixels.to_u8(np.frombuffer(data, "<f4"), low if known else None, high if known else None).tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, pipe = None, None

        def close() -> pd.DataFrame:
            status = "error"
            if pipe is not None:
                pipe.stdin.close()
                status = "written" if pipe.wait() == 0 else "error"
            return pd.DataFrame([("/".join(map(str, now)), status, target)], columns=["unit", "status", "detail"])

        for batch in batches:
            for r in batch.itertuples(index=False, name=None):
                if r[:4] != now:
                    if now is not None:
                        yield close()
                    now, pipe = r[:4], None
                    if shutil.which(ffmpeg):
                        os.makedirs(target, exist_ok=True)
                        name = os.path.join(target, "_".join(map(str, now)) + ".mp4")
                        pipe = subprocess.Popen(
                            [ffmpeg, "-y", "-loglevel", "error", "-f", "rawvideo", "-pix_fmt", "gray", "-s", f"{r[6]}x{r[5]}", "-r", str(fps), "-i", "-", "-pix_fmt", "yuv420p", name], stdin=subprocess.PIPE
                        )
                if pipe is not None:
                    pipe.stdin.write(grey(r[8], r[7], r[9], r[10]))
        if now is not None:
            yield close()

    return sorted_.mapInPandas(run, OUTCOMES)


def notify(summary: dict, hook: Callable[[dict], None] | None) -> bool:
    """Hands a run's summary to a callback; its failure never stops the run."""
    if hook is None:
        return False
    try:
        hook(summary)
        return True
    except Exception:
        return False
