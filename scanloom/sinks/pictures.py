"""Contact sheets of stored series: chosen frames side by side in one grey PNG."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pixels
from ..sources.files import filesystem, part_name
from ..sources.store import KEY

#: Columns of a sheet, and the cells of the sheet of samples.
COLUMNS, SAMPLES = 10, 90


def png(plane: np.ndarray) -> bytes:
    """An 8-bit grey picture."""
    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    h, w = plane.shape
    lines = np.hstack([np.zeros((h, 1), np.uint8), np.asarray(plane, np.uint8)]).tobytes()
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines, 6)) + chunk(b"IEND", b"")


def sheet(planes: list[np.ndarray], columns: int = COLUMNS) -> np.ndarray:
    """Planes row by row in cells as large as the largest."""
    h, w = max(p.shape[0] for p in planes), max(p.shape[1] for p in planes)
    columns = min(columns, len(planes))
    out = np.zeros((-(-len(planes) // columns) * h, columns * w), np.uint8)
    for i, p in enumerate(planes):
        y, x = i // columns * h, i % columns * w
        out[y : y + p.shape[0], x : x + p.shape[1]] = p
    return out


def with_bounds(frames: DataFrame, series: DataFrame) -> DataFrame:
    return frames.join(series.select(*KEY, "vmin", "vmax"), KEY)


def export_sheets(frames: DataFrame, target: str, by: list[str], columns: int = COLUMNS) -> DataFrame:
    """(unit, status, detail): a PNG per group ``by`` of its frames in order, at ``target``, a path or URI.

    ``frames`` are chosen ones with the bounds of their series; a group's sheet is made by one task. Planes
    that are not 8 bits are scaled by the bounds.
    """
    chosen = frames.select(*KEY, "frame_idx", "h", "w", "dtype", "pixels", "vmin", "vmax", *[c for c in by if c not in KEY])

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        unit = "_".join(str(k).replace("/", "_") for k in key)
        planes = []
        for r in rows.sort_values([*KEY, "frame_idx"], kind="stable").itertuples():
            plane = np.frombuffer(r.pixels, "u1" if r.dtype == "u1" else "<f4").reshape(int(r.h), int(r.w))
            planes.append(plane if r.dtype == "u1" else pixels.to_u8(plane, r.vmin, r.vmax))
        system, root = filesystem(target)
        try:
            system.create_dir(root, recursive=True)
            part = part_name(f"{root}/{unit}.png")
            with system.open_output_stream(part) as f:
                f.write(png(sheet(planes, columns)))
            system.move(part, f"{root}/{unit}.png")
            status = "written"
        except OSError:
            status = "error"
        return pd.DataFrame([(unit, status, str(len(planes)))], columns=["unit", "status", "detail"])

    return chosen.groupBy(*by).applyInPandas(run, "unit string, status string, detail string")


def pictures(frames: DataFrame, series: DataFrame, target: str, mode: str, step: int = 1, seed: int = 0, columns: int = COLUMNS) -> DataFrame:
    """Sheets in a mode: ``sequence`` every step-th frame of each series, ``slices`` the frame at every step-th slice
    boundary, ``grid`` the middle frame of up to ``SAMPLES`` series drawn at random, in one sheet."""
    from ..operators import ordering

    step = max(step, 1)
    if mode == "sequence":
        return export_sheets(with_bounds(ordering.strided(frames, F.col("frame_idx"), step), series), target, KEY, columns)
    if mode == "slices":
        at = ordering.boundary_frames(series, step).select(*KEY, "frame_idx")
        return export_sheets(with_bounds(frames.join(at, [*KEY, "frame_idx"]), series), target, KEY, columns)
    if mode != "grid":
        raise ValueError("mode is sequence, slices or grid")
    drawn = series.orderBy(F.xxhash64(F.lit(seed), *KEY), *KEY).limit(SAMPLES)
    at = drawn.select(*KEY, F.floor(F.col("n_frames") / 2).cast("int").alias("frame_idx"))
    chosen = with_bounds(frames.join(at, [*KEY, "frame_idx"]), drawn).withColumn("sheet", F.lit("grid"))
    return export_sheets(chosen, target, ["sheet"], columns)
