"""Stores of HDF5 files, where the h5py package is installed on the executors: their series as rows of the store, and back.

A file ``institution_mrn/accession.h5`` has a dataset per series, frames first, with the attributes
``slice_frames`` and ``total_images``.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pixels
from .archives import batched, spark_schema
from .files import filesystem, part_name

_KEY = [(c, pa.string()) for c in ("institution", "mrn", "accession", "series")]
FRAMES = pa.schema([*_KEY, ("frame_idx", pa.int32()), ("h", pa.int32()), ("w", pa.int32()), ("dtype", pa.string()), ("pixels", pa.binary())])
SERIES = pa.schema([*_KEY, ("total_images", pa.int32()), ("n_frames", pa.int32()), ("slice_frames", pa.list_(pa.int32())), ("vmin", pa.float64()), ("vmax", pa.float64()), ("status", pa.string())])
OUTCOMES = pa.schema([(c, pa.string()) for c in ("unit", "status", "detail")])


def _file(path: str, mode: str = "r"):
    import h5py

    system, inner = filesystem(path)
    return h5py.File(system.open_input_file(inner) if mode == "r" else inner, mode)


def _names(path: str) -> tuple[str, str, str]:
    """(institution, mrn, accession) of a store path; the mrn is what follows the last underscore of the folder."""
    folder, file = path.rstrip("/").split("/")[-2:]
    institution, _, mrn = folder.rpartition("_")
    return institution, mrn, os.path.splitext(file)[0]


def series_rows(path: str, file) -> Iterator[tuple]:
    """Rows of SERIES of an open file; a dataset that is no series has a status."""
    for name in sorted(file):
        data = file[name]
        if getattr(data, "ndim", 0) not in (3, 4):
            yield (*_names(path), name, None, None, None, None, None, "invalid_array")
            continue
        array, n = np.asarray(data), int(data.shape[0])
        slices = [int(x) for x in data.attrs.get("slice_frames", [])]
        yield (*_names(path), name, int(data.attrs.get("total_images", n)), n, slices, float(array.min()), float(array.max()), None)


def frame_rows(path: str, file) -> Iterator[tuple]:
    """Rows of FRAMES of an open file, a plane at a time: 8 bits stay, other values become float32; of channels the first counts."""
    for name in sorted(file):
        data = file[name]
        if getattr(data, "ndim", 0) not in (3, 4):
            continue
        for i in range(data.shape[0]):
            plane = pixels.frames_first(np.asarray(data[i : i + 1]), "cine0")[0]
            plane = plane if plane.dtype == np.uint8 else plane.astype("<f4")
            yield (*_names(path), name, i, *plane.shape, "u1" if plane.dtype == np.uint8 else "f4", np.ascontiguousarray(plane).tobytes())


def _read(spark: SparkSession, root: str, schema: pa.Schema, rows, failed) -> DataFrame:
    paths = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.h5").load(root).select("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def every() -> Iterator[tuple]:
            for batch in batches:
                for path in batch.column(0).to_pylist():
                    try:
                        with _file(path) as file:
                            yield from rows(path, file)
                    except OSError as e:
                        yield from failed(path, e)

        yield from batched(every(), schema)

    return paths.mapInArrow(run, spark_schema(schema))


def read_series(spark: SparkSession, root: str) -> DataFrame:
    """(key, total_images, n_frames, slice_frames, vmin, vmax, status) of every dataset below ``root``; unreadable files have one row."""
    return _read(spark, root, SERIES, series_rows, lambda path, e: [(*_names(path), None, None, None, None, None, None, f"exception: {type(e).__name__}")])


def read_frames(spark: SparkSession, root: str) -> DataFrame:
    """The planes of every series below ``root`` in the columns of the store."""
    return _read(spark, root, FRAMES, frame_rows, lambda path, e: [])


def write_file(path: str, series: dict[str, tuple[np.ndarray, list[int], int]]) -> None:
    """One file of (frames, slice_frames, total_images) by series name; it has its name only when whole. Local or mounted folders."""
    system, inner = filesystem(path)
    system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    part = part_name(inner)
    import h5py

    with h5py.File(part, "w") as file:
        for name, (array, slices, total) in series.items():
            data = file.create_dataset(name, data=array, compression="gzip")
            data.attrs["slice_frames"], data.attrs["total_images"] = slices, total
    system.move(part, inner)


def write_store(frames: DataFrame, series: DataFrame, root: str) -> DataFrame:
    """(unit, status, detail): a file per study. A study's frames meet in one task, which writes them."""
    key = ["institution", "mrn", "accession"]
    rows = frames.join(series.select(*key, "series", "total_images", "slice_frames"), [*key, "series"])

    def run(_: tuple, table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        unit = f"{rows[0]['institution']}_{rows[0]['mrn']}/{rows[0]['accession']}.h5"
        try:
            found: dict = {}
            for r in sorted(rows, key=lambda r: (r["series"], r["frame_idx"])):
                found.setdefault(r["series"], []).append(r)
            arrays = {s: (np.stack([np.frombuffer(r["pixels"], "u1" if r["dtype"] == "u1" else "<f4").reshape(r["h"], r["w"]) for r in rs]), list(rs[0]["slice_frames"]), rs[0]["total_images"]) for s, rs in found.items()}
            write_file(f"{root.rstrip('/')}/{unit}", arrays)
            status, detail = "written", str(len(arrays))
        except (OSError, ValueError, ImportError) as e:
            status, detail = "error", type(e).__name__
        return pa.Table.from_pylist([{"unit": unit, "status": status, "detail": detail}], OUTCOMES)

    return rows.groupBy(*key).applyInArrow(run, spark_schema(OUTCOMES))


def installed() -> bool:
    try:
        import h5py  # noqa: F401
    except ImportError:
        return False
    return True


def columns(df: DataFrame) -> DataFrame:
    """Series without a status, in the columns of the store."""
    return df.where(F.col("status").isNull()).drop("status")
