"""HDF5 stores: rows of datasets, with stand-ins where h5py is not installed."""

import numpy as np
import pytest

from scanloom.sources import hdf5


class Data:
    def __init__(self, array, **attrs):
        self.array, self.attrs, self.ndim, self.shape = array, attrs, array.ndim, array.shape

    def __getitem__(self, at):
        return self.array[at]

    def __array__(self, *a, **k):
        return self.array


FILE = {
    "sax": Data(np.arange(24, dtype=np.uint8).reshape(2, 3, 4), slice_frames=[0], total_images=5), "lax": Data(np.arange(48, dtype=np.float64).reshape(2, 2, 3, 4)),
    "odd": Data(np.arange(3)),
}


def test_rows_of_datasets():
    path = "file:/x/site_one_M1/A-1.h5"
    series = {r[3]: r for r in hdf5.series_rows(path, FILE)}
    assert series["sax"] == ("site_one", "M1", "A-1", "sax", 5, 2, [0], 0.0, 23.0, None)
    assert series["lax"][4:7] == (2, 2, []) and series["odd"][-1] == "invalid_array"
    frames = list(hdf5.frame_rows(path, FILE))
    assert [(r[3], r[4], r[5], r[6], r[7]) for r in frames] == [("lax", 0, 3, 4, "f4"), ("lax", 1, 3, 4, "f4"), ("sax", 0, 3, 4, "u1"), ("sax", 1, 3, 4, "u1")]
    assert np.frombuffer(frames[1][-1], "<f4").tolist() == list(range(24, 36)) and frames[3][-1] == bytes(range(12, 24))


def test_writing_without_the_package_is_an_outcome(spark, tmp_path):
    if hdf5.installed():
        pytest.skip("h5py is installed")
    frames = spark.createDataFrame([("s", "m", "a", "x", 0, 1, 2, "u1", b"ab")], "institution string, mrn string, accession string, series string, frame_idx int, h int, w int, dtype string, pixels binary")
    series = spark.createDataFrame([("s", "m", "a", "x", 1, [])], "institution string, mrn string, accession string, series string, total_images int, slice_frames array<int>")
    assert [(r.unit, r.status) for r in hdf5.write_store(frames, series, str(tmp_path)).collect()] == [("s_m/a.h5", "error")]


def test_round_trip(spark, tmp_path):
    pytest.importorskip("h5py")
    frames = spark.createDataFrame([("s", "m", "a", "x", i, 1, 2, "u1", bytes([i, i + 1])) for i in range(3)], "institution string, mrn string, accession string, series string, frame_idx int, h int, w int, dtype string, pixels binary")
    series = spark.createDataFrame([("s", "m", "a", "x", 3, [0])], "institution string, mrn string, accession string, series string, total_images int, slice_frames array<int>")
    assert [r.status for r in hdf5.write_store(frames, series, str(tmp_path)).collect()] == ["written"]
    assert sorted(map(tuple, hdf5.read_frames(spark, str(tmp_path)).collect())) == sorted(map(tuple, frames.collect()))
    back = hdf5.columns(hdf5.read_series(spark, str(tmp_path))).first()
    assert (back.total_images, back.n_frames, list(back.slice_frames)) == (3, 3, [0])
