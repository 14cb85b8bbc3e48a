"""Contact sheets, read back by a decoder written here."""

import struct
import zlib

import numpy as np
import pytest

from scanloom.sinks import pictures
from scanloom.sources.store import FRAMES, SERIES


def decoded(data):
    assert data[:8] == b"\x89PNG\r\n\x1a\n"
    at, found = 8, {}
    while at < len(data):
        size, kind = struct.unpack_from(">I4s", data, at)
        found[kind] = data[at + 8 : at + 8 + size]
        assert struct.unpack_from(">I", data, at + 8 + size)[0] == zlib.crc32(kind + found[kind])
        at += 12 + size
    w, h, depth, colour = struct.unpack_from(">IIBB", found[b"IHDR"])
    assert (depth, colour) == (8, 0)
    lines = np.frombuffer(zlib.decompress(found[b"IDAT"]), np.uint8).reshape(h, w + 1)
    assert not lines[:, 0].any()
    return lines[:, 1:]


def test_sheets():
    planes = [np.full((2, 3), i + 1, np.uint8) for i in range(4)] + [np.full((1, 1), 9, np.uint8)]
    got = decoded(pictures.png(pictures.sheet(planes, 2)))
    assert got.shape == (6, 6) and got[::2, ::3].tolist() == [[1, 2], [3, 4], [9, 0]]


@pytest.fixture(scope="module")
def stored(spark):
    frames = [("s", "m", "a", "x", i, 2, 2, "u1", bytes([i] * 4)) for i in range(6)] + [("s", "m", "b", "y", i, 2, 2, "f4", np.full((2, 2), i, "<f4").tobytes()) for i in range(5)]
    series = [("s", "m", "a", "x", 6, 6, [1, 3], 0.0, 5.0), ("s", "m", "b", "y", 5, 5, [], 0.0, 4.0)]
    return spark.createDataFrame(frames, FRAMES), spark.createDataFrame(series, SERIES)


def test_modes(stored, tmp_path):
    frames, series = stored

    def made(mode, step=1):
        out = {(r.unit, r.status, r.detail) for r in pictures.pictures(frames, series, f"{tmp_path}/{mode}{step}", mode, step).collect()}
        return out, {p.stem: decoded(p.read_bytes())[0, ::2].tolist() for p in (tmp_path / f"{mode}{step}").glob("*.png")}

    out, found = made("sequence", 2)
    assert out == {("s_m_a_x", "written", "3"), ("s_m_b_y", "written", "3")}
    assert found == {"s_m_a_x": [0, 2, 4], "s_m_b_y": [0, 127, 254]}
    assert made("slices") == ({("s_m_a_x", "written", "2")}, {"s_m_a_x": [1, 3]})
    assert made("grid") == ({("grid", "written", "2")}, {"grid": [3, 127]})
    with pytest.raises(ValueError):
        pictures.pictures(frames, series, str(tmp_path), "other")
