"""Compressed pixel data against encoders written here."""

import random
import struct
import zlib

import numpy as np
import pytest

from scanloom.sources import codecs, dicom


def encapsulated(parts, syntax, shape, bits=16, samples=1, frames=1):
    """A file whose pixels are items."""
    values = {"Rows": shape[0], "Columns": shape[1], "SamplesPerPixel": samples, "BitsAllocated": bits, "PixelRepresentation": 0, "PatientID": "P"}
    if frames > 1:
        values["NumberOfFrames"] = frames
    plain = dicom.build(values).replace(dicom._uid(dicom.EXPLICIT), dicom._uid(syntax))
    items = [b"", *[p + b"\0" * (len(p) % 2) for p in parts]]
    body = b"".join(struct.pack("<HHI", 0xFFFE, 0xE000, len(i)) + i for i in items) + struct.pack("<HHI", 0xFFFE, 0xE0DD, 0)
    return plain + struct.pack("<HH", *dicom.PIXELS) + b"OB\0\0" + struct.pack("<I", dicom.UNDEFINED) + body


def packed_runs(data):
    out, at = bytearray(), 0
    while at < len(data):
        n = 1
        while n < 128 and data[at : at + n + 1] == data[at : at + 1] * (n + 1):
            n += 1
        if n > 1:
            out += bytes([257 - n, data[at]])
        else:
            out += bytes([0, data[at]])
        at += n
    return bytes(out)


def run_length_frame(array):
    samples = array[..., None] if array.ndim == 2 else array
    size = array.dtype.itemsize
    planes = [samples[..., s].astype(array.dtype.newbyteorder(">")).view(np.uint8).reshape(*samples.shape[:2], size)[..., b] for s in range(samples.shape[2]) for b in range(size)]
    segments = [packed_runs(np.ascontiguousarray(p).tobytes()) for p in planes]
    starts = [64 + sum(map(len, segments[:i])) for i in range(len(segments))]
    return struct.pack("<16I", len(segments), *starts, *[0] * (15 - len(segments))) + b"".join(segments)


def jpeg(array, kind=1, interval=0, shift=0):
    """A lossless JPEG; every difference size has a code of five bits."""
    planes = (array[..., None] if array.ndim == 2 else array) >> shift
    h, w, parts = planes.shape
    head = b"\xff\xd8\xff\xc3" + struct.pack(">HBHHB", 8 + 3 * parts, 16, h, w, parts) + b"".join(bytes([c + 1, 0x11, 0]) for c in range(parts))
    head += b"\xff\xc4" + struct.pack(">H", 2 + 17 + 17) + bytes([0, 0, 0, 0, 0, 17, *[0] * 11]) + bytes(range(17))
    if interval:
        head += b"\xff\xdd" + struct.pack(">HH", 4, interval)
    head += b"\xff\xda" + struct.pack(">HB", 6 + 2 * parts, parts) + b"".join(bytes([c + 1, 0]) for c in range(parts)) + bytes([kind, 0, shift])
    out, bits = [], ""

    def flush():
        nonlocal bits
        bits += "1" * (-len(bits) % 8)
        data = bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8)).replace(b"\xff", b"\xff\x00")
        bits = ""
        return data

    fresh = 0
    for n in range(h * w):
        if interval and n and n % interval == 0:
            out.append(flush() + b"\xff" + bytes([0xD0 + (n // interval - 1) % 8]))
            fresh = n
        y, x = divmod(n, w)
        for c in range(parts):
            p = planes[..., c].astype(int)
            if n == fresh:
                near = 1 << (15 - shift)
            elif y == fresh // w:
                near = p[y, x - 1]
            elif x == 0:
                near = p[y - 1, 0]
            else:
                a, b, d = p[y, x - 1], p[y - 1, x], p[y - 1, x - 1]
                near = {1: a, 2: b, 3: d, 4: a + b - d, 5: a + ((b - d) >> 1), 6: b + ((a - d) >> 1), 7: (a + b) >> 1}[kind]
            diff = (int(p[y, x]) - int(near) + 32768) % 65536 - 32768
            if diff == -32768:
                bits += f"{16:05b}"
                continue
            size = abs(diff).bit_length()
            bits += f"{size:05b}" + (f"{diff if diff > 0 else diff + (1 << size) - 1:0{size}b}" if size else "")
    out.append(flush())
    return head + b"".join(out) + b"\xff\xd9"


def plane(seed, shape, top=65536):
    rng = np.random.default_rng(seed)
    smooth = np.add.outer(np.arange(shape[0]) * 37, np.arange(shape[1]) * 11) % top
    return np.where(rng.random(shape) < 0.3, rng.integers(0, top, shape), smooth).astype(np.uint16)


@pytest.mark.parametrize("kind", range(1, 8))
@pytest.mark.parametrize("interval, shift", [(0, 0), (9, 0), (0, 2)])
def test_lossless_jpeg(kind, interval, shift):
    array = plane(kind, (7, 9)) >> shift << shift
    head, got = dicom.pixels(encapsulated([jpeg(array, kind, interval, shift)], codecs.JPEG_LOSSLESS[1], array.shape))
    assert head["PatientID"] == "P" and got.dtype == np.uint16 and (got == array).all()


def test_jpeg_of_several_items_and_components():
    array = plane(3, (6, 5))
    data = jpeg(array)
    cut = len(data) // 2 * 2 // 3
    cut -= cut % 2
    assert (dicom.pixels(encapsulated([data[:cut], data[cut:]], codecs.JPEG_LOSSLESS[0], array.shape))[1] == array).all()
    colour = np.stack([plane(s, (4, 6)) for s in range(3)], -1)
    assert (codecs.jpeg_lossless(jpeg(colour)) == colour).all()


@pytest.mark.parametrize("dtype", ["u1", "<u2"])
def test_run_lengths(dtype):
    frames = [plane(s, (5, 6), 256 if dtype == "u1" else 65536).astype(dtype) for s in range(3)]
    bits = 8 * np.dtype(dtype).itemsize
    got = dicom.pixels(encapsulated([run_length_frame(f) for f in frames], codecs.RLE, (5, 6), bits, frames=3))[1]
    assert got.shape == (3, 5, 6) and (got == np.stack(frames)).all()
    colour = np.stack(frames, -1)
    assert (dicom.pixels(encapsulated([run_length_frame(colour)], codecs.RLE, (5, 6), bits, samples=3))[1] == colour).all()


def test_deflated_files():
    array = plane(1, (6, 7))
    plain = dicom.build({"PatientID": "7", "SeriesDescription": "s"}, array)
    meta = plain.index(dicom._uid(dicom.EXPLICIT)) + len(dicom._uid(dicom.EXPLICIT))
    squeezed = zlib.compressobj(wbits=-15)
    data = plain[:meta].replace(dicom._uid(dicom.EXPLICIT), dicom._uid(codecs.DEFLATED)) + squeezed.compress(plain[meta:]) + squeezed.flush()
    head, got = dicom.pixels(data)
    assert head["PatientID"] == "7" and (got == array).all()
    assert dicom.header(dicom.rewrite(data, {"PatientID": "9"}))["PatientID"] == "9"


def test_damaged_files_are_one_kind_of_error():
    rng = random.Random(2)
    array = plane(2, (6, 7))
    whole = [encapsulated([jpeg(array)], codecs.JPEG_LOSSLESS[1], array.shape), encapsulated([run_length_frame(array)], codecs.RLE, array.shape)]
    for data in whole:
        for _ in range(120):
            bad = bytearray(data)
            for _ in range(rng.randint(1, 3)):
                bad[rng.randrange(132, len(bad))] = rng.randrange(256)
            try:
                dicom.pixels(bytes(bad[: rng.randint(200, len(bad))]))
            except ValueError:
                pass
