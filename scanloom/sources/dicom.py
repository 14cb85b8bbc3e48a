"""A small reader and rewriter for little-endian DICOM files.

Headers of any explicit or implicit little-endian file are read; pixels when plain, deflated, run-length
coded or lossless JPEG. Value representations and tags are those of the public standard.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np

from . import codecs

# Tags by keyword, with their value representation for writing.
TAGS = {
    "TransferSyntaxUID": (0x0002, 0x0010, "UI"), "StudyDate": (0x0008, 0x0020, "DA"), "AccessionNumber": (0x0008, 0x0050, "SH"), "Modality": (0x0008, 0x0060, "CS"),
    "Manufacturer": (0x0008, 0x0070, "LO"), "SeriesDescription": (0x0008, 0x103E, "LO"), "ManufacturerModelName": (0x0008, 0x1090, "LO"), "PatientName": (0x0010, 0x0010, "PN"),
    "PatientID": (0x0010, 0x0020, "LO"), "MagneticFieldStrength": (0x0018, 0x0087, "DS"), "StudyInstanceUID": (0x0020, 0x000D, "UI"), "SeriesInstanceUID": (0x0020, 0x000E, "UI"),
    "SeriesNumber": (0x0020, 0x0011, "IS"), "InstanceNumber": (0x0020, 0x0013, "IS"), "SliceLocation": (0x0020, 0x1041, "DS"), "SamplesPerPixel": (0x0028, 0x0002, "US"),
    "PhotometricInterpretation": (0x0028, 0x0004, "CS"), "NumberOfFrames": (0x0028, 0x0008, "IS"), "Rows": (0x0028, 0x0010, "US"), "Columns": (0x0028, 0x0011, "US"),
    "BitsAllocated": (0x0028, 0x0100, "US"), "PixelRepresentation": (0x0028, 0x0103, "US"),
}
KEYWORDS = {(g, e): k for k, (g, e, _) in TAGS.items()}
PIXELS = (0x7FE0, 0x0010)
LONG_VRS = {b"OB", b"OD", b"OF", b"OL", b"OV", b"OW", b"SQ", b"SV", b"UC", b"UN", b"UR", b"UT", b"UV"}
IMPLICIT, EXPLICIT = "1.2.840.10008.1.2", "1.2.840.10008.1.2.1"
BIG_ENDIAN = "1.2.840.10008.1.2.2"
UNDEFINED = 0xFFFFFFFF


class DicomError(ValueError):
    pass


def _skip_items(data: bytes, at: int, explicit: bool) -> int:
    """The position after a sequence of undefined length."""
    while at + 8 <= len(data):
        group, element, length = struct.unpack_from("<HHI", data, at)
        at += 8
        if (group, element) == (0xFFFE, 0xE0DD):
            return at
        if length != UNDEFINED:
            at += length
            continue
        while at + 8 <= len(data):
            if struct.unpack_from("<HH", data, at) == (0xFFFE, 0xE00D):
                at += 8
                break
            *_, at = _element(data, at, explicit)
    raise DicomError("sequence without end")


def _element(data: bytes, at: int, explicit: bool) -> tuple[tuple[int, int], bytes, int, int, int]:
    """(tag, vr, start of value, length, position after) of the element at a position."""
    try:
        tag = struct.unpack_from("<HH", data, at)
        if explicit and tag[0] != 0xFFFE:
            vr = data[at + 4 : at + 6]
            if vr in LONG_VRS:
                (length,), start = struct.unpack_from("<I", data, at + 8), at + 12
            else:
                (length,), start = struct.unpack_from("<H", data, at + 6), at + 8
        else:
            vr, (length,), start = b"", struct.unpack_from("<I", data, at + 4), at + 8
    except struct.error as e:
        raise DicomError("file ends inside an element") from e
    if length == UNDEFINED:
        return tag, vr, start, length, _skip_items(data, start, explicit)
    if start + length > len(data):
        raise DicomError("file ends inside a value")
    return tag, vr, start, length, start + length


def elements(data: bytes) -> Iterator[tuple[tuple[int, int], bytes, int, int, int, int, bool]]:
    """(tag, vr, start of element, start of value, length, end, explicit) in file order."""
    if data[128:132] != b"DICM":
        raise DicomError("no DICOM preamble")
    at, explicit, syntax = 132, True, EXPLICIT
    while at + 8 <= len(data):
        meta = struct.unpack_from("<H", data, at)[0] == 0x0002
        if not meta and at > 132 and syntax == BIG_ENDIAN:
            raise DicomError("big-endian files are not read")
        explicit = meta or syntax != IMPLICIT
        tag, vr, start, length, end = _element(data, at, explicit)
        if tag == (0x0002, 0x0010):
            syntax = data[start : start + length].rstrip(b"\0 ").decode()
        yield tag, vr, at, start, length, end, explicit
        at = end


def _value(keyword: str, raw: bytes) -> str:
    if TAGS[keyword][2] == "US":
        return str(struct.unpack("<H", raw[:2])[0]) if len(raw) >= 2 else ""
    return raw.decode("utf-8", "replace").strip("\0 ")


def header(data: bytes) -> dict[str, str]:
    """Known tags as text, without reading on past the start of the pixels."""
    out, data = {}, inflated(data)
    for tag, _, _, start, length, end, _ in elements(data):
        if tag >= PIXELS:
            break
        if tag in KEYWORDS and length != UNDEFINED:
            out[KEYWORDS[tag]] = _value(KEYWORDS[tag], data[start:end])
    return out


def inflated(data: bytes) -> bytes:
    """The file with its deflated part unpacked, as a plain explicit one; other files as they are."""
    if data[128:132] != b"DICM" or codecs.DEFLATED.encode() not in data[132:1024]:
        return data
    at = 132
    while at + 8 <= len(data) and struct.unpack_from("<H", data, at)[0] == 2:
        *_, at = _element(data, at, True)
    try:
        return data[:at].replace(_uid(codecs.DEFLATED), _uid(EXPLICIT)) + zlib.decompress(data[at:], -15)
    except zlib.error as e:
        raise DicomError("damaged deflated file") from e


def _uid(text: str) -> bytes:
    return _encode((2, 0x10), "UI", text.encode(), True)


def pixels(data: bytes) -> tuple[dict[str, str], np.ndarray]:
    """(header, array): [h, w], [h, w, samples] or with a leading frame axis."""
    data = inflated(data)
    head = header(data)
    syntax = head.get("TransferSyntaxUID", IMPLICIT)
    packed = syntax == codecs.RLE or syntax in codecs.JPEG_LOSSLESS
    if syntax not in (IMPLICIT, EXPLICIT) and not packed:
        raise DicomError(f"transfer syntax {syntax} is not read")
    try:
        h, w = int(head["Rows"]), int(head["Columns"])
    except KeyError as e:
        raise DicomError(f"no {e.args[0]}") from e
    samples, frames = int(head.get("SamplesPerPixel") or 1), int(head.get("NumberOfFrames") or 1)
    signed = head.get("PixelRepresentation") == "1"
    dtype = np.dtype({8: "i1" if signed else "u1", 16: "<i2" if signed else "<u2", 32: "<i4" if signed else "<u4"}.get(int(head.get("BitsAllocated") or 16), "u2"))
    for tag, _, _, start, length, _, _ in elements(data):
        if tag == PIXELS:
            need = h * w * samples * frames
            if packed:
                return head, _unpacked(codecs.fragments(data, start), syntax, h, w, samples, frames, dtype)
            if length == UNDEFINED or length < need * dtype.itemsize:
                raise DicomError("pixel data too short")
            shape = ([frames] if frames > 1 else []) + [h, w] + ([samples] if samples > 1 else [])
            return head, np.frombuffer(data, dtype, need, start).reshape(shape)
    raise DicomError("no pixel data")


def _unpacked(parts: list[bytes], syntax: str, h: int, w: int, samples: int, frames: int, dtype: np.dtype) -> np.ndarray:
    """The frames of encapsulated pixel data; several frames have an item each."""
    if frames == 1 and syntax != codecs.RLE:
        parts = [b"".join(parts)]
    if len(parts) != frames:
        raise DicomError("pixel items do not fit the frames")
    planes = []
    for part in parts:
        try:
            plane = codecs.run_lengths(part, h, w, samples, dtype) if syntax == codecs.RLE else codecs.jpeg_lossless(part).astype(np.uint16).astype(dtype, casting="unsafe")
        except (IndexError, KeyError, struct.error) as e:
            raise DicomError("damaged pixel data") from e
        if plane.shape[:2] != (h, w):
            raise DicomError("pixel data of another size")
        planes.append(plane)
    return np.stack(planes) if frames > 1 else planes[0]


def _encode(tag: tuple[int, int], vr: str, raw: bytes, explicit: bool) -> bytes:
    raw += (b"\0" if vr in ("UI", "OB") else b" ") * (len(raw) % 2)
    if not explicit:
        return struct.pack("<HHI", *tag, len(raw)) + raw
    if vr.encode() in LONG_VRS:
        return struct.pack("<HH", *tag) + vr.encode() + b"\0\0" + struct.pack("<I", len(raw)) + raw
    return struct.pack("<HH", *tag) + vr.encode() + struct.pack("<H", len(raw)) + raw


def _raw(keyword: str, value: object) -> bytes:
    return struct.pack("<H", int(value)) if TAGS[keyword][2] == "US" else str(value).encode()


def rewrite(data: bytes, values: dict[str, str]) -> bytes:
    """A copy of the file with other values for some tags; tags it lacks are added in order."""
    data = inflated(data)
    todo = {TAGS[k][:2]: (TAGS[k][2], _raw(k, v)) for k, v in values.items()}
    out, last, explicit = [data[:132]], 132, True
    for tag, _, at, _, _, end, explicit in elements(data):
        for t in sorted(t for t in todo if t < tag):
            out.append(_encode(t, *todo.pop(t), explicit))
        out.append(_encode(tag, *todo.pop(tag), explicit) if tag in todo else data[at:end])
        last = end
    out += [_encode(t, *todo[t], explicit) for t in sorted(todo)]
    return b"".join(out) + data[last:]


def build(values: dict[str, object], array: np.ndarray | None = None, implicit: bool = False) -> bytes:
    """A file from tag values and pixels; for fixtures and exports."""
    values = dict(values)
    if array is not None:
        values |= {"Rows": array.shape[0], "Columns": array.shape[1], "SamplesPerPixel": array.shape[2] if array.ndim == 3 else 1, "BitsAllocated": array.dtype.itemsize * 8, "PixelRepresentation": int(array.dtype.kind == "i")}
    meta = _encode((2, 0x10), "UI", (IMPLICIT if implicit else EXPLICIT).encode(), True)
    out = [bytes(128), b"DICM", _encode((2, 0), "UL", struct.pack("<I", len(meta)), True), meta]
    for k in sorted(values, key=lambda k: TAGS[k][:2]):
        out.append(_encode(TAGS[k][:2], TAGS[k][2], _raw(k, values[k]), not implicit))
    if array is not None:
        out.append(_encode(PIXELS, "OW" if array.dtype.itemsize > 1 else "OB", array.tobytes(), not implicit))
    return b"".join(out)
