"""Compressed pixel data of DICOM files: run lengths and lossless JPEG, as the public standards define them."""

from __future__ import annotations

import re
import struct

import numpy as np

# Transfer syntaxes by their public identifiers.
RLE = "1.2.840.10008.1.2.5"
JPEG_LOSSLESS = ("1.2.840.10008.1.2.4.57", "1.2.840.10008.1.2.4.70")
DEFLATED = "1.2.840.10008.1.2.1.99"
ITEM, DELIMITER = (0xFFFE, 0xE000), (0xFFFE, 0xE0DD)


def fragments(data: bytes, at: int) -> list[bytes]:
    """The items of encapsulated pixel data, without the table of offsets that comes first."""
    out = []
    while at + 8 <= len(data):
        group, element, length = struct.unpack_from("<HHI", data, at)
        if (group, element) == DELIMITER:
            return out[1:]
        if (group, element) != ITEM or at + 8 + length > len(data):
            break
        out.append(data[at + 8 : at + 8 + length])
        at += 8 + length
    raise ValueError("pixel items without end")


def unpack_runs(data: bytes) -> bytes:
    """A segment of byte runs: a count n below 128 copies n + 1 bytes, one above 128 repeats a byte 257 - n times."""
    out, at = bytearray(), 0
    while at < len(data):
        n = data[at]
        if n < 128:
            out += data[at + 1 : at + 2 + n]
            at += n + 2
        elif n > 128:
            out += data[at + 1 : at + 2] * (257 - n)
            at += 2
        else:
            at += 1
    return bytes(out)


def run_lengths(fragment: bytes, h: int, w: int, samples: int, dtype: np.dtype) -> np.ndarray:
    """One frame: a segment per byte of each sample, the highest byte first."""
    n, *starts = struct.unpack_from("<16I", fragment)
    if n != samples * dtype.itemsize:
        raise ValueError("segments do not fit the samples")
    ends = [*starts[1:n], len(fragment)]
    planes = []
    for a, b in zip(starts[:n], ends):
        plane = np.frombuffer(unpack_runs(fragment[a:b]), np.uint8)
        if len(plane) < h * w:
            raise ValueError("segment too short")
        planes.append(plane[: h * w].reshape(h, w))
    values = [np.stack(planes[s * dtype.itemsize : (s + 1) * dtype.itemsize], -1).view(dtype.newbyteorder(">"))[..., 0] for s in range(samples)]
    return (np.stack(values, -1) if samples > 1 else values[0]).astype(dtype)


def _codes(counts: bytes, symbols: bytes) -> list[tuple[int, int]]:
    """(length, symbol) by the next 16 bits, for the codes of a table of counts per length."""
    table, code, k = [(0, 0)] * 65536, 0, 0
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            first = code << (16 - length)
            table[first : first + (1 << (16 - length))] = [(length, symbols[k])] * (1 << (16 - length))
            code, k = code + 1, k + 1
        code <<= 1
    return table


def _predicted(kind: int, left: int, above: int, corner: int) -> int:
    return (0, left, above, corner, left + above - corner, left + ((above - corner) >> 1), above + ((left - corner) >> 1), (left + above) >> 1)[kind]


def jpeg_lossless(data: bytes) -> np.ndarray:
    """[h, w] or [h, w, components] of a lossless JPEG with Huffman codes, all predictors, restarts and point transforms."""
    tables: dict[int, list[tuple[int, int]]] = {}
    at, interval, frame = 2, 0, None
    while True:
        if at + 4 > len(data) or data[at] != 0xFF:
            raise ValueError("damaged JPEG")
        marker, size = data[at + 1], struct.unpack_from(">H", data, at + 2)[0]
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xC3:
            frame = struct.unpack_from(">BHHB", body)
        elif 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            raise ValueError("not a lossless JPEG")
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                tables[body[0] & 15] = _codes(body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif marker == 0xDD:
            interval = struct.unpack(">H", body)[0]
        elif marker == 0xDA:
            break
    if frame is None:
        raise ValueError("no frame header")
    precision, h, w, parts = frame
    used = [tables[body[2 + 2 * i] >> 4] for i in range(body[0])]
    kind, shift = body[1 + 2 * body[0]], body[3 + 2 * body[0]] & 15
    if len(used) != parts or not 1 <= kind <= 7:
        raise ValueError("scans of single components are not read")
    stop = data.rfind(b"\xff\xd9")
    runs = re.split(rb"\xff[\xd0-\xd7]", data[at : stop if stop > at else len(data)])
    start = 1 << (precision - shift - 1)
    out = [[[0] * w for _ in range(h)] for _ in range(parts)]
    place, end = 0, h * w
    for run in runs:
        if place >= end:
            break
        bits = run.replace(b"\xff\x00", b"\xff") + b"\0\0\0\0"
        acc = have = pos = 0
        fresh, until = place, min(end, place + interval) if interval else end
        while place < until:
            y, x = divmod(place, w)
            for c in range(parts):
                while have < 32 and pos < len(bits):
                    acc, have, pos = (acc << 8 | bits[pos]) & 0xFFFFFFFFFF, have + 8, pos + 1
                length, size = used[c][acc >> (have - 16) & 0xFFFF]
                if not length or have < length:
                    raise ValueError("damaged JPEG data")
                have -= length
                if size == 16:
                    diff = 32768
                elif size:
                    have -= size
                    diff = acc >> have & (1 << size) - 1
                    if diff < 1 << (size - 1):
                        diff -= (1 << size) - 1
                else:
                    diff = 0
                line = out[c][y]
                if place == fresh:
                    near = start
                elif y == fresh // w:
                    near = line[x - 1]
                elif x == 0:
                    near = out[c][y - 1][0]
                else:
                    before = out[c][y - 1]
                    near = _predicted(kind, line[x - 1], before[x], before[x - 1])
                line[x] = (near + diff) & 0xFFFF
            place += 1
    if place < end:
        raise ValueError("JPEG data too short")
    array = np.array(out, np.uint16) << shift
    return np.moveaxis(array, 0, -1) if parts > 1 else array[0]
