"""Files by path or URI on any file system that Arrow knows, for work inside tasks."""

from __future__ import annotations

import hashlib
import os
import socket
import uuid

import pyarrow.fs as fs

PIECE = 1 << 20


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """(file system, path in it); paths without a scheme and ``file:`` are local or mounted."""
    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else os.path.abspath(path)
    return fs.FileSystem.from_uri(path)


def part_name(path: str) -> str:
    """A name next to ``path`` that no other task or host uses."""
    head, name = path.rsplit("/", 1)
    return f"{head}/.{name}.{socket.gethostname()}-{uuid.uuid4().hex}.part"


def digest(system: fs.FileSystem, path: str) -> str:
    h = hashlib.sha256()
    with system.open_input_stream(path) as f:
        while piece := f.read(PIECE):
            h.update(piece)
    return h.hexdigest()


def copy(a: str, b: str) -> bool:
    """Copies a file under a temporary name, compares the digests, and only then gives it its name."""
    source, path_a = filesystem(a)
    target, path_b = filesystem(b)
    target.create_dir(path_b.rsplit("/", 1)[0], recursive=True)
    part, h = part_name(path_b), hashlib.sha256()
    with source.open_input_stream(path_a) as i, target.open_output_stream(part) as o:
        while piece := i.read(PIECE):
            h.update(piece)
            o.write(piece)
    if digest(target, part) != h.hexdigest():
        target.delete_file(part)
        return False
    target.move(part, path_b)
    return True
