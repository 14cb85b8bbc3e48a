"""Study archives under anonymous names, streamed member by member."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import dicom
from ..sources.files import filesystem, part_name


def write_archives(members: DataFrame, target: str) -> DataFrame:
    """(unit, status, detail): one tar.gz per ``name`` in the folder ``target``, which executors share.

    ``members`` has name, folder, member, content and optionally ``tags``, a map of DICOM values to set.
    ``target`` is a path or URI. Rows are sorted by archive within partitions and written as they pass; an
    archive is visible under its name only when whole. Names keep inside the folder: what would lead out of
    it, as a slash, becomes an underscore.
    """
    tags = F.col("tags") if "tags" in members.columns else F.create_map().cast("map<string,string>")
    name = F.regexp_replace(F.regexp_replace("name", r"[/\\\\\x00]", "_"), r"^\.+", "_")
    rows = members.select(name.alias("name"), "folder", "member", "content", tags.alias("tags")).repartition("name").sortWithinPartitions("name", "folder", "member")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tar, stream, part, status, n = None, None, None, "", "written", 0
        system, root = filesystem(target)

        def close() -> pa.RecordBatch:
            tar.close()
            stream.close()
            if status == "written":
                system.move(part, f"{root}/{now}")
            else:
                system.delete_file(part)
            return pa.RecordBatch.from_pydict({"unit": [now], "status": [status], "detail": [str(n)]})

        for batch in batches:
            contents = batch.column("content")
            for i, (name, folder, member, tag) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("name", "folder", "member", "tags")))):
                if name != now:
                    if now is not None:
                        yield close()
                    system.create_dir(root, recursive=True)
                    now, status, n = name, "written", 0
                    part = part_name(f"{root}/{name}")
                    stream = system.open_output_stream(part)
                    tar = tarfile.open(fileobj=stream, mode="w|gz", compresslevel=1)
                data = contents[i].as_py() or b""
                try:
                    if tag:
                        data = dicom.rewrite(data, dict(tag))
                except dicom.DicomError:
                    status = "unreadable_header"
                    continue
                info = tarfile.TarInfo("/".join(x for x in (folder, member) if x))
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
                n += 1
        if now is not None:
            yield close()

    return rows.mapInArrow(run, "unit string, status string, detail string")
