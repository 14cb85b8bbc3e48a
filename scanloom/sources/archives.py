"""Study archives as tables: one row per member of tar and zip files, read without unpacking to disk.

``members`` gives rows of content. ``ArchiveFiles`` gives archives by path instead: a task opens an archive
where it lies, on any file system that Arrow reads, and works on it as a whole, so contents never travel.
"""

from __future__ import annotations

import io
import os
import tarfile
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import filesystem

MEMBERS = "archive string, folder string, member string, content binary, status string"
#: Bytes of members that travel in one Arrow batch.
BATCH_BYTES = 32 << 20


def safe_name(name: str) -> bool:
    """Member names that stay inside the archive's root."""
    return not name.startswith(("/", "\\")) and ".." not in name.replace("\\", "/").split("/") and ":" not in name.split("/")[0]


def open_file(path: str) -> io.BufferedIOBase:
    """A file by path or URI, for reading."""
    system, inner = filesystem(path)
    return system.open_input_file(inner)


def _tar(source: io.BufferedIOBase) -> Iterator[tuple[str, bytes]]:
    with tarfile.open(fileobj=source, mode="r|*") as tar:
        for m in tar:
            if m.isfile() and safe_name(m.name):
                yield m.name, tar.extractfile(m).read()


def _zip(source: io.BufferedIOBase) -> Iterator[tuple[str, bytes]]:
    with zipfile.ZipFile(source) as z:
        for m in z.infolist():
            if not m.is_dir() and safe_name(m.filename):
                yield m.filename, z.read(m)


def _expand(kind: str, by_path: bool, keep: Callable[[str], bool] | None):
    opener = _tar if kind == "tar" else _zip

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1) if not by_path else batch.column(0)):
                name = os.path.basename(path)
                rows, held = [], 0
                try:
                    source = open_file(path) if by_path else io.BytesIO(content.as_buffer())
                    with source:
                        for member, data in opener(source):
                            if keep is not None and not keep(member):
                                continue
                            rows.append((name, os.path.dirname(member), os.path.basename(member), data, None))
                            held += len(data)
                            if held > BATCH_BYTES:
                                yield _batch(rows)
                                rows, held = [], 0
                except Exception as e:  # a damaged archive is an outcome, not the end of the job
                    rows.append((name, None, None, None, f"exception: {type(e).__name__}"))
                if rows:
                    yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["archive", "folder", "member", "content", "status"])


def members(spark: SparkSession, path: str, kind: str = "tar", glob: str | None = None, by_path: bool = False, keep: Callable[[str], bool] | None = None) -> DataFrame:
    """(archive, folder, member, content, status): the files inside archives below ``path``.

    Hidden archives, links and members that would leave the root are passed over; a damaged archive
    gives what could be read and one row with a status. ``by_path`` opens shared files on the executors
    instead of reading them into rows, for archives over 2 GB. ``keep`` filters member names early.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob or ("*.tgz" if kind == "tar" else "*.zip")).option("recursiveFileLookup", "true").load(path)
    files = files.where(~F.element_at(F.split("path", "/"), -1).startswith("."))
    chosen = files.select("path") if by_path else files.select("path", "content")
    return chosen.mapInArrow(_expand(kind, by_path, keep), MEMBERS)


#: What a task gets to see of an archive: (folder, member, content, status) of each member; a damaged archive ends with a status.
Opened = Callable[[], Iterator[tuple[str | None, str | None, bytes | None, str | None]]]


def opened(path: str, kind: str) -> Opened:
    def run() -> Iterator[tuple[str | None, str | None, bytes | None, str | None]]:
        try:
            with open_file(path) as source:
                for name, data in (_tar if kind == "tar" else _zip)(source):
                    yield os.path.dirname(name), os.path.basename(name), data, None
        except Exception as e:  # a damaged archive is an outcome, not the end of the job
            yield None, None, None, f"exception: {type(e).__name__}"

    return run


@dataclass(frozen=True)
class ArchiveFiles:
    """Archives by path: a table of ``path`` and how to open them."""

    files: DataFrame
    kind: str = "tar"

    @staticmethod
    def below(spark: SparkSession, path: str, kind: str = "tar", glob: str | None = None) -> ArchiveFiles:
        files = spark.read.format("binaryFile").option("pathGlobFilter", glob or ("*.tgz" if kind == "tar" else "*.zip")).option("recursiveFileLookup", "true").load(path)
        return ArchiveFiles(files.select("path").where(~F.element_at(F.split("path", "/"), -1).startswith(".")), kind)

    def named(self, names: DataFrame) -> ArchiveFiles:
        """Those whose file name is in ``names`` (archive)."""
        return replace(self, files=self.files.withColumn("archive", F.element_at(F.split("path", "/"), -1)).join(names, "archive", "left_semi").select("path"))

    def map(self, work: Callable[[str, list[dict] | None, Opened], Iterator[tuple]], schema: pa.Schema, plan: DataFrame | None = None, batch_bytes: int = BATCH_BYTES) -> DataFrame:
        """Rows of ``work(archive, plan, opened)`` over all archives, one archive in one task.

        ``plan`` is (archive, steps array<struct>); archives without a plan are left out then. Only paths and
        plans are joined.
        """
        rows = self.files.withColumn("archive", F.element_at(F.split("path", "/"), -1))
        rows = rows.select("path", "archive", F.lit(None).alias("steps")) if plan is None else rows.join(plan, "archive").select("path", "archive", "steps")
        kind = self.kind

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for path, archive, steps in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    yield from batched(work(archive, steps, opened(path, kind)), schema, batch_bytes)

        return rows.mapInArrow(run, spark_schema(schema))


def batched(rows: Iterator[tuple], schema: pa.Schema, batch_bytes: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of about so many bytes of binary content."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(x) for x in row if isinstance(x, (bytes, memoryview)))
        if size > batch_bytes:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def spark_schema(schema: pa.Schema):
    from pyspark.sql.pandas.types import from_arrow_schema

    return from_arrow_schema(schema)


def folder_files(spark: SparkSession, path: str) -> DataFrame:
    """The same columns for plain folders: the archive is the study folder below ``path``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    root = path.rstrip("/").removeprefix("file:")
    rel = F.regexp_replace("path", "^file:/*", "/")
    inner = F.substr(rel, F.lit(len(root) + 2))
    return files.select(
        F.split_part(inner, F.lit("/"), F.lit(1)).alias("archive"), F.regexp_replace(F.regexp_replace(inner, r"^[^/]*/?", ""), r"/?[^/]*$", "").alias("folder"),
        F.element_at(F.split(inner, "/"), -1).alias("member"), "content", F.lit(None).cast("string").alias("status"),
    ).where(~F.col("member").startswith(".") & ~F.col("archive").startswith("."))


def of_eid(rows: DataFrame, eid: str) -> DataFrame:
    """Zip members of one participant: the id before the first underscore is equal, not only a prefix."""
    return rows.where(F.split_part("archive", F.lit("_"), F.lit(1)) == eid)
