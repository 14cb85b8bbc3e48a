"""From study archives to the series store.

Headers decide everything but pixels: which folders are read, how they group into series, which are cut
by the limits and how frames are ordered. They are read first and planned as small rows. The plan then
goes to the archives, not the other way round: a task gets the steps of one archive, opens it, decodes
the frames that stay and scales them by the bounds of their series. Contents and planes are written to
the store by the task that decoded them and never shuffled.

Archives come as ``ArchiveFiles`` (paths) or as rows of members; only the latter, whose archives may be
spread over tasks, are brought together by archive.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import naming, pixels
from ..functions.natural import natural_key
from ..operators import ordering, reconcile
from ..session import cut, stored
from ..sources import dicom
from ..sources.archives import ArchiveFiles, Opened, batched, spark_schema

OVERLAY = "InlineVF"
HEADER = pa.schema([(c, pa.string()) for c in ("archive", "folder", "member", "series_raw", "mrn_tag", "accession_tag", "instance_number")]
                   + [("slice_location", pa.float64()), ("h", pa.int32()), ("w", pa.int32()), ("status", pa.string())])
DECODED = pa.schema([("archive", pa.string()), ("raw", pa.string()), ("institution", pa.string()), ("mrn", pa.string()), ("accession", pa.string()), ("series", pa.string()), ("slice_location", pa.float64()),
                     ("frame_idx", pa.int32()), ("i", pa.int32()), ("h", pa.int32()), ("w", pa.int32()), ("dtype", pa.string()), ("pixels", pa.binary()), ("low", pa.float64()), ("high", pa.float64()), ("status", pa.string())])
STEP = ("folder", "member", "raw", "frame_idx", "slice_location", "institution", "mrn", "accession", "series")
#: Decoded planes of an archive that a task holds; an archive with more is read a second time instead.
HELD_BYTES = 256 << 20


@dataclass(frozen=True)
class Options:
    institution: str
    frame_size: int | None = 480  # None keeps the original size
    channels: str = "rgb"  # one channel is stored either way; grey is scaled to 8 bits
    colour: bool = False  # decode colour planes to luminosity instead of reporting unsupported_rank

    def __post_init__(self) -> None:
        if self.channels not in ("rgb", "grey"):
            raise ValueError("channels is rgb or grey")


def frame_size_option(text: str) -> int | None:
    """``original`` or a number of pixels."""
    return None if text == "original" else int(text)


def _header(archive: str, folder: str | None, member: str | None, content: bytes | None, status: str | None) -> tuple:
    tags: dict = {}
    if status is None:
        try:
            tags = dicom.header(content)
        except (dicom.DicomError, ValueError):
            status = "unreadable_header"
    number = lambda k: float(tags[k]) if tags.get(k) else None
    try:
        place, h, w = number("SliceLocation"), number("Rows"), number("Columns")
    except ValueError:
        place, h, w, status = None, None, None, "unreadable_header"
    return (archive, folder, member, tags.get("SeriesDescription"), tags.get("PatientID"), tags.get("AccessionNumber"), tags.get("InstanceNumber"), place, h and int(h), w and int(w), status)


def headers(members: DataFrame | ArchiveFiles) -> DataFrame:
    """One row of tags per member; unreadable ones have a status."""
    if isinstance(members, ArchiveFiles):
        return members.map(lambda archive, _, opened: (_header(archive, *m) for m in opened()), HEADER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from batched((_header(*(b.column(k)[i].as_py() for k in range(5))) for i in range(b.num_rows)), HEADER)

    return members.select("archive", "folder", "member", "content", "status").mapInArrow(run, spark_schema(HEADER))


def plan_frames(head: DataFrame, opts: Options) -> tuple[DataFrame, DataFrame]:
    """(frames to decode, outcomes of what is left out), from headers alone.

    The first file of a folder in natural order names its series. Overlay series and folders of 2500
    files or more are left out; of several folders of one raw series name the first ten in order of
    descending slice location stay while they hold 2500 files together. A study without any series is
    ``empty``. Frames are ordered by location, instance number and name, numbers as numbers.
    """
    good = head.where("status is null and folder is not null and member is not null")
    w = Window.partitionBy("archive", "folder")
    first = F.min(F.struct(natural_key(F.col("member")), F.coalesce("series_raw", F.lit("")).alias("s"), F.col("slice_location").alias("loc"))).over(w)
    marked = stored(good.withColumn("n", F.count(F.lit(1)).over(w)).withColumn("first", first).withColumn("raw", F.col("first.s")).withColumn("loc", F.col("first.loc")).drop("first"), "heads")
    folders = marked.groupBy("archive", "folder", "raw", "loc").agg(F.first("n").alias("n"))
    folders = folders.withColumn("left_out", F.when(F.col("raw").contains(OVERLAY), "skipped_overlay").when(F.col("n") >= ordering.MAX_FOLDER_FILES, "too_many_frames"))
    kept = folders.where("left_out is null")
    capped = ordering.folder_cap(ordering.by_location(kept, ["archive", "raw"], "loc", "folder"), ["archive", "raw"], [F.col("o_loc").desc_nulls_last(), F.col("o_name")])
    frames = marked.join(capped.select("archive", "folder"), ["archive", "folder"])
    ids = naming.archive_ids(F.col("archive"))
    by_name = naming.NAME_POLICY["preprocess"].get(opts.institution) == "mrn-accession"
    tag = lambda c: F.coalesce(F.col(c), F.lit("unknown"))
    frames = frames.withColumns({
        "institution": F.lit(opts.institution), "mrn": F.coalesce(ids["mrn"], tag("mrn_tag")) if by_name else tag("mrn_tag"),
        "accession": F.coalesce(ids["accession"], tag("accession_tag")) if by_name else tag("accession_tag"), "series": naming.clean_series(F.col("raw")),
    })
    key = ["archive", "raw"]
    ragged = F.size(F.collect_set(F.struct("h", "w")).over(Window.partitionBy(*key))) > 1
    frames = frames.withColumn("ragged", ragged)
    for c in ("institution", "mrn", "accession"):  # one identity per series: that of its first frame
        frames = frames.withColumn(c, F.first(c).over(Window.partitionBy(*key).orderBy(natural_key(F.col("folder")), natural_key(F.col("member"))).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    w2 = Window.partitionBy(*key).orderBy("slice_location", natural_key(F.col("instance_number")).asc_nulls_first(), natural_key(F.col("member")), natural_key(F.col("folder")))
    frames = frames.withColumn("frame_idx", F.row_number().over(w2) - 1)
    unit = lambda *c: F.concat_ws("/", *c)
    out = (
        head.where("status is not null").select(unit("archive", "folder", "member").alias("unit"), "status", F.lit("").alias("detail"))
        .union(folders.where("left_out is not null").select(unit("archive", "folder"), "left_out", "raw"))
        .union(frames.where("ragged").select(unit("archive", "raw"), F.lit("ragged"), F.lit("")).distinct())
        .union(head.select("archive").distinct().join(capped.select("archive").distinct(), "archive", "left_anti").select("archive", F.lit("empty"), F.lit("")))
    )
    return frames.where("not ragged"), out


def _plane(content: bytes, opts: Options) -> tuple[np.ndarray | None, str | None]:
    """(plane resized and cropped, status) of one file."""
    try:
        head, array = dicom.pixels(content)
        if head.get("PhotometricInterpretation") == "RGB" and array.ndim == 2:
            array = None
        plane = None if array is None else pixels.as_plane(array, opts.colour)
        return (None, "unsupported_rank") if plane is None else (pixels.fit_frame(plane, opts.frame_size).astype("<f4"), None)
    except (dicom.DicomError, ValueError):
        return None, "decode_error"


def _decode_archive(archive: str, steps: list[dict], opened: Opened, opts: Options) -> Iterator[tuple]:
    """Rows of DECODED for the planned frames of one archive, scaled by the bounds of their series.

    Planes are held until the bounds are known; an archive with more than ``HELD_BYTES`` of them is read
    twice, once for the bounds.
    """
    wanted = {(s["folder"], s["member"]): s for s in steps}
    held: dict[tuple, np.ndarray] = {}
    found: dict[tuple, tuple[float, float] | str] = {}
    room, spilled = HELD_BYTES, False
    for folder, member, content, _ in opened():
        step = wanted.get((folder, member))
        if step is None or (folder, member) in found:
            continue
        plane, status = _plane(content, opts)
        if plane is None:
            found[folder, member] = status
            continue
        found[folder, member] = float(plane.min()), float(plane.max())
        room -= plane.nbytes
        spilled = spilled or room < 0
        if spilled:
            held.clear()
        else:
            held[folder, member] = plane
    bounds: dict[str, tuple[float, float]] = {}
    counts: dict[str, int] = {}
    place: dict[tuple, int] = {}
    for s in sorted(steps, key=lambda s: s["frame_idx"]):
        at, raw = (s["folder"], s["member"]), s["raw"]
        if at in place:  # a member that an archive has twice counts once
            continue
        got = found.setdefault(at, "decode_error")
        if isinstance(got, tuple):
            low, high = bounds.get(raw, got)
            bounds[raw] = min(low, got[0]), max(high, got[1])
            place[at] = counts.get(raw, 0)
            counts[raw] = place[at] + 1

    def row(at: tuple, plane: np.ndarray | None) -> tuple:
        s = wanted[at]
        known = (archive, *(s[k] for k in ("raw", "institution", "mrn", "accession", "series", "slice_location", "frame_idx")))
        if plane is None:
            return (*known, None, None, None, None, None, None, None, found[at])
        low, high = bounds[s["raw"]]
        grey = opts.channels == "grey"
        data = pixels.to_u8(plane.ravel(), low, high) if grey else plane
        return (*known, place[at], *plane.shape, "u1" if grey else "f4", data.tobytes(), *found[at], None)

    for at, got in found.items():
        if not isinstance(got, tuple):
            yield row(at, None)
    if not spilled:
        yield from (row(at, plane) for at, plane in held.items())
        return
    done = set()
    for folder, member, content, _ in opened():
        at = (folder, member)
        if at in place and at not in done:
            done.add(at)
            yield row(at, _plane(content, opts)[0])


def decode(members: DataFrame | ArchiveFiles, frames: DataFrame, opts: Options) -> DataFrame:
    """Rows of DECODED: the planned frames resized, cropped and scaled, numbered in their series without gaps, or with a status."""
    plan = frames.groupBy("archive").agg(F.collect_list(F.struct(*STEP)).alias("steps"))
    if isinstance(members, ArchiveFiles):
        return members.map(lambda archive, steps, opened: _decode_archive(archive, steps, opened, opts), DECODED, plan)

    def run(key: tuple, rows: pa.Table, steps: pa.Table) -> pa.Table:
        if not steps.num_rows or not rows.num_rows:
            return DECODED.empty_table()
        opened = lambda: zip(*(rows.column(c).to_pylist() for c in ("folder", "member", "content", "status")))
        return pa.Table.from_batches(list(batched(_decode_archive(key[0].as_py(), steps.column("steps")[0].as_py(), opened, opts), DECODED)), DECODED)

    return members.select("archive", "folder", "member", "content", "status").groupBy("archive").cogroup(plan.groupBy("archive")).applyInArrow(run, spark_schema(DECODED))


def extract_views(members: DataFrame | ArchiveFiles, opts: Options, view_map: DataFrame, views: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Like ``run``, for the series that a map of (series_description, view, ord) gives the wanted views.

    Of several series of one view in a study the first in the map's order is taken.
    """
    return run(members, opts, view_map.where(F.col("view").isin(views)))


def _of_views(frames: DataFrame, view_map: DataFrame) -> DataFrame:
    series = frames.select("archive", "raw").distinct().join(view_map.select(F.col("series_description").alias("raw"), "view", "ord"), "raw")
    first = Window.partitionBy("archive", "view").orderBy("ord", "raw")
    return frames.join(series.withColumn("__rn", F.row_number().over(first)).where("__rn = 1").select("archive", "raw"), ["archive", "raw"], "left_semi")


def run(members: DataFrame | ArchiveFiles, opts: Options, view_map: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(frames, series, outcomes) in the schemas of the store, with the archive each came from.

    total_images counts the listed files, also those that could not be decoded; frames are numbered
    without gaps. Slice boundaries are found over the decoded frames.
    """
    planned, left_out = plan_frames(headers(members), opts)
    planned = stored(planned if view_map is None else _of_views(planned, view_map), "plan")
    done = stored(decode(members, planned, opts), "decoded")
    good = done.where("status is null")
    key = ["archive", "raw"]
    slices = ordering.slice_boundaries(good, key, F.col("slice_location"), [F.col("i")])
    totals = planned.groupBy(*key).agg(F.count(F.lit(1)).cast("int").alias("total_images"))
    stats = good.groupBy(*key, "institution", "mrn", "accession", "series").agg(F.min("low").alias("vmin"), F.max("high").alias("vmax"))
    series = stored(stats.join(totals, key).join(slices, key), "series").select(
        "archive", "raw", "institution", "mrn", "accession", "series", "total_images", F.col("n_frames").cast("int").alias("n_frames"), "slice_frames", "vmin", "vmax"
    )
    frames = good.select("archive", "institution", "mrn", "accession", "series", F.col("i").alias("frame_idx"), "h", "w", "dtype", "pixels")
    failed = done.where("status is not null").select(F.concat_ws("/", "archive", "raw", F.col("frame_idx").cast("string")).alias("unit"), "status", F.lit("").alias("detail"))
    lost = planned.select(*key).distinct().join(series.select(*key), key, "left_anti").select(F.concat_ws("/", *key), F.lit("invalid_array"), F.lit(""))
    return frames, series.drop("raw"), left_out.union(failed).union(lost)


def audit(archives: DataFrame, series: DataFrame, institution: str) -> DataFrame:
    """Archives (``filenames``) that no stored file came from."""
    from ..sources.store import relpath

    done = series.where(F.col("institution") == institution).select(naming.processed_name(F.regexp_replace(relpath(), f"^{institution}_", "x_"), institution).alias("filenames"))
    return cut(reconcile.incomplete(archives, done, "filenames"))
