"""Archives to store: fixtures are small uncompressed DICOM files built here, with expectations by hand."""

import io
import tarfile
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from scanloom.functions import pixels
from scanloom.plans import anonymise, dedup, preprocess
from scanloom.sinks.store import write_store
from scanloom.sources import archives, dicom, store
from scanloom.streaming import ingest


def frame(series, loc, inst, value, acc="ACC", mrn="007", shape=(4, 4), **extra):
    array = (np.arange(shape[0] * shape[1], dtype="<u2").reshape(shape) + value).astype("<u2")
    tags = {"SeriesDescription": series, "PatientID": mrn, "AccessionNumber": acc, "InstanceNumber": inst, "PhotometricInterpretation": "MONOCHROME2", "StudyInstanceUID": "1.2.3", **extra}
    if loc is not None:
        tags["SliceLocation"] = loc
    return dicom.build(tags, array)


def tgz(path, files):
    with tarfile.open(path, "w:gz") as tar:
        for name, data in files.items():
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    at = tmp_path_factory.mktemp("archives")
    files = {}
    for k, (loc, inst) in enumerate([(2.0, 10), (2.0, 9), (1.0, 1), (1.0, 2), (3.0, 1)]):
        files[f"study/sax/img{k}.dcm"] = frame("SAX 4/3", loc, inst, k * 10)
    files["study/sax/broken.dcm"] = b"not dicom"
    files["study/overlay/a.dcm"] = frame("x InlineVF y", 1.0, 1, 0)
    files["study/rag/a.dcm"] = frame("RAG", 1.0, 1, 0)
    files["study/rag/b.dcm"] = frame("RAG", 2.0, 2, 0, shape=(4, 6))
    files["../evil.dcm"] = frame("EVIL", 1.0, 1, 0)
    tgz(at / "M1-A-1.tgz", files)
    tgz(at / "M2-A2.tgz", {"s/n/readme.txt": b"hello"})
    (at / "bad.tgz").write_bytes(b"no archive")
    return str(at)


def test_members_are_read_safely(spark, folder):
    rows = archives.members(spark, folder).collect()
    names = {(r.archive, r.folder, r.member) for r in rows}
    assert ("M1-A-1.tgz", "study/sax", "img0.dcm") in names
    assert not any(r.member == "evil.dcm" for r in rows)
    assert [r.status for r in rows if r.archive == "bad.tgz"] == ["exception: ReadError"]
    by_path = archives.members(spark, folder, by_path=True)
    assert by_path.where("status is null").count() == sum(r.status is None for r in rows)


def test_pipeline(spark, folder, tmp_path):
    opts = preprocess.Options("medstar", frame_size=None, channels="grey")
    frames, series, out = preprocess.run(archives.members(spark, folder), opts)
    s = series.collect()
    assert [(r.mrn, r.accession, r.series, r.total_images, r.n_frames, r.slice_frames) for r in s] == [("M1", "A-1", "SAX_4_3", 5, 5, [1, 3])]
    order = [bytes(r.pixels)[0] for r in frames.orderBy("frame_idx").collect()]
    lows = [20, 30, 10, 0, 40]  # by location, then instance as a number: 1, 2, then 9 before 10, then 3
    assert order == [int(v / (55 + 1e-8) * 255) for v in lows]
    statuses = {(r.unit, r.status) for r in out.collect()}
    assert ("M1-A-1.tgz/study/overlay", "skipped_overlay") in statuses
    assert ("M1-A-1.tgz/RAG", "ragged") in statuses
    assert ("M1-A-1.tgz/study/sax/broken.dcm", "unreadable_header") in statuses
    assert ("M2-A2.tgz", "empty") in statuses
    at = f"file://{tmp_path}/store"
    assert [r.status for r in write_store(frames, series, at).collect()] == ["written"]
    assert [r.status for r in write_store(frames, series, at).collect()] == ["already_exists"]
    assert store.read_frames(spark, at, "med").count() == 5 and store.read_frames(spark, at, "x").count() == 0
    assert store.catalog(store.read_series(spark, at)).collect()[0].relpath == "medstar_M1/A-1.h5"
    left = preprocess.audit(spark.createDataFrame([("M1-A-1.tgz",), ("M2-A2.tgz",)], "filenames string"), store.read_series(spark, at), "medstar")
    assert [r.filenames for r in left.collect()] == ["M2-A2.tgz"]
    manifest = dedup.fingerprint_manifest(store.read_frames(spark, at), store.read_series(spark, at), "new").orderBy("frame_pos").collect()
    assert [(r.frame_pos, r.n_frames, len(r.fp_hex)) for r in manifest] == [("first", 5, 256), ("last", 5, 256), ("middle", 5, 256)]


def test_resized_frames_keep_the_crop(spark, folder):
    frames, _, _ = preprocess.run(archives.members(spark, folder), preprocess.Options("medstar", frame_size=8))
    assert {(r.h, r.w, r.dtype) for r in frames.collect()} == {(6, 6, "f4")}


def test_stream_reads_each_archive_once(spark, folder, tmp_path):
    at, ck = f"file://{tmp_path}/store", f"file://{tmp_path}/ck"
    opts = preprocess.Options("medstar", frame_size=None)
    for _ in range(2):
        ingest.start(spark, folder, at, ck, opts).awaitTermination()
    assert store.read_series(spark, at).count() == 1
    assert spark.read.parquet(f"{at}/outcomes").where("status = 'written'").count() == 1


@pytest.mark.parametrize("implicit", [False, True])
def test_dicom_round_trip(implicit):
    array = np.arange(12, dtype="<u2").reshape(3, 4)
    data = dicom.build({"PatientID": "00012", "AccessionNumber": "A"}, array, implicit)
    head, back = dicom.pixels(data)
    assert head["PatientID"] == "00012" and (back == array).all()
    again = dicom.rewrite(data, {"PatientID": "anonymous", "PatientName": "redacted_x"})
    head, back = dicom.pixels(again)
    assert head["PatientID"] == "anonymous" and head["PatientName"] == "redacted_x" and head["AccessionNumber"] == "A" and (back == array).all()
    assert dicom.header(data)["PatientID"] == "00012"
    for cut in (0, 100, 140, len(data) - 3):
        with pytest.raises(dicom.DicomError):
            dicom.pixels(data[:cut])


def test_anonymise_holds_back_what_the_crosswalk_lacks(spark, folder, tmp_path):
    members = archives.members(spark, folder)
    xw = spark.createDataFrame([("ACC", "am", "aa")], "accession string, anon_mrn string, anon_accession string")
    out = {(r.unit, r.status) for r in anonymise.run(members, "anonymize", f"{tmp_path}/a", xw).collect()}
    assert ("am-aa.tgz", "written") in out and ("M2-A2.tgz", "unreadable_header") in out
    other = spark.createDataFrame([("AC", "am", "aa")], "accession string, anon_mrn string, anon_accession string")
    out = {(r.unit, r.status) for r in anonymise.run(members, "anonymize", f"{tmp_path}/b", other).collect()}
    assert ("M1-A-1.tgz", "not_in_crosswalk") in out and not any(s == "written" for _, s in out)
    with pytest.raises(ValueError):
        anonymise.run(members, "unknown", "x")


def test_anonymise_rewrites_and_regroups(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "123_20209_2_0.zip", "w") as z:
        z.writestr("a.dcm", frame("LAX", 1.0, 1, 0))
        z.writestr("b.dcm", frame("SAX x", 1.0, 1, 0))
    with zipfile.ZipFile(tmp_path / "1234_20209_2_0.zip", "w") as z:
        z.writestr("a.dcm", frame("LAX", 1.0, 1, 0))
    rows = archives.of_eid(archives.members(spark, str(tmp_path), "zip"), "123")
    assert {r.archive for r in rows.collect()} == {"123_20209_2_0.zip"}
    xw = spark.createDataFrame([("123", "2", "m1", "a1")], ["f.eid", "instance", "anon_mrn", "anon_accession"])
    out = anonymise.run(rows, "ukbiobank", f"{tmp_path}/out", xw).collect()
    assert [(r.unit, r.status) for r in out] == [("m1-a1.tgz", "written")]
    back = archives.members(spark, f"{tmp_path}/out").collect()
    assert {(r.folder, r.member) for r in back} == {("LAX", "a.dcm"), ("SAX_x", "b.dcm")}
    head = dicom.header(bytes(back[0].content))
    assert (head["PatientID"], head["AccessionNumber"], head["PatientName"]) == ("m1", "a1", "redacted_m1")


def test_pixel_kernels():
    assert pixels.crop_side(480) == 360
    assert pixels.to_u8(np.array([0.0, 200.9, 255.0])).tolist() == [0, 200, 254] or pixels.to_u8(np.array([0.0, 200.9, 255.0])).tolist() == [0, 200, 255]
    assert pixels.fingerprint(np.full((9, 9), 7.0)) is None
    ramp = np.add.outer(np.arange(40.0), np.arange(40.0))
    a, b = pixels.fingerprint(ramp), pixels.fingerprint(ramp * 3 + 5)
    assert a == b and len(a) == 128
    noisy = ramp.copy()
    noisy[3, 3] += 1
    d = np.unpackbits(np.frombuffer(a, "u1") ^ np.frombuffer(pixels.fingerprint(noisy), "u1")).sum()
    assert d <= 64
    assert pixels.as_plane(np.zeros((4, 4, 3))) is None and pixels.as_plane(np.ones((4, 4, 3)), True).shape == (4, 4)
    assert pixels.resize(np.ones((5, 7)), 3, 9) == pytest.approx(1)
    assert pixels.centre_crop(np.arange(36).reshape(6, 6), 2).tolist() == [[14, 15], [20, 21]]


def test_duplicate_report(spark):
    code = "0f" * 128
    near = "0e" + "0f" * 127
    rows = [("new", f"f{i}.h5", "m", "a", f"s{k}", "first", 9, c) for i, c in ((1, code), (2, near), (3, "f0" * 128)) for k in range(5)]
    rows.append(("new", "f4.h5", "m", "a", "s", "first", 9, ""))
    manifest = spark.createDataFrame(rows, "source string, relpath string, mrn string, accession string, series string, frame_pos string, n_frames int, fp_hex string")
    dup, flagged = dedup.report(manifest)
    d = dup.collect()
    assert [(r.file_a, r.file_b, r.matching_series, r.match_fraction, r.min_hamming, r.matching_frames) for r in d] == [("f1.h5", "f2.h5", 5, 1.0, 1, 25)]
    assert [(r.relpath, r.cluster_id, r.n_partners) for r in flagged.collect()] == [("f1.h5", 1, 1), ("f2.h5", 1, 1)]
    assert {r.status for r in dedup.skipped(manifest, 3).collect()} == {"bucket_skipped"} and dedup.skipped(manifest, 100).count() == 0
    old = manifest.withColumn("source", F.lit("old"))
    only_new, _ = dedup.report(manifest.where("relpath = 'f3.h5'"), old)
    assert {(r.source_a, r.source_b) for r in only_new.collect()} == {("new", "old")}
    with pytest.raises(ValueError):
        dedup.report(manifest.withColumn("fp_hex", F.lit("ab" * 32)))


def test_views_are_extracted_in_map_order(spark, folder):
    view_map = spark.createDataFrame([("RAG", "V", 1), ("SAX 4/3", "W", 2), ("x InlineVF y", "W", 1)], "series_description string, view string, ord int")
    opts = preprocess.Options("medstar", frame_size=None)
    members = archives.members(spark, folder)
    assert [r.series for r in preprocess.extract_views(members, opts, view_map, ["W"])[1].collect()] == ["SAX_4_3"]
    assert preprocess.extract_views(members, opts, view_map, ["none"])[1].count() == 0


def test_array_layouts():
    a = np.arange(2 * 3 * 4 * 5).reshape(2, 3, 4, 5)
    assert (pixels.frames_first(a, "cine0", 1) == a[:, 1]).all() and (pixels.frames_first(a, "cine1", 1) == a[1]).all()
    assert pixels.frames_first(a[0, 0], "single").shape == (1, 4, 5) and pixels.frames_first(a[0], "channels_first").shape == (1, 4, 5)
    assert pixels.channels_last(a).shape == (2, 4, 5, 3) and pixels.three_channels(a[0, 0]).shape == (3, 4, 5)
    assert pixels.stack([bytes(4), bytes(4)], 2, 2, "u1").shape == (2, 2, 2)
    pixels.check_channels((7, 4, 5), "grey"), pixels.check_channels((7, 3, 4, 5), "rgb")
    for shape, c in (((7, 3, 4, 5), "grey"), ((7, 1, 4, 5), "rgb"), ((4, 5), "rgb")):
        with pytest.raises(ValueError):
            pixels.check_channels(shape, c)


def _rows(df):
    return sorted(map(str, df.collect()))


def test_archives_by_path_equal_archives_by_content(spark, folder, monkeypatch):
    opts = preprocess.Options("medstar", frame_size=None, channels="grey")
    by_content = preprocess.run(archives.members(spark, folder), opts)
    by_path = preprocess.run(archives.ArchiveFiles.below(spark, folder), opts)
    assert [_rows(x) for x in by_path] == [_rows(x) for x in by_content]
    heads = preprocess.headers(archives.ArchiveFiles.below(spark, folder))
    planned, _ = preprocess.plan_frames(heads, opts)
    steps = [r.asDict() for r in planned.collect()]
    mine = [s for s in steps if s["archive"] == "M1-A-1.tgz"]
    path = archives.ArchiveFiles.below(spark, folder).files.where("path like '%M1-A-1.tgz'").first().path
    held = sorted(preprocess._decode_archive("M1-A-1.tgz", mine, archives.opened(path, "tar"), opts))
    monkeypatch.setattr(preprocess, "HELD_BYTES", 1)
    assert sorted(preprocess._decode_archive("M1-A-1.tgz", mine, archives.opened(path, "tar"), opts)) == held and held


def test_no_content_or_plane_is_shuffled(spark, folder):
    opts = preprocess.Options("medstar", frame_size=None)
    files = archives.ArchiveFiles.below(spark, folder)
    planned, _ = preprocess.plan_frames(preprocess.headers(files), opts)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = preprocess.decode(files, planned, opts)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    last = next(i for i, line in enumerate(lines) if "MapInArrow" in line)
    assert not any("Exchange" in line for line in lines[:last])  # what is decoded stays where it is
    assert not any("content" in line for line in lines[last + 1 :] if "Exchange" in line)


def test_a_failed_batch_leaves_no_double_frames(spark, folder, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter

    frames, series, _ = preprocess.run(archives.ArchiveFiles.below(spark, folder), preprocess.Options("medstar", frame_size=None))
    at, write = f"file://{tmp_path}/store", DataFrameWriter.parquet

    def failing(self, path, *args, **kw):
        if "/series/" in path:
            raise RuntimeError("lost")
        return write(self, path, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", failing)
    with pytest.raises(RuntimeError):
        write_store(frames, series, at)
    monkeypatch.undo()
    assert [r.status for r in write_store(frames, series, at).collect()] == ["written"]
    assert store.read_frames(spark, at).count() == 5 and store.read_series(spark, at).count() == 1
    assert [r.status for r in write_store(frames, series, at, batch="other").collect()] == ["already_exists"]
    assert store.read_frames(spark, at).count() == 5


def test_studies_of_one_name_are_held_back_and_names_stay_inside(spark, tmp_path):
    def member(archive, patient, accession):
        data = dicom.build({"PatientID": patient, "AccessionNumber": accession, "SeriesDescription": "s"}, np.zeros((2, 2), "<u2"))
        return (archive, "f", "a.dcm", data, None)

    rows = [member("x.tgz", "P", "A"), member("y.tgz", "P", "A"), member("z.tgz", "../../P/1", "A")]
    df = spark.createDataFrame(rows, archives.MEMBERS)
    out = {(r.unit, r.status) for r in anonymise.run(df, "dicom", f"{tmp_path}/in/out").collect()}
    assert out == {("x.tgz", "ambiguous"), ("y.tgz", "ambiguous"), ("__.._P_1-A.tgz", "written")}
    found = [p.name for p in tmp_path.rglob("*.tgz")]
    assert found == ["__.._P_1-A.tgz"] and (tmp_path / "in" / "out" / found[0]).exists()


def test_fingerprint_equals_a_plain_one():
    """The kernel against loops over single samples."""
    import math
    import random

    rng = random.Random(5)

    def shares(n, m, k):
        scale = n / m
        w = [max(0.0, 1 - abs(j + 0.5 - (k + 0.5) * scale) / max(scale, 1.0)) for j in range(n)]
        return [x / sum(w) for x in w]

    def resized(plane, m):
        rows, columns = [shares(len(plane), m, k) for k in range(m)], [shares(len(plane[0]), m, k) for k in range(m)]
        settle = lambda x: min(255, max(0, math.floor(x + 0.5)))
        across = [[settle(sum(a * b for a, b in zip(line, w))) for w in columns] for line in plane]
        return [[settle(sum(across[i][c] * w[i] for i in range(len(plane)))) for c in range(m)] for w in rows]

    for _ in range(2):
        plane = [[rng.randrange(1000) for _ in range(11)] for _ in range(9)]
        low, high = min(map(min, plane)), max(map(max, plane))
        grey = [[math.floor((x - low) / (high - low) * 255) for x in line] for line in plane]
        big = resized(grey, 160)
        near = lambda i: min(159, max(0, i))
        blur = [[math.floor(sum(big[near(y + i)][near(x + j)] for i in range(-3, 4) for j in range(-3, 4)) / 49 + 0.5) for x in range(160)] for y in range(160)]
        low, high = min(map(min, blur)), max(map(max, blur))
        wide = [[min(255, max(0, math.floor((x - low) * (255.0 / (high - low))))) for x in line] for line in blur]
        counts = [0] * 256
        for line in wide:
            for x in line:
                counts[x] += 1
        last = max(i for i in range(256) if counts[i])
        step = (160 * 160 - counts[last]) // 255
        even = [min(255, (step // 2 + sum(counts[:i])) // step) for i in range(256)]
        thumb = resized([[even[x] for x in line] for line in wide], 32)
        flat = sorted(x for line in thumb for x in line)
        median = (flat[511] + flat[512]) / 2
        want = "".join("1" if x > median else "0" for line in thumb for x in line)
        got = "".join(f"{b:08b}" for b in pixels.fingerprint(np.array(plane)))
        assert sum(a != b for a, b in zip(got, want)) <= 4  # sums in another order may round the other way
