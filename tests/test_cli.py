"""The command line over small files."""

import pytest

from scanloom import __main__ as cli
from scanloom.plans import catalog
from scanloom.sources import archives, tabular
from tests.test_preprocess import folder, frame, tgz  # noqa: F401


@pytest.fixture(autouse=True)
def session(spark, monkeypatch):
    monkeypatch.setattr(cli, "_spark", lambda: spark)
    monkeypatch.setattr(cli, "clear_scratch", lambda _: 0)


def rows(spark, path):
    return [r.asDict() for r in tabular.read_csv(spark, str(path)).collect()]


def test_preprocess_dedup_checksum(spark, folder, tmp_path):  # noqa: F811
    at = f"{tmp_path}/store"
    cli.main(["preprocess", "--root", folder, "--output", at, "--institution", "medstar", "--framesize", "original", "--channels", "grey"])
    cli.main(["preprocess", "--root", folder, "--output", at, "--institution", "medstar", "--audit"])
    assert {r["filenames"] for r in rows(spark, f"{at}/incomplete")} == {"M2-A2.tgz", "bad.tgz"}
    cli.main(["dedup", "--input", at, "--output", f"{tmp_path}/d", "--min-series", "1", "--label", "one"])
    prints = rows(spark, f"{tmp_path}/d/fingerprints")
    assert {r["frame_pos"] for r in prints} == {"first", "middle", "last"} and rows(spark, f"{tmp_path}/d/duplicates") == []
    cli.main(["dedup", "--fingerprints", f"{tmp_path}/d/fingerprints", "--reference", f"{tmp_path}/d/fingerprints", "--output", f"{tmp_path}/e", "--min-series", "1"])
    cli.main(["checksum", "--input", at, "--output", f"{tmp_path}/c"])
    cli.main(["checksum", "--input", at, "--output", f"{tmp_path}/c2", "--compare", f"{tmp_path}/c/checksums"])
    (tmp_path / "old.csv").write_text("file,checksum\nmedstar_M1/A-1.h5,0\n")
    with pytest.raises(SystemExit):
        cli.main(["checksum", "--input", at, "--output", f"{tmp_path}/c3", "--compare", f"{tmp_path}/old.csv"])
    cli.main(["counts", "--root", at, "--output", f"{tmp_path}/n"])
    assert rows(spark, f"{tmp_path}/n/counts") == [{"relpath": "medstar_M1/A-1.h5", "n_boundaries": "2", "n_slices": "3", "n_frames": "5"}]


def test_crosswalk(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Patient ID,Study ID,Note\n007,S1,x\n007,S2,y\n")
    (tmp_path / "b.csv").write_text("Patient ID,Study ID,Note\n007,S3,x\n8,S4,y\n")
    cli.main(["crosswalk", "--input", f"{tmp_path}/a.csv", "--output", str(tmp_path), "--label", "one"])
    cli.main(["crosswalk", "--input", f"{tmp_path}/b.csv", "--prior", f"{tmp_path}/one_concat_full", "--output", str(tmp_path), "--label", "two"])
    full = rows(spark, f"{tmp_path}/two_concat_full")
    assert len(full) == 4 and len({r["anon_mrn"] for r in full if r["Patient ID"] == "007"}) == 1 and {r["batch"] for r in full} == {"one", "two"}
    assert len(rows(spark, f"{tmp_path}/two_batch_anon")) == 2


def test_copy(spark, tmp_path):
    (tmp_path / "s/inst_m1").mkdir(parents=True)
    (tmp_path / "s/inst_m1/a1.h5").write_bytes(b"data")
    (tmp_path / "x.csv").write_text("anon_mrn,anon_accession,crosswalk_mrn,crosswalk_accession\nm1,a1,X1,Y1\nm2,a2,X2,Y2\nm3,a3,,Y3\n")
    cli.main(["copy", "--source", f"{tmp_path}/s", "--output", f"{tmp_path}/o", "--crosswalk", f"{tmp_path}/x.csv"])
    assert (tmp_path / "o/X1/Y1.h5").read_bytes() == b"data"
    assert sorted(r["status"] for r in rows(spark, f"{tmp_path}/o/_outcomes")) == ["copied", "not_found", "skipped_no_id"]


def test_metadata_and_tar(spark, folder, tmp_path):  # noqa: F811
    cli.main(["metadata", "--root", folder, "--output", f"{tmp_path}/m", "--institution", "medstar", "--summarize"])
    found = rows(spark, f"{tmp_path}/m/catalog")
    assert {(r["mrn"], r["accession"], r["series_description"]) for r in found} == {("M1", "A-1", "SAX_4_3"), ("M1", "A-1", "x_InlineVF_y"), ("M1", "A-1", "RAG")}
    one = catalog.catalog(archives.members(spark, folder), "x", ["scanner:ManufacturerModelName"]).collect()
    assert [(r.mrn, r.accession, r.scanner) for r in one] == [("007", "ACC", None)]
    study = tmp_path / "flat" / "study1"
    study.mkdir(parents=True)
    (study / "1.dcm").write_bytes(frame("A b", 1.0, 1, 0))
    (study / "2.dcm").write_bytes(frame("C", 1.0, 1, 0))
    for mode, name, folders in (("penn", "007-ACC.tgz", {"A_b", "C"}), ("simple", "study1.tgz", {""}), ("reset_dicom_meta", "study1.tgz", {""})):
        cli.main(["tar", "--root", f"{tmp_path}/flat", "--output", f"{tmp_path}/{mode}", "--mode", mode])
        back = archives.members(spark, f"{tmp_path}/{mode}").collect()
        assert {r.archive for r in back} == {name} and {r.folder for r in back} == folders
    from scanloom.sources import dicom

    assert dicom.header(bytes(back[0].content))["AccessionNumber"] == "scandata"
    assert dicom.header((study / "1.dcm").read_bytes())["AccessionNumber"] == "ACC"


def test_chunks(tmp_path, capsys):
    (tmp_path / "l.bulk").write_text("1 a\n" * 25)
    cli.main(["chunks", "--bulk", f"{tmp_path}/l.bulk", "--size", "10"])
    assert "21" in capsys.readouterr().out
