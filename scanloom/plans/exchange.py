"""Queries that go through files: stores, anonymised archives in every mode, verified copies, delimited tables; with their DuckDB counterparts."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import naming
from ..operators import resolve
from ..operators.checksum import stream_digest
from ..session import scratch_path, stored, table
from ..sinks.archives import write_archives
from ..sinks.store import copy_verified, write_store
from ..sources import dicom, store, tabular
from ..sources.archives import MEMBERS, ArchiveFiles
from . import anonymise, preprocess

#: A study per label of the embeddings, a file per vector, under these archive names.
_ZIP_NAME = "{}_20209_2_0.zip"
_MODE_NAMES = {m: (_ZIP_NAME if m == "ukbiobank" else "M{}-A-{}.tgz") for m in anonymise.MODES}


def _studies(spark: SparkSession, d: str, name: str) -> DataFrame:
    def run(batches):
        for b in batches:
            out = []
            for vec, plane, label in zip(b["vec_id"], b["embedding"], b["label"]):
                if vec is None or plane is None or len(plane) != 64 or label is None or label != label:
                    continue
                array = np.trunc((np.asarray(plane, np.float64) + 2) * 1000).astype("<u2").reshape(8, 8)
                label = int(label)
                tags = {"SeriesDescription": f"view {label}", "InstanceNumber": int(vec), "PatientID": f"P{label}", "AccessionNumber": f"N{label}", "PatientName": f"X^{label}", "StudyInstanceUID": f"1.2.{label}"}
                out.append((name.format(label, label), "study", f"{int(vec)}.dcm", dicom.build(tags, array), None))
            yield pd.DataFrame(out, columns=["archive", "folder", "member", "content", "status"])

    return table(spark, d, "embeddings").select("vec_id", "embedding", "label").mapInPandas(run, MEMBERS)


def _crosswalk(spark: SparkSession, d: str, mode: str) -> DataFrame | None:
    """Two rows per study, of which the first counts."""
    labels = table(spark, d, "embeddings").select(F.col("label").cast("string").alias("l")).where("l is not null").distinct().withColumn("n", F.explode(F.array(F.lit(1), F.lit(2))))
    keys = {"anonymize": {"accession": F.concat(F.lit("N"), "l")}, "segmed": {"Study ID": F.concat(F.lit("1.2."), "l")}, "dasa": {"accession": F.concat(F.lit("P"), "l")}, "ukbiobank": {"f.eid": F.col("l"), "instance": F.lit("2")}}
    if mode not in keys:
        return None
    mrn, acc = anonymise.MODES[mode].anon
    ids = {mrn: F.when(F.col("n") == 1, F.concat(F.lit("z"), "l")).otherwise(F.concat(F.lit("b"), "l")), acc: F.when(F.col("n") == 1, F.concat(F.lit("c"), "l")).otherwise(F.concat(F.lit("y"), "l"))}
    return labels.select(*[c.alias(k) for k, c in (keys[mode] | ids).items()], "n")


def anonymise_modes(spark: SparkSession, d: str) -> DataFrame:
    """Every file of every study as each mode wrote it: archive, folder, name and tags, read back from the archives."""
    out = None
    for mode in anonymise.MODES:
        target = scratch_path(spark, f"anonymised-{mode}")
        xw = _crosswalk(spark, d, mode)
        done = stored(anonymise.run(_studies(spark, d, _MODE_NAMES[mode]), mode, target, xw, "n" if xw is not None else None), "outcomes")
        if not done.where("status = 'written'").head(1):
            continue
        back = preprocess.headers(ArchiveFiles.below(spark, target)).select(F.lit(mode).alias("mode"), "archive", "folder", "member", F.col("mrn_tag").alias("mrn"), F.col("accession_tag").alias("accession"))
        out = back if out is None else out.union(back)
    return out if out is not None else spark.createDataFrame([], "mode string, archive string, folder string, member string, mrn string, accession string")


def _modes_sql() -> str:
    named, tagged = "'M' || l || '-A-' || l || '.tgz'", "'P' || l || '-N' || l || '.tgz'"
    first, flat = "'z' || l || '-c' || l || '.tgz'", "vec_id || '.dcm'"
    own, given = "'P' || l, 'N' || l", "'z' || l, 'c' || l"
    rows = {
        "simple": (named, "'study'", flat, own), "dicom": (tagged, "'study'", flat, own), "anonymize": (first, "'study'", flat, own),
        "reset_dicom_meta": (named, "'study'", flat, "'P' || l, 'scandata'"), "penn": (tagged, "'view_' || l", f"'study_' || {flat}", own),
        "segmed": (first, "'study'", flat, given), "dasa": (first, "'study'", flat, given), "ukbiobank": (first, "'view_' || l", f"'study_' || {flat}", given),
    }
    parts = [f"select '{m}' as mode, {a} archive, {f} folder, {n} as member, {t} from e" for m, (a, f, n, t) in rows.items()]
    return f"with e as (select vec_id, label::varchar l from embeddings) select * from ({' union all '.join(parts)}) x(mode, archive, folder, member, mrn, accession)"


def copied_files(spark: SparkSession, d: str) -> DataFrame:
    """The outcome of every row of a copy list: files made here under their stored paths, copied under their new names and read back."""
    at, to = scratch_path(spark, "copy-from"), scratch_path(spark, "copy-to")
    files = table(spark, d, "store_files").select("relpath").where("relpath is not null").distinct()
    rows = table(spark, d, "copy_crosswalk").select("row_id", *[F.col(c) for c in ("anon_mrn", "anon_accession", "crosswalk_mrn", "crosswalk_accession")])
    found = resolve.resolve_files(rows, files, "row_id", "anon_mrn", "anon_accession", ["crosswalk_mrn", "crosswalk_accession"])
    named = stored(found.join(rows.select("row_id", F.concat(F.col("row_id").cast("string"), F.lit("/f"), F.regexp_replace("crosswalk_accession", "[^A-Za-z0-9]", "_"), F.lit(".h5")).alias("new_path")), "row_id"), "named")

    def make(batches):
        from ..sources.files import filesystem

        system, root = filesystem(at)
        for b in batches:
            for path in b["relpath"]:
                system.create_dir(f"{root}/{path.rsplit('/', 1)[0]}" if "/" in path else root, recursive=True)
                with system.open_output_stream(f"{root}/{path}") as f:
                    f.write(path.encode())
            yield b

    made = stored(files.join(named.where("status = 'found'").select("relpath"), "relpath", "left_semi").mapInPandas(make, "relpath string"), "made")
    if not made.head(1):
        return named.select("row_id", "status", F.lit(None).cast("string").alias("content"))
    done = stored(copy_verified(named, at, to), "copied")
    if not done.where("status = 'copied'").head(1):
        return done.select("row_id", "status", F.lit(None).cast("string").alias("content"))
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(to)
    parts = F.split("path", "/")
    read = read.select(F.element_at(parts, -2).cast("bigint").alias("row_id"), F.decode("content", "UTF-8").alias("content"))
    return done.select("row_id", "status").join(read, "row_id", "left")


_COPY_SQL = """with f as (select distinct split_part(relpath, '/', 1) folder, regexp_replace(split_part(relpath, '/', 2), '\\.h5$', '') acc, relpath from store_files),
j as (select r.row_id, any_value(crosswalk_mrn is not null and crosswalk_accession is not null) ok, count(relpath) n, min(relpath) p from copy_crosswalk r
left join f on crosswalk_mrn is not null and crosswalk_accession is not null and anon_accession = acc and ends_with(folder, '_' || anon_mrn) group by r.row_id)
select row_id, case when not ok then 'skipped_no_id' when n = 0 then 'not_found' when n > 1 then 'ambiguous' else 'copied' end status, case when ok and n = 1 then p end as content from j"""


def csv_tables(spark: SparkSession, d: str) -> DataFrame:
    """The catalogue written as delimited text and read back: all text, words for missing are NULL."""
    at = scratch_path(spark, "csv")
    tabular.write_csv(table(spark, d, "metadata_catalog").select(F.col("row_id").cast("string").alias("row_id"), "mrn", "accession", "series_description", "field_strength"), at)
    return tabular.read_csv(spark, at)


def _csv_sql() -> str:
    words = ", ".join(f"'{w}'" for w in tabular.MISSING)
    cols = ("mrn", "accession", "series_description", "field_strength")
    return f"select row_id::varchar row_id, {', '.join(f'case when {c} not in ({words}) then {c} end {c}' for c in cols)} from metadata_catalog"


def manifest_defaults(spark: SparkSession, d: str) -> DataFrame:
    """A manifest without some columns, loaded into the fixed ones with their defaults."""
    return tabular.load_manifest(table(spark, d, "fp_manifest").select("relpath", "series", "n_frames", "fp_hex"), "lab")


def zip_participants(spark: SparkSession, d: str) -> DataFrame:
    """Zip members of one participant out of all archives written here, by the id before the first underscore."""
    target = scratch_path(spark, "zips")
    rows = _studies(spark, d, _ZIP_NAME).select(F.regexp_replace("archive", "zip$", "tgz").alias("name"), "folder", "member", "content")
    if not stored(write_archives(rows, target), "outcomes").where("status = 'written'").head(1):
        return spark.createDataFrame([], "archive string, eid string, instance string, member string")
    heads = preprocess.headers(ArchiveFiles.below(spark, target))
    ids = naming.zip_ids(F.col("archive"))
    return heads.select("archive", ids["eid"].alias("eid"), ids["instance"].alias("instance"), "member")


def _store(spark: SparkSession, d: str) -> str | None:
    """A store of the studies, written twice under one batch name, which must change nothing."""
    at = scratch_path(spark, "store")
    frames, series, _ = preprocess.run(_studies(spark, d, "M{}-A-{}.tgz"), preprocess.Options("medstar", frame_size=None, channels="grey"))
    if not series.head(1):
        return None
    write_store(frames, series, at)
    write_store(frames, series, at)
    return at


def stored_series(spark: SparkSession, d: str) -> DataFrame:
    """The catalogue of a written store with the attributes of its series."""
    at = _store(spark, d)
    if at is None:
        return spark.createDataFrame([], "relpath string, series string, total_images int, n_frames int, slice_frames string")
    series = store.read_series(spark, at).withColumn("relpath", store.relpath())
    listed = store.catalog(store.read_series(spark, at))
    return listed.join(series, ["relpath", "series"]).select("relpath", "series", "total_images", "n_frames", F.array_join(F.transform("slice_frames", lambda x: x.cast("string")), ",").alias("slice_frames"))


def stored_checksums(spark: SparkSession, d: str) -> DataFrame:
    """The digest of every stored file over its planes in order."""
    at = _store(spark, d)
    if at is None:
        return spark.createDataFrame([], "file string, checksum string")
    frames = store.read_frames(spark, at, "med").withColumn("file", store.relpath())
    return stream_digest(frames, ["file"], ["series", "frame_idx"], "pixels").withColumnRenamed("digest", "checksum")


def stored_audit(spark: SparkSession, d: str) -> DataFrame:
    """Archives that no stored file came from: of each study's archive and one more that was never read."""
    at = _store(spark, d)
    names = table(spark, d, "embeddings").where("label is not null").select(F.explode(F.array(F.format_string("M%d-A-%d.tgz", "label", "label"), F.format_string("M%d-B-%d.tgz", "label", "label"))).alias("filenames")).distinct()
    return names.limit(0) if at is None else preprocess.audit(names, store.read_series(spark, at), "medstar")


def stored_frames_at(spark: SparkSession, d: str) -> DataFrame:
    """One plane of each stored series, the second, as hex."""
    at = _store(spark, d)
    if at is None:
        return spark.createDataFrame([], "series string, frame_idx int, pixels string")
    return store.one_frame(store.read_frames(spark, at), 1).select("series", "frame_idx", F.lower(F.hex("pixels")).alias("pixels"))


_STORED_SQL = """with f as (select label, vec_id, list_transform(embedding, lambda x: trunc((x::double + 2) * 1000)) p from embeddings),
b as (select *, row_number() over (partition by label order by vec_id) - 1 i, min(list_min(p)) over (partition by label) lo, max(list_max(p)) over (partition by label) hi from f),
g as (select label, i, string_agg(lpad(lower(to_hex(x.v)), 2, '0'), '' order by x.j) pixels from b, lateral (select unnest(list_transform(p, lambda y: trunc((y - lo) / (hi - lo + 1e-8) * 255)::int)) v, generate_subscripts(p, 1) j) x group by label, i)"""


QUERIES = {"stored_series": stored_series, "stored_checksums": stored_checksums, "stored_audit": stored_audit, "stored_frames_at": stored_frames_at, "anonymise_modes": anonymise_modes, "copied_files": copied_files, "csv_tables": csv_tables, "manifest_defaults": manifest_defaults, "zip_participants": zip_participants}
SQL = {
    "stored_series": "select 'medstar_M' || label || '/A-' || label || '.h5' relpath, 'view_' || label series, count(*)::int total_images, count(*)::int n_frames, '' slice_frames from embeddings group by label",
    "stored_checksums": f"{_STORED_SQL} select 'medstar_M' || label || '/A-' || label || '.h5' file, sha256(unhex(string_agg(pixels, '' order by i))) checksum from g group by label",
    "stored_audit": "select distinct 'M' || label || '-B-' || label || '.tgz' filenames from embeddings",
    "stored_frames_at": f"{_STORED_SQL} select 'view_' || label series, i::int frame_idx, pixels from g where i = 1",
    "anonymise_modes": _modes_sql(), "copied_files": _COPY_SQL, "csv_tables": _csv_sql(),
    "manifest_defaults": "select 'lab' source, relpath, '' mrn, '' accession, series, '' frame_pos, n_frames, fp_hex from fp_manifest",
    "zip_participants": "select label || '_20209_2_0.tgz' archive, label::varchar eid, '2' as instance, vec_id || '.dcm' as member from embeddings",
}
