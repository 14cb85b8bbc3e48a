"""Command line: python -m scanloom COMMAND ... (each command has --help)."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import crosswalk, ordering, profile, reconcile, resolve, rollup
from .plans import anonymise, dedup, preprocess
from .session import DEFAULTS, clear_scratch, stored
from .sinks.pictures import pictures
from .sinks.store import append_outcomes, copy_verified, export_video, write_store
from .sources import archives, store, tabular
from .streaming import ingest


def _spark() -> SparkSession:
    return SparkSession.builder.appName("scanloom").config(map=DEFAULTS).getOrCreate()


def run_preprocess(a: argparse.Namespace) -> None:
    spark = _spark()
    opts = preprocess.Options(a.institution, preprocess.frame_size_option(a.framesize), a.channels, a.colour)
    if a.stream:
        ingest.start(spark, a.root, a.output, f"{a.output}/_checkpoint", opts).awaitTermination()
        return
    if a.audit:
        found = archives.members(spark, a.root, by_path=a.by_path).select(F.col("archive").alias("filenames")).distinct()
        tabular.write_csv(preprocess.audit(found, store.read_series(spark, a.output), a.institution), f"{a.output}/incomplete")
        return
    members = archives.ArchiveFiles.below(spark, a.root)
    if a.safelist:
        members = members.named(tabular.read_safelist(spark, a.safelist).withColumnRenamed("filenames", "archive"))
    frames, series, outcomes = preprocess.run(members, opts)
    append_outcomes(write_store(frames, series, a.output), f"{a.output}/outcomes")
    append_outcomes(outcomes, f"{a.output}/outcomes")
    resolve.tally(spark.read.parquet(f"{a.output}/outcomes")).show(100, truncate=False)


def run_dedup(a: argparse.Namespace) -> None:
    spark = _spark()
    positions = ordering.check_positions(tuple(a.frames.split(",")))
    if a.fingerprints:
        manifest = tabular.load_manifest(tabular.read_csv(spark, a.fingerprints, missing=()), a.label)
    else:
        manifest = stored(dedup.fingerprint_manifest(store.read_frames(spark, a.input, a.prefix), store.read_series(spark, a.input), a.label, positions))
        tabular.write_csv(manifest, f"{a.output}/fingerprints")
    reference = None
    if a.reference:
        parts = [tabular.load_manifest(tabular.read_csv(spark, p, missing=()), "reference") for p in a.reference.split(",")]
        reference = reconcile.union_manifests(parts)
    duplicates, flagged = dedup.report(manifest, reference, a.threshold, a.min_series, a.max_bucket)
    if a.max_bucket is not None:
        every = manifest if reference is None else manifest.select(*rollup.MANIFEST).union(reference.select(*rollup.MANIFEST))
        append_outcomes(dedup.skipped(every, a.max_bucket, a.threshold), f"{a.output}/_outcomes")
    tabular.write_csv(duplicates, f"{a.output}/duplicates")
    tabular.write_csv(flagged, f"{a.output}/flagged")


def run_crosswalk(a: argparse.Namespace) -> None:
    spark = _spark()
    prior = tabular.numbered_csv(spark, a.prior) if a.prior else None
    new, every = crosswalk.build(tabular.read_csv(spark, a.input), prior, a.mrn_col, a.acc_col, a.label, a.mrn_len, a.acc_len, a.salt, tabular.ROW if a.prior else None)
    ids = [F.col(f"`{c}`") for c in (a.mrn_col, a.acc_col, "anon_mrn", "anon_accession")]
    tabular.write_csv(new.select(*ids), f"{a.output}/{a.label}_batch_anon")
    tabular.write_csv(every.select(*ids), f"{a.output}/{a.label}_concat_anon")
    tabular.write_csv(every, f"{a.output}/{a.label}_concat_full")


def run_metadata(a: argparse.Namespace) -> None:
    from .plans.catalog import catalog

    found = stored(catalog(archives.members(_spark(), a.root, by_path=a.by_path), a.institution, a.fields))
    tabular.write_csv(found, f"{a.output}/catalog")
    if a.summarize:
        for c in found.columns:
            tabular.write_csv(profile.frequency(found, c, nulls=True), f"{a.output}/counts_{c}")
        tabular.write_csv(profile.study_summary(found, a.institution, [F.col("mrn")]), f"{a.output}/studies")


def run_tar(a: argparse.Namespace) -> None:
    spark = _spark()
    if a.mode == "ukbiobank":
        members = archives.members(spark, a.root, "zip")
    else:
        members = archives.folder_files(spark, a.root)
    xw = tabular.numbered_csv(spark, a.crosswalk) if a.crosswalk else None
    append_outcomes(anonymise.run(members, a.mode, a.output, xw, tabular.ROW), f"{a.output}/_outcomes")


def run_copy(a: argparse.Namespace) -> None:
    spark = _spark()
    rows = tabular.read_csv(spark, a.crosswalk)
    crosswalk.require_columns(rows, ["anon_mrn", "anon_accession", "crosswalk_mrn", "crosswalk_accession"], "crosswalk")
    rows = stored(rows.withColumn("row_id", F.monotonically_increasing_id()))
    wanted = ["crosswalk_mrn", "crosswalk_accession"]
    resolve.guard_collisions(rows.na.drop(subset=wanted), wanted)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.h5").load(a.source).select("path")
    parts = F.split("path", "/")
    files = listed.select(F.concat_ws("/", F.element_at(parts, -2), F.element_at(parts, -1)).alias("relpath"))
    found = resolve.resolve_files(rows, files, "row_id", "anon_mrn", "anon_accession", wanted)
    named = found.join(rows.select("row_id", F.concat("crosswalk_mrn", F.lit("/"), "crosswalk_accession", F.lit(".h5")).alias("new_path")), "row_id")
    done = stored(copy_verified(named, a.source, a.output))
    tabular.write_csv(done, f"{a.output}/_outcomes")
    resolve.tally(done).show(truncate=False)


def run_checksum(a: argparse.Namespace) -> None:
    from .operators.checksum import stream_digest

    spark = _spark()
    frames = store.read_frames(spark, a.input).withColumn("file", store.relpath())
    made = stream_digest(frames, ["file"], ["series", "frame_idx"], "pixels").withColumnRenamed("digest", "checksum")
    made = stored(made)
    tabular.write_csv(made, f"{a.output}/checksums")
    if a.compare:
        bad = stored(reconcile.compare_manifests(tabular.read_csv(spark, a.compare), made, missing=not a.common_only))
        tabular.write_csv(bad, f"{a.output}/differences")
        if bad.head(1):
            raise SystemExit("checksums differ")


def run_counts(a: argparse.Namespace) -> None:
    series = store.read_series(_spark(), a.root)
    tabular.write_csv(profile.video_counts(series.withColumn("relpath", store.relpath()), ["relpath"]), f"{a.output}/counts")


def run_chunks(a: argparse.Namespace) -> None:
    n = tabular.read_bulk(_spark(), a.bulk).agg(F.count(F.lit(1)).alias("n"))
    starts = n.select(F.explode(profile.chunk_plan(F.col("n"), a.size)).alias("start"))
    if a.output:
        tabular.write_csv(starts, f"{a.output}/chunks")
    else:
        for row in starts.toLocalIterator():
            print(row["start"])


def run_video(a: argparse.Namespace) -> None:
    spark = _spark()
    frames = store.read_frames(spark, a.root, a.prefix)
    append_outcomes(export_video(frames, a.output, a.fps, series=store.read_series(spark, a.root)), f"{a.output}/_outcomes")


def run_plot(a: argparse.Namespace) -> None:
    spark = _spark()
    frames, series = store.read_frames(spark, a.root, a.prefix), store.read_series(spark, a.root)
    if a.series:
        frames, series = frames.where(F.col("series") == a.series), series.where(F.col("series") == a.series)
    append_outcomes(pictures(frames, series, f"{a.output}/{a.mode}", a.mode, a.skip), f"{a.output}/_outcomes")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="scanloom", description=__doc__)
    sub = p.add_subparsers(required=True)

    def command(name: str, run, **options) -> None:
        c = sub.add_parser(name)
        c.set_defaults(run=run)
        for o, (default, kind) in options.items():
            flag = "--" + o.replace("_", "-")
            if kind is bool:
                c.add_argument(flag, action="store_true")
            elif kind is list:
                c.add_argument(flag, nargs="*", default=default)
            else:
                c.add_argument(flag, default=default, type=kind, required=default is Ellipsis)

    need = (Ellipsis, str)
    command("preprocess", run_preprocess, root=need, output=need, institution=need, framesize=("480", str), channels=("rgb", str), colour=(False, bool), safelist=(None, str), audit=(False, bool), stream=(False, bool), by_path=(False, bool))
    command("dedup", run_dedup, input=(None, str), output=need, threshold=(99.0, float), frames=("first,middle,last", str), min_series=(rollup.MIN_SERIES, int), max_bucket=(None, int), fingerprints=(None, str), reference=(None, str), label=("scan", str), prefix=(None, str))
    command("crosswalk", run_crosswalk, input=need, prior=(None, str), mrn_col=("Patient ID", str), acc_col=("Study ID", str), label=("batch", str), output=(".", str), mrn_len=(10, int), acc_len=(12, int), salt=(None, str))
    command("metadata", run_metadata, root=need, output=(".", str), institution=need, fields=(None, list), summarize=(False, bool), by_path=(False, bool))
    command("tar", run_tar, root=need, output=need, mode=("simple", str), crosswalk=(None, str))
    command("copy", run_copy, source=need, output=need, crosswalk=need)
    command("checksum", run_checksum, input=need, output=need, compare=(None, str), common_only=(False, bool))
    command("counts", run_counts, root=need, output=(".", str))
    command("video", run_video, root=need, output=need, prefix=(None, str), fps=(24, int))
    command("plot", run_plot, root=need, output=need, mode=("grid", str), skip=(1, int), series=(None, str), prefix=(None, str))
    command("chunks", run_chunks, bulk=need, output=(None, str), size=(profile.CHUNK, int))
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(args)
    clear_scratch(_spark())


__all__ = ["main"]

if __name__ == "__main__":
    main()
