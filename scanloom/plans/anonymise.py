"""Study archives under anonymous names: the modes of regrouping, id lookup and tag rewriting."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import naming
from ..functions.natural import natural_key
from ..operators import resolve
from ..session import stored
from ..sinks.archives import write_archives
from ..sources import dicom


@dataclass(frozen=True)
class Mode:
    """How a mode finds ids and what it writes: ``ids`` from ``tags``, ``crosswalk`` or the study ``name``."""

    ids: str
    on: tuple[tuple[str, str], ...] = ()  # header column to crosswalk column
    anon: tuple[str, str] = ("anon_mrn", "anon_accession")
    rewrite: tuple[tuple[str, str], ...] = ()  # DICOM keyword to: mrn, acc, redacted or a literal
    merges: bool = False  # several archives make one study
    by_series: bool = False  # regroup a flat study into a folder per series


# The published modes and the crosswalk columns each of them reads.
MODES = {
    "simple": Mode("name"),
    "dicom": Mode("tags"),
    "anonymize": Mode("crosswalk", (("accession_tag", "accession"),)),
    "reset_dicom_meta": Mode("name", rewrite=(("AccessionNumber", "=scandata"),)),
    "penn": Mode("tags", by_series=True),
    "segmed": Mode("crosswalk", (("study_uid", "Study ID"),), ("anon_mrn", "anon_uid"), (("PatientID", "mrn"), ("AccessionNumber", "acc"))),
    "dasa": Mode("crosswalk", (("mrn_tag", "accession"),), rewrite=(("PatientID", "mrn"), ("AccessionNumber", "acc"))),
    "ukbiobank": Mode("crosswalk", (("eid", "f.eid"), ("instance", "instance")), rewrite=(("PatientID", "mrn"), ("AccessionNumber", "acc"), ("PatientName", "redacted")), merges=True, by_series=True),
}
HEAD = "archive string, folder string, member string, series_raw string, mrn_tag string, accession_tag string, study_uid string"


def study_headers(members: DataFrame) -> DataFrame:
    """Tags of every member that is a DICOM file."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                try:
                    t = dicom.header(bytes(r.content))
                except (dicom.DicomError, ValueError):
                    continue
                out.append((r.archive, r.folder, r.member, t.get("SeriesDescription"), t.get("PatientID"), t.get("AccessionNumber"), t.get("StudyInstanceUID")))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in HEAD.split(", ")])

    return members.where("content is not null").select("archive", "folder", "member", "content").mapInPandas(run, HEAD)


def _text(what: str, mrn: Column, acc: Column) -> Column:
    return {"mrn": mrn, "acc": acc, "redacted": naming.redacted(mrn)}.get(what, F.lit(what.removeprefix("=")))


def run(members: DataFrame, mode: str, target: str, crosswalk: DataFrame | None = None, order: str | None = None) -> DataFrame:
    """(unit, status, detail) of every study: written archives and those that were held back.

    A study's ids come from its first readable file in natural order. Studies that the crosswalk lacks
    are ``not_in_crosswalk``, those without a readable file ``unreadable_header``, those that would share a
    name ``ambiguous``, unless the mode puts several archives together; none of these is written.
    Of several crosswalk rows the first by the column ``order`` counts. Sources are never changed.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode}; one of {', '.join(MODES)}")
    m = MODES[mode]
    if m.ids == "crosswalk" and crosswalk is None:
        raise ValueError(f"mode {mode} needs a crosswalk")
    heads = stored(study_headers(members), "heads")
    w = Window.partitionBy("archive").orderBy(natural_key(F.col("folder")), natural_key(F.col("member")))
    studies = heads.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
    studies = studies.withColumns({"eid": naming.zip_ids(F.col("archive"))["eid"], "instance": naming.zip_ids(F.col("archive"))["instance"]})
    every = members.select("archive").distinct()
    if m.ids == "crosswalk":
        found, refused = resolve.anonymised(studies, crosswalk, [(F.col(a), b) for a, b in m.on], list(m.anon), order)
        found = found.select("archive", F.col(m.anon[0]).alias("mrn"), F.col(m.anon[1]).alias("acc"))
        refused = refused.select("archive", "status")
    else:
        stem = F.regexp_replace("archive", r"\.(tgz|zip|tar\.gz)$", "")
        found = studies.select("archive", (F.col("mrn_tag") if m.ids == "tags" else stem).alias("mrn"), (F.col("accession_tag") if m.ids == "tags" else F.lit(None).cast("string")).alias("acc"))
        refused = found.where("mrn is null").select("archive", F.lit("not_found").alias("status"))
        found = found.where("mrn is not null")
    if not m.merges:
        several = F.count(F.lit(1)).over(Window.partitionBy("mrn", "acc"))
        counted = stored(found.withColumn("n", several), "studies")
        refused = refused.union(counted.where("n > 1").select("archive", F.lit("ambiguous")))
        found = counted.where("n = 1").drop("n")
    unread = every.join(heads.select("archive").distinct(), "archive", "left_anti").select("archive", F.lit("unreadable_header").alias("status"))
    name = F.concat(F.concat_ws("-", "mrn", "acc"), F.lit(".tgz"))
    tags = F.create_map(*[x for k, v in m.rewrite for x in (F.lit(k), _text(v, F.col("mrn"), F.col("acc")))]) if m.rewrite else F.create_map().cast("map<string,string>")
    rows = members.where("content is not null").join(found, "archive")
    if m.by_series:
        rows = rows.join(heads.select("archive", "folder", "member", naming.clean_series(F.coalesce("series_raw", F.lit("unnamed"))).alias("series")), ["archive", "folder", "member"])
        rows = rows.withColumn("member", F.concat_ws("_", F.when(F.col("folder") != "", F.translate("folder", "/", "_")), "member")).withColumn("folder", F.col("series"))
    written = write_archives(rows.select(name.alias("name"), "folder", "member", "content", tags.alias("tags")), target)
    return written.union(refused.union(unread).select(F.col("archive").alias("unit"), "status", F.lit("").alias("detail")))
