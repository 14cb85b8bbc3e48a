"""Metadata catalogue of archives: tags of one file per series or per study."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import naming
from ..functions.natural import natural_key
from ..operators import profile
from ..sources import dicom

TAGS = sorted(dicom.TAGS)


def tag_rows(members: DataFrame) -> DataFrame:
    """(archive, folder, member, tags map) of every readable member."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                try:
                    out.append((r.archive, r.folder, r.member, dicom.header(bytes(r.content))))
                except (dicom.DicomError, ValueError):
                    continue
            yield pd.DataFrame(out, columns=["archive", "folder", "member", "tags"])

    return members.where("content is not null").select("archive", "folder", "member", "content").mapInPandas(run, "archive string, folder string, member string, tags map<string,string>")


def catalog(members: DataFrame, institution: str, options: list[str] | None = None) -> DataFrame:
    """The catalogue columns of the first file, in natural order, of each series folder; of each study when
    the series description is not among them. Ids come from the archive name where the institution's
    names hold them. Rows whose columns are all missing drop out.
    """
    wanted = profile.tag_columns(options)
    rows = tag_rows(members)
    keys = ["archive", "folder"] if "SeriesDescription" in wanted.values() else ["archive"]
    w = Window.partitionBy(*keys).orderBy(natural_key(F.col("folder")), natural_key(F.col("member")))
    first = rows.withColumn("__rn", F.row_number().over(w)).where("__rn = 1")
    heads = first.select("archive", *[F.col("tags")[t].alias(t) for t in dict.fromkeys(wanted.values())])
    out = profile.project_tags(heads, options)
    if naming.NAME_POLICY["metadata"].get(institution):
        ids = naming.archive_ids(F.col("archive"))
        named = heads.withColumns({"PatientID": F.coalesce(ids["mrn"], F.col("PatientID")), "AccessionNumber": F.coalesce(ids["accession"], F.col("AccessionNumber"))})
        out = profile.project_tags(named, options)
    series = [c for c, t in wanted.items() if t == "SeriesDescription"]
    out = out.withColumns({c: naming.clean_series(F.col(c)) for c in series})
    return out.na.drop("all")
