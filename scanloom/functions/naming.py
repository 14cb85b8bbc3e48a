"""Names of series, archives, store files and processed studies, as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What an institution's archive name holds: ids from the name (mrn-accession.tgz), or only the mrn.
#: The preprocessing and the metadata scan treat different institutions this way; both lists are kept.
NAME_POLICY = {
    "preprocess": {"medstar": "mrn-accession", "upenn": "mrn-accession"},
    "metadata": {"medstar": "mrn-accession", "segmed": "mrn-accession", "ukbiobank": "mrn-accession"},
    "audit": {"ukbiobank": "mrn"},
}


def clean_series(text: Column) -> Column:
    """Series name as a key: blanks and slashes become underscores. Different raw names may meet."""
    return F.translate(text, " /", "__")


def archive_ids(name: Column) -> Column:
    """struct(mrn, accession) of ``mrn-accession.tgz``: only the first hyphen separates, NULLs without it."""
    pattern = r"^([^-]+)-(.+)\.tgz$"
    return F.struct(
        F.when(name.rlike(pattern), F.regexp_extract(name, pattern, 1)).alias("mrn"),
        F.when(name.rlike(pattern), F.regexp_extract(name, pattern, 2)).alias("accession"),
    )


def archive_name(mrn: Column, accession: Column) -> Column:
    return F.concat(mrn, F.lit("-"), accession, F.lit(".tgz"))


def store_ids(path: Column) -> Column:
    """struct(institution, mrn, accession, relpath) of ``.../institution_mrn/accession.h5``.

    The mrn follows the last underscore of the folder, as institutions may contain underscores.
    """
    parts = F.split(path, "/")
    folder, file = F.try_element_at(parts, F.lit(-2)), F.try_element_at(parts, F.lit(-1))
    return F.struct(
        F.regexp_extract(folder, r"^(.*)_[^_]*$", 1).alias("institution"),
        F.regexp_extract(folder, r"([^_]*)$", 1).alias("mrn"),
        F.regexp_replace(file, r"\.h5$", "").alias("accession"),
        F.concat_ws("/", folder, file).alias("relpath"),
    )


def processed_name(relpath: Column, institution: str) -> Column:
    """Archive name a processed file came from, for the completeness audit."""
    folder, file = F.split_part(relpath, F.lit("/"), F.lit(1)), F.split_part(relpath, F.lit("/"), F.lit(2))
    mrn = F.regexp_replace(folder, r"^[^_]*_", "")
    if NAME_POLICY["audit"].get(institution) == "mrn":
        return F.concat(mrn, F.lit(".tgz"))
    return archive_name(mrn, F.regexp_replace(file, r"\.h5$", ""))


def zip_ids(name: Column) -> Column:
    """struct(eid, datafield, instance) of ``eid_datafield_instance_...``."""
    return F.struct(*[F.try_element_at(F.split(name, "_"), F.lit(i + 1)).alias(n) for i, n in enumerate(("eid", "datafield", "instance"))])


def redacted(mrn: Column) -> Column:
    return F.concat(F.lit("redacted_"), mrn)


def of_institution(folder: Column, prefix: str) -> Column:
    """Folders whose text before the first underscore is the prefix."""
    return F.split_part(folder, F.lit("_"), F.lit(1)) == prefix


def day_label(ts: Column, style: str = "iso") -> Column:
    """``2024-05-01``, or ``may01_2024`` in style ``short``."""
    return F.date_format(ts, "yyyy-MM-dd") if style == "iso" else F.lower(F.date_format(ts, "MMMdd_yyyy"))


def like_literal(text: str) -> str:
    """Text for LIKE ... ESCAPE '\\' that matches itself only."""
    return re.sub(r"([\\%_])", r"\\\1", text)


def host_key(host: str) -> str:
    return host.replace("-", "_")
