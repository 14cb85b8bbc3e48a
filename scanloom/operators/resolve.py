"""From crosswalk rows to stored files and back, with one outcome per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The outcomes a unit of work can have.
STATUSES = (
    "copied", "not_found", "ambiguous", "checksum_fail", "error", "skipped_no_id", "timeout", "exception", "already_exists", "skipped_overlay",
    "too_many_frames", "unreadable_header", "ragged", "invalid_array", "decode_error", "unsupported_rank", "degenerate_frame", "bucket_skipped",
    "not_in_crosswalk", "empty", "written", "found",
)


def resolve_files(rows: DataFrame, files: DataFrame, row_id: str, mrn: str, accession: str, required: list[str]) -> DataFrame:
    """(row_id, status, n_files, relpath): the stored file of each row.

    A file ``folder/accession.h5`` fits when its accession is equal and its folder ends in ``_mrn``; the
    equality is the join key, so the suffix test runs within equal accessions. Rows with a required id
    missing are ``skipped_no_id``; no file, several, or one: ``not_found``, ``ambiguous``, ``found``.
    """
    stored = files.select(F.split_part("relpath", F.lit("/"), F.lit(1)).alias("folder"), F.regexp_replace(F.split_part("relpath", F.lit("/"), F.lit(2)), r"\.h5$", "").alias("acc"), "relpath").distinct()
    has_ids = F.lit(True)
    for c in required:
        has_ids = has_ids & F.col(c).isNotNull()
    work = rows.select(F.col(row_id).alias("row_id"), F.col(mrn).alias("m"), F.col(accession).alias("a"), has_ids.alias("has_ids"))
    hit = F.col("folder").endswith(F.concat(F.lit("_"), F.col("m")))
    joined = work.join(stored, (F.col("has_ids")) & (F.col("a") == F.col("acc")) & hit, "left")
    found = joined.groupBy("row_id", "has_ids").agg(F.count("relpath").alias("n_files"), F.min("relpath").alias("relpath"))
    status = F.when(~F.col("has_ids"), "skipped_no_id").when(F.col("n_files") == 0, "not_found").when(F.col("n_files") > 1, "ambiguous").otherwise("found")
    return found.select("row_id", status.alias("status"), "n_files", F.when(F.col("n_files") == 1, F.col("relpath")).alias("relpath"))


def collisions(df: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of keys that occur more than once; NULL is a value."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return df.withColumn("n_rows", n).where("n_rows > 1")


def guard_collisions(df: DataFrame, keys: list[str]) -> None:
    if df.groupBy(*keys).count().where("count > 1").head(1):
        raise RuntimeError(f"several rows claim one target ({', '.join(keys)})")


def tally(outcomes: DataFrame) -> DataFrame:
    """(status, n) of outcomes."""
    return outcomes.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def anonymised(archives: DataFrame, crosswalk: DataFrame, on: list[tuple[Column, str]], ids: list[str], order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(archives with their anonymous ids, outcomes of the others).

    ``on`` pairs an expression over the archives with a crosswalk column. Crosswalk rows with a NULL in
    any column are left out. Of several rows with one key the first by ``order``, a column of the crosswalk,
    is taken as a whole, so ids of different rows never mix; without an order the smallest ids. An archive
    without a crosswalk row is ``not_in_crosswalk`` and never goes on: it would leave under its real ids.
    """
    whole = F.lit(True)
    for c in crosswalk.columns:  # quoted, as crosswalk columns may hold dots
        whole = whole & F.col(f"`{c}`").isNotNull()
    names = [f"__k{i}" for i in range(len(on))]
    row = F.struct(*([F.col(f"`{order}`").alias("__order")] if order else []), *[F.col(f"`{c}`").alias(f"__v{i}") for i, c in enumerate(ids)])
    clean = crosswalk.where(whole).select(*[F.col(f"`{c}`").cast("string").alias(k) for k, (_, c) in zip(names, on)], row.alias("__row"))
    clean = clean.groupBy(*names).agg(F.min("__row").alias("__row")).select(*names, *[F.col(f"__row.__v{i}").alias(c) for i, c in enumerate(ids)])
    keyed = archives.withColumns({k: e.cast("string") for k, (e, _) in zip(names, on)})
    return keyed.join(clean, names).drop(*names), keyed.join(clean, names, "left_anti").drop(*names).withColumn("status", F.lit("not_in_crosswalk"))
