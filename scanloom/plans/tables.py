"""The operators over the data tables: one query each, with the DuckDB query that must give the same rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import layout, naming, natural, pixels
from ..functions.anon import hashed_id
from ..functions.ids import canonical_id, canonical_id_sql
from ..operators import checksum, components, crosswalk, hamming_join, ordering, profile, reconcile, resolve, rollup, views
from ..session import stored, table
from ..sources import dicom
from ..sources.archives import MEMBERS
from . import catalog, dedup, preprocess

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# -- order inside series ------------------------------------------------------------------------------

_LINE_ORDER = ["loc", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]


def _lines(spark: SparkSession, d: str) -> tuple[DataFrame, list[Column]]:
    df = table(spark, d, "lineitem").withColumn("loc", F.col("l_shipdate").cast("date"))
    return df, [F.col(c) for c in _LINE_ORDER]


@query("""with x as (select l_orderkey, row_number() over w - 1 i, l_shipdate::date loc, lead(l_shipdate::date) over w nxt from lineitem
window w as (partition by l_orderkey order by l_shipdate::date, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice))
select l_orderkey, count(*)::bigint n_frames, coalesce(string_agg(case when loc <> nxt then i::varchar end, ',' order by i), '') slice_frames from x group by l_orderkey""")
def slice_boundaries(spark: SparkSession, d: str) -> DataFrame:
    """Last frame of each slice but the last: order lines as frames, the ship date as slice location."""
    df, order = _lines(spark, d)
    found = ordering.slice_boundaries(df, ["l_orderkey"], F.col("loc"), order)
    return found.withColumn("slice_frames", F.array_join(F.transform("slice_frames", lambda x: x.cast("string")), ","))


@query("""select l_orderkey, (row_number() over (partition by l_orderkey order by l_shipdate::date, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice) - 1)::int frame_idx,
l_linenumber, l_partkey from lineitem qualify frame_idx % 3 = 0""")
def strided_frames(spark: SparkSession, d: str) -> DataFrame:
    """Every third frame of a series."""
    df, order = _lines(spark, d)
    framed = ordering.frame_index(df, ["l_orderkey"], order)
    return ordering.strided(framed, F.col("frame_idx"), 3).select("l_orderkey", "frame_idx", "l_linenumber", "l_partkey")


@query("""with x as (select user_id, event_id, row_number() over (partition by user_id order by ts, event_id) - 1 i, count(*) over (partition by user_id) n from events)
select user_id, event_id, i::int frame_idx, n::bigint n_frames, case when i = 0 then 'first' when i = n // 2 then 'middle' when i = n - 1 then 'last' end frame_pos
from x where i = 0 or i = n // 2 or i = n - 1""")
def frame_positions(spark: SparkSession, d: str) -> DataFrame:
    """First, middle and last event of each user, as the frames that get a fingerprint."""
    found = ordering.frame_positions(table(spark, d, "events"), ["user_id"], [F.col("ts"), F.col("event_id")])
    return found.select("user_id", "event_id", "frame_idx", "n_frames", "frame_pos")


@query("""with f as (select o_custkey, o_orderkey, o_orderdate, count(*) n from orders join lineitem on l_orderkey = o_orderkey group by 1, 2, 3 having n < 8),
r as (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey) rank from f qualify rank <= 10),
c as (select *, sum(n) over (partition by o_custkey order by rank rows unbounded preceding) running from r)
select o_custkey, o_orderkey, n::bigint n, rank::int rank, running::bigint running from c where running <= 30 or rank = 1""")
def folder_cap(spark: SparkSession, d: str) -> DataFrame:
    """Folder limits: orders as folders of fewer than 8 files, at most 10 per customer and 30 files in all."""
    files = table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
    folders = ordering.sized_folders(files, ["o_custkey", "o_orderkey", "o_orderdate"], 8)
    order = [F.col("o_orderdate").desc(), F.col("o_orderkey")]
    return ordering.folder_cap(folders, ["o_custkey"], order, frames_max=30).select("o_custkey", "o_orderkey", "n", "rank", "running")


_NATURAL_KEY_SQL = """list_transform(regexp_extract_all(series_description, '\\d+|\\D+'), lambda r: case when regexp_matches(r, '^\\d')
then {'is_text': 0, 'width': greatest(length(ltrim(r, '0')), 1), 'run': coalesce(nullif(ltrim(r, '0'), ''), '0')} else {'is_text': 1, 'width': 0, 'run': r} end)"""


_PLACES_SQL = f"""select series_description, row_number() over (order by {_NATURAL_KEY_SQL}, series_description)::bigint place
from (select distinct series_description from metadata_catalog where series_description is not null)"""


@query(_PLACES_SQL)
def natural_places(spark: SparkSession, d: str) -> DataFrame:
    """The place of every series name in natural order."""
    names = table(spark, d, "metadata_catalog").select("series_description").where("series_description is not null").distinct()
    return ordering.places(names, [natural.natural_key(F.col("series_description")), F.col("series_description")])


@query(f"""with o as ({_PLACES_SQL}) select m.row_id, o.place from metadata_catalog m join o using (series_description)""")
def natural_order(spark: SparkSession, d: str) -> DataFrame:
    """Every catalogue row with the place of its name in natural order."""
    names = table(spark, d, "metadata_catalog").select("row_id", "series_description").where("series_description is not null")
    return names.join(natural_places(spark, d), "series_description").select("row_id", "place")


# -- names --------------------------------------------------------------------------------------------


@query("""select row_id, series_description, replace(replace(series_description, ' ', '_'), '/', '_') series_key, coalesce(position('InlineVF' in series_description) > 0, false) is_overlay from metadata_catalog""")
def series_clean(spark: SparkSession, d: str) -> DataFrame:
    """Series names as keys, and the marked overlay series that are left out of stores."""
    df = table(spark, d, "metadata_catalog")
    return df.select("row_id", "series_description", naming.clean_series(F.col("series_description")).alias("series_key"), F.coalesce(F.col("series_description").contains("InlineVF"), F.lit(False)).alias("is_overlay"))


@query("""select xw_id, n.name archive, split_part(n.name, '-', 1) mrn, left(substr(n.name, position('-' in n.name) + 1), -4) accession
from archive_crosswalk x, lateral (select x.mrn || '-' || x.accession || '.tgz' name) n""")
def archive_ids(spark: SparkSession, d: str) -> DataFrame:
    """Ids from archive names; hyphens inside an accession stay in it."""
    df = table(spark, d, "archive_crosswalk").select("xw_id", naming.archive_name(F.col("mrn"), F.col("accession")).alias("archive"))
    return df.select("xw_id", "archive", naming.archive_ids(F.col("archive")).alias("i")).select("xw_id", "archive", "i.mrn", "i.accession")


@query(r"""select store_id, regexp_extract(split_part(relpath, '/', 1), '^(.*)_[^_]*$', 1) institution, regexp_extract(split_part(relpath, '/', 1), '([^_]*)$', 1) mrn,
regexp_replace(split_part(relpath, '/', 2), '\.h5$', '') accession, relpath from store_files""")
def store_ids(spark: SparkSession, d: str) -> DataFrame:
    """Institution, patient and scan from store paths."""
    path = F.concat(F.lit("/store/"), F.col("relpath"))
    return table(spark, d, "store_files").select("store_id", naming.store_ids(path).alias("i")).select("store_id", "i.*")


# -- crosswalk ----------------------------------------------------------------------------------------

_SALT = "scanloom"
_KEYED = f"select o_orderkey::varchar scan, o_custkey::varchar patient, o_orderdate from orders"


def _batches(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Orders as scans of customers: those before 1997 are the prior crosswalk, the others the new batch."""
    rows = table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("patient"), F.col("o_orderkey").cast("string").alias("scan"), "o_orderdate")
    old = rows.where("o_orderdate < timestamp_ntz '1997-01-01'").select(
        "patient", "scan", hashed_id(F.col("patient"), _SALT + "p", 16).alias("anon_mrn"), hashed_id(F.col("scan"), _SALT + "s", 16).alias("anon_accession")
    )
    return rows.where("o_orderdate >= timestamp_ntz '1997-01-01'").select("patient", "scan"), old


@query(f"""select o_custkey::varchar patient, o_orderkey::varchar scan,
case when exists (select 1 from orders p where p.o_custkey = n.o_custkey and p.o_orderdate < '1997-01-01') then substr(sha256('{_SALT}p' || o_custkey), 1, 16) else substr(sha256('{_SALT}' || o_custkey), 1, 16) end anon_mrn,
substr(sha256('{_SALT}' || o_orderkey), 1, 16) anon_accession, 'b2' as batch from orders n where o_orderdate >= '1997-01-01'""")
def crosswalk_assign(spark: SparkSession, d: str) -> DataFrame:
    """Ids for a new batch: returning patients keep theirs, others get salted hashes."""
    new, old = _batches(spark, d)
    done, _ = crosswalk.build(new, old, "patient", "scan", "b2", 16, 16, _SALT)
    return done.select("patient", "scan", "anon_mrn", "anon_accession", "batch")


@query("""select c_custkey::varchar patient from customer where exists (select 1 from orders where o_custkey = c_custkey and o_orderdate < '1997-01-01')
and exists (select 1 from orders where o_custkey = c_custkey and o_orderdate >= '1997-01-01')""")
def crosswalk_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Patients of the new batch that prior batches have."""
    new, old = _batches(spark, d)
    return crosswalk.overlap(new, old, "patient")


_XW = f"select xw_id, mrn, accession, {canonical_id_sql('anon_mrn')} am, {canonical_id_sql('anon_accession')} aa from archive_crosswalk"


def _xw(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "archive_crosswalk")
    return df.select("xw_id", "mrn", "accession", canonical_id(F.col("anon_mrn")).alias("am"), canonical_id(F.col("anon_accession")).alias("aa"))


@query(f"select mrn, count(distinct am)::bigint n_values from ({_XW}) group by mrn having count(distinct am) > 1")
def crosswalk_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Patients to whom the crosswalk gives several ids."""
    return crosswalk.conflicts(_xw(spark, d), "mrn", "am")


@query(f"""select 'left' side, accession id, count(distinct aa)::bigint n_partners from ({_XW}) where accession is not null group by 2 having count(distinct aa) > 1
union all select 'right', aa, count(distinct accession)::bigint from ({_XW}) where aa is not null group by 2 having count(distinct accession) > 1""")
def crosswalk_sanity(spark: SparkSession, d: str) -> DataFrame:
    """Ids of either side of the scan mapping with several partners."""
    return crosswalk.bijection_faults(_xw(spark, d), "accession", "aa")


@query(f"""select count(distinct mrn)::bigint n_mrn, count(distinct am)::bigint n_am, count(distinct accession)::bigint n_accession, count(distinct aa)::bigint n_aa from ({_XW})""")
def crosswalk_counts(spark: SparkSession, d: str) -> DataFrame:
    """Distinct ids on both sides of both mappings."""
    return crosswalk.distinct_counts(_xw(spark, d), ["mrn", "am", "accession", "aa"])


_COPY = f"select row_id, batch_no, {canonical_id_sql('anon_accession')} a from copy_crosswalk"


@query(f"""select row_id from ({_COPY}) n join (select a, min(batch_no) first from ({_COPY}) where a is not null and batch_no is not null group by a) p using (a) where batch_no > first""")
def scan_repeats(spark: SparkSession, d: str) -> DataFrame:
    """Rows of every batch whose scan an earlier batch has."""
    df = table(spark, d, "copy_crosswalk").select("row_id", "batch_no", canonical_id(F.col("anon_accession")).alias("a")).where("a is not null and batch_no is not null")
    first = df.groupBy("a").agg(F.min("batch_no").alias("first"))
    return df.join(first, "a").where("batch_no > first").select("row_id")


@query(f"select row_id from ({_COPY}) n where batch_no > 0 and a in (select a from ({_COPY}) p where batch_no = 0 and a is not null)")
def scan_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """Rows of later batches whose scan the first batch has: a warning, not an error."""
    df = table(spark, d, "copy_crosswalk").select("row_id", "batch_no", canonical_id(F.col("anon_accession")).alias("a"))
    return crosswalk.repeated_rows(df.where("batch_no > 0"), df.where("batch_no = 0"), "a").select("row_id")


@query("""select mrn, accession, xw_id from (select *, row_number() over (partition by mrn, accession order by xw_id) rn from archive_crosswalk) where rn = 1""")
def first_rows(spark: SparkSession, d: str) -> DataFrame:
    """The first crosswalk row of each study, in input order."""
    return crosswalk.first_by(table(spark, d, "archive_crosswalk"), ["mrn", "accession"], [F.col("xw_id")]).select("mrn", "accession", "xw_id")


# -- reconciliation and resolution ---------------------------------------------------------------------

_ACC = canonical_id_sql("anon_accession")


def _scans(spark: SparkSession, d: str, name: str) -> DataFrame:
    return table(spark, d, name).select(canonical_id(F.col("anon_accession")).alias("scan")).where("scan is not null")


@query(f"select distinct {_ACC} scan from archive_crosswalk where {_ACC} is not null and {_ACC} not in (select {_ACC} from store_files where {_ACC} is not null)")
def completeness_audit(spark: SparkSession, d: str) -> DataFrame:
    """Scans of the archive crosswalk without a stored file."""
    return reconcile.incomplete(_scans(spark, d, "archive_crosswalk"), _scans(spark, d, "store_files"), "scan")


@query(f"""with i as (select {_ACC} scan from archive_crosswalk where {_ACC} is not null), o as (select {_ACC} scan from store_files where {_ACC} is not null)
select (select count(distinct scan) from i)::bigint n_inputs, (select count(*) from o)::bigint n_processed, (select count(distinct scan) from i where scan not in (select scan from o))::bigint n_incomplete""")
def audit_counts(spark: SparkSession, d: str) -> DataFrame:
    """Inputs, outputs and what is missing."""
    return reconcile.audit_counts(_scans(spark, d, "archive_crosswalk"), _scans(spark, d, "store_files"), "scan")


@query(f"select distinct {_ACC} scan from store_files where {_ACC} in (select {_ACC} from copy_crosswalk where {_ACC} is not null)")
def safelist(spark: SparkSession, d: str) -> DataFrame:
    """Stored scans that the copy list names."""
    return reconcile.safelisted(_scans(spark, d, "store_files"), _scans(spark, d, "copy_crosswalk").withColumnRenamed("scan", "filenames"), "scan")


_MANIFEST = "select {f} file, {a}(checksum, {o}(check_id)) checksum from checksum_manifest where checked_at {c} timestamp '2024-06-01' group by 1"


@query(f"""with a as (select {canonical_id_sql('file')} file, arg_min(coalesce(checksum, '-'), check_id) c from checksum_manifest where checked_at < timestamp '2024-06-01' group by 1),
b as (select {canonical_id_sql('file')} file, arg_min(coalesce(checksum, '-'), check_id) c from checksum_manifest where checked_at >= timestamp '2024-03-01' group by 1)
select coalesce(a.file, b.file) file, a.c as old, b.c as new, case when a.file is null then 'added' when b.file is null then 'removed' else 'changed' end status
from a full join b on a.file = b.file where a.c is distinct from b.c""")
def checksum_compare(spark: SparkSession, d: str) -> DataFrame:
    """Files changed, gone or new between an older and a newer manifest."""
    df = table(spark, d, "checksum_manifest").select(canonical_id(F.col("file")).alias("file"), "check_id", F.coalesce("checksum", F.lit("-")).alias("checksum"), "checked_at")
    pick = lambda x: x.groupBy("file").agg(F.min_by("checksum", "check_id").alias("checksum"))
    return reconcile.compare_manifests(pick(df.where("checked_at < timestamp_ntz '2024-06-01'")), pick(df.where("checked_at >= timestamp_ntz '2024-03-01'")))


@query(f"""with r as (select row_id, {canonical_id_sql('anon_mrn')} m, {_ACC} a, crosswalk_mrn is not null and crosswalk_accession is not null ok from copy_crosswalk),
f as (select distinct split_part(relpath, '/', 1) folder, regexp_replace(split_part(relpath, '/', 2), '\\.h5$', '') acc, relpath from store_files),
j as (select r.row_id, any_value(ok) ok, count(relpath) n, min(relpath) p from r left join f on ok and a = acc and ends_with(folder, '_' || m) group by r.row_id)
select row_id, case when not ok then 'skipped_no_id' when n = 0 then 'not_found' when n > 1 then 'ambiguous' else 'found' end status, n::bigint n_files, case when n = 1 then p end relpath from j""")
def crosswalk_resolve(spark: SparkSession, d: str) -> DataFrame:
    """The stored file of each copy row, or why there is none."""
    rows = table(spark, d, "copy_crosswalk").withColumns({c: canonical_id(F.col(c)) for c in ("anon_mrn", "anon_accession")})
    return resolve.resolve_files(rows, table(spark, d, "store_files"), "row_id", "anon_mrn", "anon_accession", ["crosswalk_mrn", "crosswalk_accession"])


@query(f"select status, count(*)::bigint n from ({SQL['crosswalk_resolve']}) group by status")
def outcome_tally(spark: SparkSession, d: str) -> DataFrame:
    """Rows per outcome of the resolution."""
    return resolve.tally(crosswalk_resolve(spark, d))


@query("""select row_id, crosswalk_mrn, crosswalk_accession, n::bigint n_rows from (select *, count(*) over (partition by crosswalk_mrn, crosswalk_accession) n from copy_crosswalk where crosswalk_mrn is not null and crosswalk_accession is not null) where n > 1""")
def target_collisions(spark: SparkSession, d: str) -> DataFrame:
    """Copy rows that claim one target file."""
    df = table(spark, d, "copy_crosswalk").na.drop(subset=["crosswalk_mrn", "crosswalk_accession"])
    return resolve.collisions(df, ["crosswalk_mrn", "crosswalk_accession"]).select("row_id", "crosswalk_mrn", "crosswalk_accession", "n_rows")


@query("""with x as (select * from archive_crosswalk where mrn is not null and accession is not null and anon_mrn is not null and anon_accession is not null and batch is not null and loaded_at is not null
qualify row_number() over (partition by accession order by xw_id) = 1)
select row_id, c.accession, x.anon_mrn, x.anon_accession from metadata_catalog c join x on x.accession = c.accession""")
def anonymise_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Catalogue rows under the anonymous ids of their first complete crosswalk row; others are held back."""
    xw = table(spark, d, "archive_crosswalk").select("xw_id", "mrn", "accession", "anon_mrn", "anon_accession", "batch", "loaded_at")
    done, _ = resolve.anonymised(table(spark, d, "metadata_catalog").select("row_id", "accession"), xw, [(F.col("accession"), "accession")], ["anon_mrn", "anon_accession"], "xw_id")
    return done.select("row_id", "accession", "anon_mrn", "anon_accession")


@query("""select c.row_id, 'not_in_crosswalk' status from metadata_catalog c where not exists (select 1 from archive_crosswalk x where x.accession = c.accession
and x.mrn is not null and x.anon_mrn is not null and x.anon_accession is not null and x.batch is not null)""")
def anonymise_refused(spark: SparkSession, d: str) -> DataFrame:
    """Catalogue rows that may not leave under real ids."""
    xw = table(spark, d, "archive_crosswalk")
    _, left = resolve.anonymised(table(spark, d, "metadata_catalog").select("row_id", "accession"), xw.select("mrn", "accession", "anon_mrn", "anon_accession", "batch"), [(F.col("accession"), "accession")], ["anon_mrn", "anon_accession"])
    return left.select("row_id", "status")


@query("""select r.row_id, x.anon_mrn, y.anon_accession from metadata_catalog r
join (select mrn, arg_min(anon_mrn, xw_id) anon_mrn from archive_crosswalk where mrn is not null and accession is not null and anon_mrn is not null and anon_accession is not null group by mrn) x on x.mrn = r.mrn
join (select mrn, accession, arg_min(anon_accession, xw_id) anon_accession from archive_crosswalk where mrn is not null and accession is not null and anon_mrn is not null and anon_accession is not null group by 1, 2) y on y.mrn = r.mrn and y.accession = r.accession""")
def composite_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Patient id from the patient's first row, scan id from the row of patient and scan."""
    xw = table(spark, d, "archive_crosswalk").select("xw_id", "mrn", "accession", "anon_mrn", "anon_accession")
    rows = table(spark, d, "metadata_catalog").select("row_id", "mrn", "accession")
    known, _ = resolve.anonymised(rows, xw, [(F.col("mrn"), "mrn")], ["anon_mrn"], "xw_id")
    both, _ = resolve.anonymised(known, xw, [(F.col("mrn"), "mrn"), (F.col("accession"), "accession")], ["anon_accession"], "xw_id")
    return both.select("row_id", "anon_mrn", "anon_accession")


@query("""select relpath from store_files where stored_at < timestamp '2024-07-01' intersect select relpath from store_files where removed_at is null""")
def stored_both(spark: SparkSession, d: str) -> DataFrame:
    """Set intersection: paths stored early and still there."""
    df = table(spark, d, "store_files")
    return df.where("stored_at < timestamp_ntz '2024-07-01'").select("relpath").intersect(df.where("removed_at is null").select("relpath"))


# -- profiles -----------------------------------------------------------------------------------------


@query("select series_description, count(*)::bigint frequency from metadata_catalog where series_description is not null group by 1")
def value_counts(spark: SparkSession, d: str) -> DataFrame:
    """How often each series description occurs."""
    return profile.frequency(table(spark, d, "metadata_catalog"), "series_description")


@query("select scanner, count(*)::bigint frequency from metadata_catalog group by 1")
def value_counts_with_null(spark: SparkSession, d: str) -> DataFrame:
    """Scanner counts with NULL as a group."""
    return profile.frequency(table(spark, d, "metadata_catalog"), "scanner", nulls=True)


@query("""select 'all' institution, mrn parent_folder, accession from (select *, row_number() over (partition by accession order by row_id) rn from metadata_catalog) where rn = 1""")
def study_summary(spark: SparkSession, d: str) -> DataFrame:
    """One row per accession: its first."""
    return profile.study_summary(table(spark, d, "metadata_catalog"), "all", [F.col("row_id")])


@query("select mrn, accession, scanner model from metadata_catalog")
def metadata_projection(spark: SparkSession, d: str) -> DataFrame:
    """A catalogue of chosen tags: ids first, options replace the default columns."""
    df = table(spark, d, "metadata_catalog").select(F.col("mrn").alias("PatientID"), F.col("accession").alias("AccessionNumber"), F.col("scanner").alias("ManufacturerModelName"))
    return profile.project_tags(df, ["model:ManufacturerModelName"])


@query("select l_returnflag, unnest(range(1, n + 1, 1000))::bigint start_row from (select l_returnflag, count(*) n from lineitem group by 1)")
def chunk_plan(spark: SparkSession, d: str) -> DataFrame:
    """First rows of the chunks of a bulk list."""
    n = table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    return n.select("l_returnflag", F.explode(profile.chunk_plan(F.col("n"))).alias("start_row"))


@query(f"""with s as ({SQL['slice_boundaries']}), n as (select l_orderkey, n_frames, case when slice_frames = '' then 0 else len(string_split(slice_frames, ',')) end b from s)
select o_custkey, sum(greatest(b, 1))::bigint n_boundaries, sum(b + 1)::bigint n_slices, sum(n_frames)::bigint n_frames from n join orders on o_orderkey = l_orderkey group by 1""")
def video_count(spark: SparkSession, d: str) -> DataFrame:
    """Videos per file by boundaries and by slices."""
    df, order = _lines(spark, d)
    series = ordering.slice_boundaries(df, ["l_orderkey"], F.col("loc"), order)
    joined = series.join(table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    return profile.video_counts(joined, ["o_custkey"])


@query("select match_id, match_fraction, min_hamming from dup_manifest order by match_fraction desc, min_hamming, match_id limit 10")
def preview_topk(spark: SparkSession, d: str) -> DataFrame:
    """The ten closest matches (a top-k report)."""
    return profile.top_rows(table(spark, d, "dup_manifest"), [F.desc("match_fraction"), F.asc("min_hamming"), F.asc("match_id")]).select("match_id", "match_fraction", "min_hamming")


@query()
def random_sample(spark: SparkSession, d: str) -> DataFrame:
    """15 stored files in a seeded random order (a sampling operator)."""
    return profile.sample_rows(table(spark, d, "store_files"), 15, F.col("store_id"), 1).select("store_id", "relpath")


# -- views --------------------------------------------------------------------------------------------


_VIEW_MAP = "select series_description, arg_min(cleaned_series_names, map_id) \"view\", min(map_id) map_id from series_map where series_description is not null and cleaned_series_names is not null group by 1"


def _view_map(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "series_map").where("series_description is not null and cleaned_series_names is not null")
    return df.groupBy("series_description").agg(F.min_by("cleaned_series_names", "map_id").alias("view"), F.min("map_id").alias("map_id"))


@query(f"""with m as ({_VIEW_MAP}), j as (select s.map_id row_id, s.institution, m.view, m.map_id ord from series_map s join m using (series_description))
select row_id, institution, "view" from j qualify row_number() over (partition by institution, "view" order by ord, row_id) = 1""")
def view_map(spark: SparkSession, d: str) -> DataFrame:
    """The first series of each view of an institution, by the map's order."""
    series = table(spark, d, "series_map").select(F.col("map_id").alias("row_id"), "institution", "series_description")
    m = _view_map(spark, d).withColumnRenamed("map_id", "ord")
    return views.map_views(series, m, "series_description", ["institution"], [F.col("ord"), F.col("row_id")]).select("row_id", "institution", "view")


@query(f"""with m as ({_VIEW_MAP}) select "view", count(distinct institution)::bigint n_files from series_map s join m using (series_description) group by 1""")
def view_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Files per view, each counted once."""
    series = table(spark, d, "series_map").select("institution", "series_description")
    mapped = views.map_views(series, _view_map(spark, d), "series_description", ["institution"], [], first_only=False)
    return views.view_coverage(mapped, "institution")


# -- checksums ----------------------------------------------------------------------------------------


@query("""select repo, count(*)::bigint n_parts, sha256(string_agg(sha256(coalesce(text, '')), '' order by doc_id)) digest from documents group by repo""")
def series_checksum(spark: SparkSession, d: str) -> DataFrame:
    """Digest of a repository over the ordered digests of its files."""
    return checksum.series_digest(table(spark, d, "documents"), ["repo"], ["doc_id"], F.col("text"))


@query("""select repo, sha256(string_agg(coalesce(text, ''), '' order by doc_id)) digest from documents group by repo""")
def stream_checksum(spark: SparkSession, d: str) -> DataFrame:
    """Digest over concatenated bytes in order, streamed."""
    return checksum.stream_digest(table(spark, d, "documents"), ["repo"], ["doc_id"], "text")


# -- pixel planes -------------------------------------------------------------------------------------


def _planes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("p"))


def _kernel(df: DataFrame, out: str, work) -> DataFrame:
    """(vec_id, out): text made of each 8 x 8 plane by a kernel; planes of another size give NULL."""

    def run(batches):
        for b in batches:
            texts = [work(np.asarray(p, np.float64).reshape(8, 8)) if p is not None and len(p) == 64 and all(x is not None for x in p) else None for p in b["p"]]
            yield pd.DataFrame({"vec_id": b["vec_id"], out: texts})

    return df.select("vec_id", "p").mapInPandas(run, f"vec_id bigint, {out} string")


def _joined(values) -> str:
    return ",".join(map(str, values))


@query("""with p as (select vec_id, list_transform(embedding, lambda x: x::double) p from embeddings), b as (select *, list_min(p) lo, list_max(p) hi from p)
select vec_id, array_to_string(list_transform(p, lambda x: greatest(0, least(255, trunc((x - lo) / (hi - lo + 1e-8) * 255)))::int), ',') grey from b""")
def plane_normalize(spark: SparkSession, d: str) -> DataFrame:
    """Min-max scaling of 8 x 8 planes to 0..255, truncated."""
    return _kernel(_planes(spark, d), "grey", lambda p: _joined(pixels.to_u8(p).ravel().tolist()))


_CODE_SQL = """p as (select vec_id, list_transform(embedding, lambda x: x::double) p from embeddings), m as (select vec_id, p, list_sort(p) s from p),
c as (select vec_id, array_to_string(list_transform(p, lambda x: case when x > (s[32] + s[33]) / 2 then '1' else '0' end), '') bits from m)"""


def _codes(spark: SparkSession, d: str) -> DataFrame:
    return _kernel(_planes(spark, d), "bits", lambda p: "".join("01"[int(x)] for x in pixels.median_bits(p).ravel()))


@query(f"with {_CODE_SQL} select vec_id, bits from c")
def plane_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    """Bits above the median of each plane."""
    return _codes(spark, d)


@query("""select vec_id, array_to_string(list_transform(flatten([embedding[r * 8 + 2 : r * 8 + 7] for r in range(1, 7)]), lambda x: round_even(x::double * 1e6, 0)::bigint), ',') crop from (select vec_id, embedding from embeddings)""")
def centre_crop(spark: SparkSession, d: str) -> DataFrame:
    """The central 6 x 6 part of each plane."""
    return _kernel(_planes(spark, d), "crop", lambda p: _joined(round(x * 1e6) for x in pixels.centre_crop(p, 6).ravel().tolist()))


def _tent(k: int, n: int = 8, m: int = 12) -> list[float]:
    """What each of n samples adds to place k of m, written down for the SQL: linear between the samples' centres."""
    x = (k + 0.5) * n / m
    shares = [max(0.0, 1 - abs(j + 0.5 - x)) for j in range(n)]
    return [s / sum(shares) for s in shares]


_TENTS = ", ".join(f"({k}, {_tent(k)!r}::double[])" for k in range(2, 11))


@query(f"""with w(k, s) as (values {_TENTS}), p as (select vec_id, list_transform(embedding, lambda x: x::double) p from embeddings),
f as (select vec_id, r.k rk, c.k ck, list_sum(list_transform(range(64), lambda i: p[i + 1] * r.s[i // 8 + 1] * c.s[i % 8 + 1])) v from p, w r, w c)
select vec_id, string_agg(round_even(v * 1e4, 0)::bigint, ',' order by rk, ck) fitted from f group by vec_id""")
def plane_fitted(spark: SparkSession, d: str) -> DataFrame:
    """Each plane at frame size 12: resized, and the central 9 x 9 part."""
    return _kernel(_planes(spark, d), "fitted", lambda p: _joined(round(x * 1e4) for x in pixels.fit_frame(p, 12).ravel().tolist()))


def _near_sql(k: int) -> str:
    return f"with {_CODE_SQL}, b as (select vec_id, bits::bit b from c) select x.vec_id id_a, y.vec_id id_b, bit_count(xor(x.b, y.b))::int dist from b x join b y on x.vec_id < y.vec_id and bit_count(xor(x.b, y.b)) <= {k}"


@query(_near_sql(14))
def near_dup_planes_14(spark: SparkSession, d: str) -> DataFrame:
    """Planes whose codes differ in at most 14 of 64 bits: bit bands, proof of full recall."""
    return hamming_join.near_bit_strings(_codes(spark, d), "vec_id", "bits", 14)


@query(_near_sql(16))
def near_dup_planes_16(spark: SparkSession, d: str) -> DataFrame:
    return hamming_join.near_bit_strings(_codes(spark, d), "vec_id", "bits", 16)


_SHAPES = [([4, 5], None), ([1, 4, 5], None), ([3, 4, 5], None), ([3, 4, 5], 3), ([7, 4, 5], 7), ([7, 3, 4, 5], None), ([3, 7, 4, 5], None), ([7, 3, 4, 5], 7), ([3, 7, 4, 5], 7), ([1, 3, 4, 5], None), ([3, 1, 4, 5], None), ([3, 3, 4, 5], None), ([9, 8, 4, 5], None), ([9, 8, 4, 5], 8), ([5], None), ([2, 2, 2, 2, 2], None)]


@query("""with s(id, a0, a1, r, n) as (values (0,4,5,2,null),(1,1,4,3,null),(2,3,4,3,null),(3,3,4,3,3),(4,7,4,3,7),(5,7,3,4,null),(6,3,7,4,null),(7,7,3,4,7),(8,3,7,4,7),(9,1,3,4,null),(10,3,1,4,null),(11,3,3,4,null),(12,9,8,4,null),(13,9,8,4,8),(14,5,null,1,null),(15,2,2,5,null))
select id::int id, case when r = 2 then 'single' when r = 3 then case when a0 in (1,3) and n is distinct from a0 then 'channels_first' else 'cine0' end
when r = 4 then case when n = a0 and n is distinct from a1 then 'cine0' when n = a1 and n is distinct from a0 then 'cine1'
when a0 in (1,3) and a1 not in (1,3) then 'cine1' when a1 in (1,3) and a0 not in (1,3) then 'cine0'
when a0 = 3 and a1 = 1 then 'cine1' else 'cine0' end end layout from s""")
def layout_infer(spark: SparkSession, d: str) -> DataFrame:
    """The meaning of the axes for every branch of the decision."""
    df = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate(_SHAPES)], "id int, shape array<int>, n int")
    return df.select("id", layout.series_layout(F.col("shape"), F.col("n")).alias("layout"))


# -- archives to series, over planes packed as DICOM files ----------------------------------------------


def study_members(spark: SparkSession, d: str) -> DataFrame:
    """The embeddings as studies: a study per label, a DICOM file per vector, seven vectors to a slice."""

    def run(batches):
        for b in batches:
            out = []
            for vec, plane, label in zip(b["vec_id"], b["embedding"], b["label"]):
                if plane is None or len(plane) != 64:
                    out.append((f"M{label}-A-{label}.tgz", "study", f"{vec}.dcm", b"", None))
                    continue
                array = np.trunc((np.asarray(plane, np.float64) + 2) * 1000).astype("<u2").reshape(8, 8)
                tags = {"SeriesDescription": f"view {label}", "SliceLocation": int(vec) // 7, "InstanceNumber": int(vec), "PatientID": f"P{label}", "AccessionNumber": f"N{label}"}
                out.append((f"M{label}-A-{label}.tgz", "study", f"{vec}.dcm", dicom.build(tags, array), None))
            yield pd.DataFrame(out, columns=["archive", "folder", "member", "content", "status"])

    return table(spark, d, "embeddings").select("vec_id", "embedding", "label").mapInPandas(run, MEMBERS)


_FRAMES_SQL = """f as (select label, vec_id, vec_id // 7 loc, list_transform(embedding, lambda x: trunc((x::double + 2) * 1000)) p from embeddings),
o as (select *, row_number() over w - 1 i, lead(loc) over w nxt from f window w as (partition by label order by loc, vec_id))"""


@query(f"""with {_FRAMES_SQL} select 'medstar' institution, 'M' || label mrn, 'A-' || label accession, 'view_' || label series, count(*)::int total_images, count(*)::int n_frames,
coalesce(string_agg(case when loc <> nxt then i::varchar end, ',' order by i), '') slice_frames, min(list_min(p)) vmin, max(list_max(p)) vmax from o group by label""")
def preprocess_series(spark: SparkSession, d: str) -> DataFrame:
    """The preprocessing pipeline from DICOM files to series with their slices and bounds."""
    _, series, _ = preprocess.run(study_members(spark, d), preprocess.Options("medstar", frame_size=None))
    return series.drop("archive").withColumn("slice_frames", F.array_join(F.transform("slice_frames", lambda x: x.cast("string")), ","))


@query(f"""with {_FRAMES_SQL}, b as (select *, min(list_min(p)) over (partition by label) lo, max(list_max(p)) over (partition by label) hi from o)
select 'view_' || label series, i::int frame_idx, string_agg(lpad(lower(to_hex(g.v)), 2, '0'), '' order by g.j) pixels
from b, lateral (select unnest(list_transform(p, lambda x: trunc((x - lo) / (hi - lo + 1e-8) * 255)::int)) v, generate_subscripts(p, 1) j) g group by label, i""")
def preprocess_frames(spark: SparkSession, d: str) -> DataFrame:
    """Grey frames of the store, scaled by the bounds of their series."""
    frames, _, _ = preprocess.run(study_members(spark, d), preprocess.Options("medstar", frame_size=None, channels="grey"))
    return frames.select("series", "frame_idx", F.lower(F.hex("pixels")).alias("pixels"))


@query()
def fingerprints(spark: SparkSession, d: str) -> DataFrame:
    """Perceptual fingerprints of first, middle and last frames of the stored series."""
    frames, series, _ = preprocess.run(study_members(spark, d), preprocess.Options("medstar", frame_size=None))
    return dedup.fingerprint_manifest(frames, series, "store")


@query()
def preprocess_sized(spark: SparkSession, d: str) -> DataFrame:
    """Grey frames of the store at a frame size: resized and cropped to the centre."""
    frames, _, _ = preprocess.run(study_members(spark, d), preprocess.Options("medstar", frame_size=12, channels="grey"))
    return frames.select("series", "frame_idx", "h", "w", F.lower(F.hex("pixels")).alias("pixels"))


@query("select 'M' || label mrn, 'A-' || label accession, 'view_' || label series_description, (arg_min(vec_id, vec_id) // 7)::varchar frame_loc, null::varchar scanner, null::varchar field_strength from embeddings group by label")
def metadata_scan(spark: SparkSession, d: str) -> DataFrame:
    """The metadata catalogue of the first file of each series."""
    return catalog.catalog(study_members(spark, d), "medstar")


@query(f"""with {_FRAMES_SQL} select 'view_' || label series, i::int frame_idx from (select *, sum((loc <> nxt)::int) over (partition by label order by i rows unbounded preceding) k from o) where loc <> nxt and (k - 1) % 2 = 0""")
def slice_pictures(spark: SparkSession, d: str) -> DataFrame:
    """The frames shown for every second slice."""
    _, series, _ = preprocess.run(study_members(spark, d), preprocess.Options("medstar", frame_size=None))
    return ordering.boundary_frames(series, 2).select("series", "frame_idx")


@query("select store_id, relpath from store_files where split_part(relpath, '_', 1) = 'esk'")
def institution_files(spark: SparkSession, d: str) -> DataFrame:
    """Files of institutions by the text before the first underscore."""
    return table(spark, d, "store_files").where(naming.of_institution(F.col("relpath"), "esk")).select("store_id", "relpath")


# -- perceptual duplicates ----------------------------------------------------------------------------

_FP = "select row_id, source, relpath, series, lower(fp_hex) h from fp_manifest where regexp_full_match(fp_hex, '[0-9a-fA-F]{256}') and fp_hex <> repeat('0', 256)"
_FP_CODES = f"""r as materialized ({_FP}), c as materialized (select h, min(row_id) cid, unhex(h)::bit b from r group by h),
near as materialized (select x.cid a, y.cid b, bit_count(xor(x.b, y.b)) dist from c x join c y on x.cid < y.cid and bit_count(xor(x.b, y.b)) <= 10)"""


def _manifest(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "fp_manifest").select("row_id", *rollup.MANIFEST)
    return hamming_join.valid_codes(df).where(F.col("fp_hex") != "0" * 256)


@query(f"with {_FP_CODES} select a, b, dist::int dist from near")
def near_dup_codes(spark: SparkSession, d: str) -> DataFrame:
    """Distinct codes within 10 bits, by 11 byte bands without a bucket limit."""
    return hamming_join.near_codes(_manifest(spark, d), "row_id", "fp_hex", 10)


_MIN_SERIES = 2
_ROLLUP = f"""{_FP_CODES}, u as (select c.cid, source, relpath, series, count(*) k from r join c using (h) group by all),
p as (select (x.source, x.relpath) f, x.series s, x.k k, (y.source, y.relpath) g, y.series t, y.k l, 0 dist from u x join u y on x.cid = y.cid and (x.source, x.relpath) < (y.source, y.relpath)
union all select (x.source, x.relpath), x.series, x.k, (y.source, y.relpath), y.series, y.k, dist from near join u x on x.cid = a join u y on y.cid = b),
o as (select least(f, g) fa, greatest(f, g) fb, case when f < g then s else t end sa, case when f < g then t else s end sb, k * l frames, dist from p where f <> g),
n as (select (source, relpath) f, count(distinct series) n from r group by 1),
m as (select fa, fb, count(distinct sa) ms, sum(frames) fr, min((dist, sa, sb)) best from o group by 1, 2 having count(distinct sa) >= {_MIN_SERIES}),
rolled as materialized (select fa, fb, ms, a.n na, b.n nb, fr, best from m join n a on a.f = fa join n b on b.f = fb)"""


@query(f"""with {_ROLLUP} select fa[1] source_a, fa[2] file_a, fb[1] source_b, fb[2] file_b, ms::bigint matching_series, na::bigint n_series_a, nb::bigint n_series_b,
round_even(ms / greatest(least(na, nb), 1), 4) match_fraction, best[1]::int min_hamming, fr::bigint matching_frames, best[2] example_series_a, best[3] example_series_b from rolled""")
def dup_rollup(spark: SparkSession, d: str) -> DataFrame:
    """The duplicate report: file pairs with at least two near-identical series."""
    pairs, _ = dedup.report(_manifest(spark, d), min_series=_MIN_SERIES)
    return pairs.drop("cluster_id")


@query(f"""with recursive {_ROLLUP}, e as (select fa a, fb b from rolled union select fb, fa from rolled), w as (select a n, a r from e union select e.b, w.r from w join e on e.a = w.n and w.r < e.b),
b as (select n, min(r) g from w group by n), pn as (select a n, count(distinct b) k from e group by 1)
select b.n[1] source, b.n[2] relpath, dense_rank() over (order by g)::bigint cluster_id, k::bigint n_partners from b join pn on pn.n = b.n""")
def dup_flagged(spark: SparkSession, d: str) -> DataFrame:
    """Flagged files with their clusters and numbers of partners."""
    _, flagged = dedup.report(_manifest(spark, d), min_series=_MIN_SERIES)
    return flagged


@query(f"""with {_ROLLUP}, kept as (select distinct source from r where source like 'a%' or source like 'm%')
select fa[1] source_a, fa[2] file_a, fb[1] source_b, fb[2] file_b, ms::bigint matching_series from rolled where fa[1] in (select source from kept) or fb[1] in (select source from kept)""")
def dup_against_reference(spark: SparkSession, d: str) -> DataFrame:
    """The report of some sources against manifests of the others: pairs with a file of the scanned ones."""
    rows = _manifest(spark, d)
    new = F.coalesce(F.col("source").startswith("a") | F.col("source").startswith("m"), F.lit(False))
    pairs, _ = dedup.report(rows.where(new), rows.where(~new), min_series=_MIN_SERIES)
    return pairs.select("source_a", "file_a", "source_b", "file_b", "matching_series")


@query("""with recursive e as (select distinct file_a a, file_b b from dup_manifest where file_a is not null and file_b is not null), u as (select a, b from e union select b, a from e),
w as (select a n, a r from u union select u.b, w.r from w join u on u.a = w.n and w.r < u.b), b as (select n, min(r) g from w group by n)
select n node, dense_rank() over (order by g)::bigint cluster_id from b""")
def dup_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Clusters of matched paths, numbered by their smallest path."""
    edges = table(spark, d, "dup_manifest").select(F.col("file_a").alias("a"), F.col("file_b").alias("b"))
    return components.components(edges)


@query("select source, relpath, series, frame_pos, min(row_id) row_id from fp_manifest group by all")
def manifest_union(spark: SparkSession, d: str) -> DataFrame:
    """Manifests in one bag, then the first row of each frame for the saved database."""
    df = table(spark, d, "fp_manifest").select("source", "relpath", "series", "frame_pos", "row_id", "batch_no")
    bag = reconcile.union_manifests([df.where("batch_no = 0").drop("batch_no"), df.where("batch_no > 0 or batch_no is null").drop("batch_no")])
    return crosswalk.first_by(bag, ["source", "relpath", "series", "frame_pos"], [F.col("row_id")]).select("source", "relpath", "series", "frame_pos", "row_id")
