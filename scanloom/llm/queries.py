"""Queries pN_ of the llm operators over the data tables, and their DuckDB counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.bits import allowed_bits
from ..functions.ids import canonical_id_sql
from ..session import stored, table
from . import boruvka, canonical, hamming_groups, history, mixing, packing, sentences, terms, tokens

#: 99 percent of 1024 bits.
MAX_BITS = allowed_bits(99.0)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return hamming_groups.near_rows(table(spark, d, "fp_manifest"), MAX_BITS)


def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    return hamming_groups.near_groups(table(spark, d, "fp_manifest"), MAX_BITS)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    images = history.batch_cases(table(spark, d, "fp_manifest"), "batch_no", MAX_BITS)
    scans = history.repeated_ids(table(spark, d, "copy_crosswalk"), "batch_no", "row_id", "anon_accession")
    return images.select(F.lit("fp_manifest").alias("src_table"), "row_id").union(scans.select(F.lit("copy_crosswalk"), "row_id"))


def p3_terms(spark: SparkSession, d: str) -> DataFrame:
    return terms.marked_terms(table(spark, d, "series_map"), "series_description", "counts")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return p3_terms(spark, d).where("mark is not null").select("term", "mark")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    found = canonical.mapped(
        table(spark, d, "series_map"), "map_id", ("series_description", "cleaned_series_names"), table(spark, d, "view_list"), "view_id", ("view_name", "view_code")
    )
    return found.select(F.col("row_id").alias("map_id"), F.col("entry").alias("view_id"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return boruvka.match_groups(table(spark, d, "dup_manifest"))


def p8_packs(spark: SparkSession, d: str) -> DataFrame:
    """Every document's place in the packs of each capacity, with the pack's fill."""
    sizes = stored(tokens.counted(table(spark, d, "documents"), ("doc_id",)), "sizes")
    kinds = table(spark, d, "pack_sizes").where("capacity_tokens >= 1").select("pack_kind", "capacity_tokens").distinct().collect()
    return packing.packed_kinds(sizes, [(k["pack_kind"], k["capacity_tokens"]) for k in kinds])


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """Packs, used room and fill of each capacity."""
    packs = p8_packs(spark, d).where("pack_id >= 0").groupBy("pack_kind", "pack_id").agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("t"), F.max("fill").alias("f"))
    return packs.groupBy("pack_kind").agg(
        F.count(F.lit(1)).alias("n_packs"), F.sum("n").alias("n_items"), F.sum("t").alias("n_tokens"), F.avg("f").alias("mean_fill"), F.min("f").alias("least_fill")
    )


def p9_draw(spark: SparkSession, d: str) -> DataFrame:
    """How often each document is drawn so that the sources reach their weights."""
    sizes = stored(tokens.counted(table(spark, d, "documents"), ("doc_id", "source")), "sizes")
    return mixing.drawn(sizes, table(spark, d, "mix_targets"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shares(p9_draw(spark, d), table(spark, d, "mix_targets"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return sentences.sentences(table(spark, d, "documents"))


QUERIES = {
    "p4_found": p4_found, "p8_packs": p8_packs, "p8_fill": p8_fill, "p9_draw": p9_draw, "p9_shares": p9_shares, "p10_found": p10_found,
    "p1_found": p1_found, "p1_groups": p1_groups, "p2_found": p2_found, "p3_found": p3_found, "p3_terms": p3_terms, "p7_found": p7_found,
}

_VALID = "regexp_full_match(fp_hex, '[0-9a-fA-F]{256}') and fp_hex <> repeat('0', 256)"
_CODES = f"""
rows as materialized (select row_id, source, relpath, batch_no, lower(fp_hex) h from fp_manifest where {_VALID}),
codes as materialized (select h, unhex(h)::bit c, min(batch_no) fb, row_number() over () cid from rows group by h),
near as materialized (select a.cid a, b.cid b, a.fb fa, b.fb fb from codes a join codes b on a.cid < b.cid and bit_count(xor(a.c, b.c)) <= 10)
"""
_TERMS = """
recs as (select lower(series_description) s, coalesce(counts, 0) w, row_number() over () r from series_map where series_description is not null),
occ as (select r, w, unnest(regexp_extract_all(s, '[\\p{L}\\p{Nd}]+')) term from recs),
terms as (select term, count(distinct r)::bigint n_rows, count(*)::bigint n_occurrences, sum(w)::bigint weight from occ group by term),
marked as (select *, case when n_rows < 3 or weight < 20 then 'rare' when n_rows > (select count(*) from recs) * 0.1 then 'common' end mark from terms)
"""
_CLEAN_FILES = """
m as (select lower(trim(source_a)) sa, regexp_replace(regexp_replace(file_a, '/+', '/', 'g'), '^(\\./)+', '') fa,
             lower(trim(source_b)) sb, regexp_replace(regexp_replace(file_b, '/+', '/', 'g'), '^(\\./)+', '') fb from dup_manifest),
e as (select sa || chr(1) || fa a, sb || chr(1) || fb b from m where (sa || fa || sb || fb) is not null)
"""



def _views_sql() -> str:
    """The same meaning of values by comparing every distinct word with every canonical one."""
    words = lambda c: f"regexp_extract_all(lower(regexp_replace({c}, '(\\p{{Ll}})(\\p{{Lu}})', '\\1 \\2', 'g')), '[\\p{{L}}\\p{{Nd}}]+')"
    joined = lambda c: f"regexp_replace(lower({c}), '[^\\p{{L}}\\p{{Nd}}]+', '', 'g')"

    def digits(w: str) -> str:
        for digit, name in canonical.DIGIT_WORDS.items():
            w = f"regexp_replace({w}, '^{name}', '{digit}')"
        return w

    bare = lambda w: f"left({w}, 1) || regexp_replace(substr({w}, 2), '[aeiou]', '', 'g')"
    short = lambda w: (
        f"list_concat(list_transform(range({canonical.LEAST_PREFIX}, len({w})), lambda n: left({w}, n)), "
        f"case when len({bare(w)}) >= {canonical.LEAST_SKELETON} and {bare(w)} <> {w} then [{bare(w)}] else [] end)"
    )
    edits = "case when len(ref) >= 6 then 2 when len(ref) >= 4 then 1 else 0 end"
    return f"""with vals as (select * from (select map_id, 0 col, series_description t from series_map union all select map_id, 1, cleaned_series_names from series_map) where trim(translate(t, chr(9) || chr(10) || chr(13), '   ')) <> ''),
base as (select view_id entry, 0 f, {words('view_name')} ws, {joined('view_name')} whole from view_list union all select view_id, 1, {words('view_code')}, {joined('view_code')} from view_list),
parts as (select *, unnest(ws) w, generate_subscripts(ws, 1) i from base),
refs as (select entry, f * 2 form, len(ws) slots, len(ws) size, i slot, unnest([w, {digits('w')}]) ref, 0 short from parts
  union select entry, f * 2 + 1, 1, len(ws), 0, whole, 0 from base
  union select entry, f * 2 + 1, 1, len(ws), 0, array_to_string(list_concat(ws[:i - 1], [v], ws[i + 1:]), ''), 1 from (select *, unnest(list_concat({short('w')}, [{digits('w')}])) v from parts where len(ws) > 1)),
known as materialized (select ref, bool_or(form % 2 = 0) single, case when regexp_matches(ref, '\\d') and len(ref) <= 8 then least({edits}, 1) else {edits} end k from refs group by ref),
tokens as materialized (select t, word, min(p) p from (select t, unnest({words('t')}) word, generate_subscripts({words('t')}, 1) - 1 p from (select distinct t from vals) union all select distinct t, {joined('t')}, 0 from vals) where word <> '' group by all),
free as (select distinct word from tokens),
close as (select word, ref, levenshtein(word, ref) d from free join known on abs(len(word) - len(ref)) <= k and levenshtein(word, ref) <= k where word not in (select ref from known) qualify d = min(d) over (partition by word)),
near as (select word, ref, min(d) d from (select word, word ref, 0 d from free where word in (select ref from known) union all select * from close
  union all select word, ref, 1 from free join (select ref, unnest({short('ref')}) s from known where single) on s = word) group by all),
slots as (select t, entry, form, slot, min((d + short, p)) m, max(slots) slots, max(size) size from tokens join near using (word) join refs using (ref) group by all),
scored as (select t, entry, max(size) size, sum(m[1]) e, min(m[2]) first, max(m[2]) last from slots group by t, entry, form having count(*) = max(slots)),
meant as (select t, arg_min(entry, (-size, e, last - first, first, entry)) entry from scored group by t)
select map_id, coalesce(arg_min(entry, col), 0)::bigint view_id from vals left join meant using (t) group by map_id"""


SQL = {
    "p4_found": _views_sql(),
    "p1_found": f"""with {_CODES},
r as (select row_id, source, relpath, cid from rows join codes using (h)),
pairs as (select a, b from near union all select cid, cid from codes)
select least(x.row_id, y.row_id) row_id_a, greatest(x.row_id, y.row_id) row_id_b
from pairs join r x on x.cid = a join r y on y.cid = b
where (a <> b or x.row_id < y.row_id) and not (x.source is not distinct from y.source and x.relpath is not distinct from y.relpath)""",
    "p1_groups": f"""with recursive {_CODES},
reps as (select cid, min(row_id) rid from rows join codes using (h) group by cid),
e as materialized (select x.rid a, y.rid b from near join reps x on x.cid = a join reps y on y.cid = b union select y.rid, x.rid from near join reps x on x.cid = a join reps y on y.cid = b),
walk as (select rid n, rid r from reps union select e.b, w.r from walk w join e on e.a = w.n and w.r < e.b),
best as (select n, min(r) g from walk group by n), links as (select a n, count(*) k from e group by a)
select row_id, g group_id, coalesce(k, 0)::bigint n_links from rows join codes using (h) join reps using (cid) join best on n = rid left join links on links.n = rid""",
    "p2_found": f"""with recursive {_CODES},
edges as materialized (select a, b, fa, fb from near where fb < fa union all select b, a, fb, fa from near where fa < fb),
steps as (
  select (select min(fb) from codes) as batch, []::bigint[] as refused
  union all
  select batch + 1, list_concat(refused, coalesce((select list(distinct a) from edges where fa = batch + 1 and not list_contains(refused, b)), []))
  from steps where batch < (select max(fb) from codes)),
refused as (select unnest(refused) cid from (select refused from steps order by batch desc limit 1)),
ids as (select row_id, batch_no, {canonical_id_sql('anon_accession')} v from copy_crosswalk)
select 'fp_manifest' src_table, row_id from rows join codes using (h) where batch_no > fb or cid in (select cid from refused)
union all
select 'copy_crosswalk', row_id from ids join (select v, min(batch_no) f from ids where v is not null group by v) using (v) where batch_no > f""",
    "p3_found": f"with {_TERMS} select term, mark from marked where mark is not null",
    "p3_terms": f"with {_TERMS} select term, n_rows, n_occurrences, weight, mark from marked",
    "p7_found": f"""with recursive {_CLEAN_FILES},
nodes as (select a n from e union select b from e),
links as (select a, b from e union select b, a from e),
walk as (select n, n r from nodes union select l.b, w.r from walk w join links l on l.a = w.n and w.r < l.b),
best as (select n, min(r) g from walk group by n)
select split_part(n, chr(1), 1) source, split_part(n, chr(1), 2) relpath, split_part(g, chr(1), 1) group_source, split_part(g, chr(1), 2) group_relpath from best""",
}
