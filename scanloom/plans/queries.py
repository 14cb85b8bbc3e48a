"""Queries of the core operators over the data tables, and their DuckDB counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import canonical_id_sql
from ..operators import orphans, units
from ..session import table
from . import exchange

ORPHAN_REFS = [
    orphans.Reference(t, f, row, "loaded_at", "store_files", f, "stored_at", "removed_at")
    for t, row in (("archive_crosswalk", "xw_id"), ("copy_crosswalk", "row_id")) for f in ("anon_mrn", "anon_accession")
] + [orphans.Reference("copy_crosswalk", "crosswalk_accession", "row_id", "loaded_at", "checksum_manifest", "file", "checked_at", "removed_at")]

#: A catalogue row hangs on the crosswalk rows of its real accession.
ORPHAN_GRAPH = [
    orphans.Child("metadata_catalog", "row_id", "accession", "archive_crosswalk", "xw_id", "accession", plain=True),
    orphans.Child("copy_crosswalk", "row_id", "anon_accession", "archive_crosswalk", "xw_id", "anon_accession", time="loaded_at"),
    orphans.Child("checksum_manifest", "check_id", "file", "copy_crosswalk", "row_id", "crosswalk_accession", time="checked_at"),
]


def _orphan_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    names = ("archive_crosswalk", "copy_crosswalk", "store_files", "checksum_manifest", "metadata_catalog")
    return {n: table(spark, d, n) for n in names}


def _orphan_report(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_report(_orphan_tables(spark, d), ORPHAN_REFS, ORPHAN_GRAPH)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """The direct orphans of the report."""
    return _orphan_report(spark, d).where("depth = 0").select("ref_table", "ref_field", "row_id", "kind")


def p5_months(spark: SparkSession, d: str) -> DataFrame:
    """Direct and inherited orphans per table, field, kind and month of the row's time."""
    found = _orphan_report(spark, d)
    return found.groupBy("ref_table", "ref_field", "kind", F.date_format("t", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n_orphans"))


def p5_cascade(spark: SparkSession, d: str) -> DataFrame:
    """Every orphan with the steps from a direct one to it: depth 0 is direct."""
    return _orphan_report(spark, d).select("ref_table", "ref_field", "row_id", "kind", "depth", F.date_format("t", "yyyy-MM").alias("month"))


def p6_values(spark: SparkSession, d: str) -> DataFrame:
    """Every stated field strength in millitesla, with its residual and whether the reading is unique."""
    return units.common_values(table(spark, d, "metadata_catalog"), "row_id", "field_strength", "scanner", ("scanner", "series_description"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return p6_values(spark, d).where("not plain_number").select("row_id", F.round("value").cast("bigint").alias("field_mt"))


QUERIES = exchange.QUERIES | {"p6_found": p6_found, "p6_values": p6_values, "p5_found": p5_found, "p5_months": p5_months, "p5_cascade": p5_cascade}


def _orphan_sql() -> str:
    parts = []
    for r in ORPHAN_REFS:
        parts.append(f"""select '{r.table}' ref_table, '{r.field}' ref_field, r.{r.row_id} row_id, r.{r.time} t,
case when first is null and undated is null then 'missing' when first > r.{r.time} and undated = 0 then 'late' else 'deleted' end kind
from (select *, {canonical_id_sql(r.field)} k from {r.table}) r
left join (select {canonical_id_sql(r.target_field)} k, min({r.begin}) first, max(({r.begin} is null)::int) undated from {r.target} group by 1) f on f.k = r.k
where r.k is not null and not exists (
  select 1 from (select {canonical_id_sql(r.target_field)} k, {r.begin} b, {r.end} e from {r.target}) x
  where x.k = r.k and x.b <= r.{r.time} and (x.e > r.{r.time} or x.e is null))""")
    return "\nunion all\n".join(parts)


def _report_sql(rounds: int = 3) -> str:
    """The cascade unrolled: the foreign keys here are two steps deep, a third round must find nothing."""
    steps = [f"direct as materialized ({_orphan_sql()})", "k0 as materialized (select distinct ref_table tab, row_id, 0 depth, null::int edge, null::timestamp t from direct)"]
    for i in range(1, rounds + 1):
        parts = []
        for n, c in enumerate(ORPHAN_GRAPH):
            key = (lambda x: x) if c.plain else canonical_id_sql
            parts.append(
                f"select '{c.table}' tab, {c.row_id} row_id, {n} edge, {c.time or 'null::timestamp'} t from {c.table} where {key(c.key)} in (select x.k from (select {key(c.parent_key)} k, {c.parent_row_id} r from {c.parent}) x "
                f"left join k{i - 1} o on o.tab = '{c.parent}' and o.row_id = x.r where x.k is not null group by x.k having bool_and(o.row_id is not null))"
            )
        steps.append(f"k{i} as materialized (select * from k{i - 1} union all select tab, row_id, {i}, min(edge), min(t) from ({' union all '.join(parts)}) n where not exists (select 1 from k{i - 1} o where o.tab = n.tab and o.row_id = n.row_id) group by tab, row_id)")
    fields = " ".join(f"when {n} then '{c.key}'" for n, c in enumerate(ORPHAN_GRAPH))
    steps.append(f"report as (select ref_table, ref_field, row_id, kind, t, 0 depth from direct union all select tab, case edge {fields} end, row_id, 'inherited', t, depth from k{rounds} where depth > 0)")
    return f'with {", ".join(steps)}'


_WIDE = "".join(map(chr, range(0xFF01, 0xFF5F))) + "\u3000\u03bc"
_PLAIN = ("".join(map(chr, range(0x21, 0x7F))) + " \u00b5").replace("'", "''")


def _unit_sql() -> str:
    """Field strengths by another way: candidates of number and unit as rows, the one nearest 1.5 tesla wins."""
    t = f"regexp_replace(lower(trim(translate(field_strength, '{_WIDE}', '{_PLAIN}'))), '\\bhalf an? ', '0.5 ', 'g')"
    for word, digit in units.NUMBER_WORDS.items():
        t = f"regexp_replace({t}, '\\b{word}\\b', '{digit}', 'g')"
    t = f"regexp_replace({t}, '(\\d) point (\\d)', '\\1.\\2', 'g')"
    alts = units._alternatives()
    long_names = "|".join(n for n in alts.split("|") if len(n) > 4)
    named = lambda c: (
        f"coalesce(nullif(regexp_extract(lower(coalesce({c}, '')), '(?:[\\[(:/=]\\s*|\\b(?:in|as)\\s+)({alts})\\s*(?:[\\])]|$|[;,])', 1), ''), "
        f"nullif(regexp_extract(lower(coalesce({c}, '')), '(?:^|[^a-z0-9\u00b5])({long_names})(?:$|[^a-z0-9])', 1), ''))"
    )
    factors = ", ".join(f"('{n}', {f!r}::double)" for n, fs in units.unit_readings().items() for f in fs)
    number = "(?:\\d{1,3}(?: \\d{3})+|\\d[\\d.,]*|[.,]\\d+)(?:e[+-]?\\d+)?"
    return f"""with u(name, factor) as (values {factors}),
a as (select row_id, field_strength raw, regexp_replace({t}, '\\b[bf]0\\b\\s*[=:]?|\\(1h\\)|\\b1h\\b', ' ', 'g') x, {named('scanner')} c1, {named('series_description')} c2 from metadata_catalog),
b as (select *, regexp_extract_all(x, '{number}') nums, nullif(regexp_extract(regexp_replace(x, '{number}', ' ', 'g'), '(?:^|[^a-z\u00b5])({alts})(?:$|[^a-z])', 1), '') own from a),
c as (select *, coalesce(own, c1, c2, 'tesla') unit, regexp_extract(nums[1], '^([^e]*)', 1) m0, regexp_extract(nums[1], '(e[+-]?\\d+)$', 1) ex from b where len(nums) = 1),
d as (select *, regexp_replace(m0, '[ ]|[.,]$', '', 'g') m from c where not (regexp_full_match(raw, '\\d+\\.?\\d*|\\.\\d+') and unit in ('t', 'tesla', 'teslas'))),
e as (select row_id, unit, unnest([case when regexp_full_match(m, '\\d*[.,]?\\d*') then replace(m, ',', '.') || ex end,
  case when regexp_full_match(m, '\\d{{1,3}}(,\\d{{3}})+(\\.\\d*)?') then replace(m, ',', '') || ex end,
  case when regexp_full_match(m, '\\d{{1,3}}(\\.\\d{{3}})+(,\\d*)?') then replace(replace(m, '.', ''), ',', '.') || ex end]) v from d),
f as (select row_id, try_cast(v as double) * factor mt from e join u on name = replace(unit, '-', '') where try_cast(v as double) > 0)
select row_id, round(arg_min(mt, abs(ln(mt / 1500))))::bigint field_mt from f group by row_id"""


SQL = exchange.SQL | {
    "p5_cascade": f"{_report_sql()} select ref_table, ref_field, row_id, kind, depth::int as depth, strftime(t, '%Y-%m') as month from report",
    "p6_found": _unit_sql(),
    "p5_found": f"select ref_table, ref_field, row_id, kind from ({_orphan_sql()})",
    "p5_months": f"{_report_sql()} select ref_table, ref_field, kind, strftime(t, '%Y-%m') as month, count(*)::bigint n_orphans from report group by 1, 2, 3, 4",
}
