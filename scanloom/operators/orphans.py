"""References to records that do not exist: direct orphans by time of reference, and inherited ones.

A target record is live in a time interval; a reference is good when some record with its id was live
at the reference's own time. Instead of pairing references with records, both become points on one
time line per id: begins count +1, ends -1, and the running sum at a reference is the number of live
records. The time line of an id is cut by month; what earlier months carry in is summed first, so an
id that holds a third of all rows is spread over many tasks. All references to all targets go through
one pass: the target is part of the key.

The cascade then marks children of orphaned records as indirectly orphaned, by semi-joins down the
foreign-key graph to a fixpoint. It is semi-naive: a round looks at the keys of the records found in the
round before only, and adds up how many parents of a key are lost so far.

Defined results: NULL ids (see ``canonical_id``) are no reference; a record whose begin is NULL or not
before its end was never live but exists; a reference with NULL time is live to nothing, hence
``missing`` or ``deleted``; empty tables give empty results; repeated rows are rows of their own.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import canonical_id
from ..session import cut, cut_counted, stored


@dataclass(frozen=True)
class Reference:
    """A foreign key: ``table.field`` (with time and row id) refers to ``target.target_field``."""

    table: str
    field: str
    row_id: str
    time: str
    target: str
    target_field: str
    begin: str
    end: str


def references(df: DataFrame, ref: Reference) -> DataFrame:
    return df.select(F.col(ref.row_id).cast("bigint").alias("row_id"), canonical_id(F.col(ref.field)).alias("id"), F.col(ref.time).alias("t")).where("id is not null")


def targets(df: DataFrame, ref: Reference) -> DataFrame:
    return df.select(canonical_id(F.col(ref.target_field)).alias("id"), F.col(ref.begin).alias("b"), F.col(ref.end).alias("e")).where("id is not null")


def dead_points(refs: DataFrame, records: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, t, kind): the distinct points of reference at which no record is live."""
    lived = records.where("b is not null and (e is null or e > b)")
    points = (
        lived.select(*keys, F.col("b").alias("t"), F.lit(1).alias("delta"), F.lit(0).alias("asked"))
        .union(lived.where("e is not null").select(*keys, "e", F.lit(-1), F.lit(0)))
        .union(refs.select(*keys, "t", F.lit(0), F.lit(1)))
        .groupBy(*keys, "t").agg(F.sum("delta").alias("delta"), F.max("asked").alias("asked"))
        .withColumn("month", F.date_trunc("month", "t"))
    )
    points = stored(points, "points")
    months = points.groupBy(*keys, "month").agg(F.sum("delta").alias("delta"))
    before = Window.partitionBy(*keys).orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    carried = months.select(*keys, F.col("month").alias("m"), F.coalesce(F.sum("delta").over(before), F.lit(0)).alias("carried"))
    within = Window.partitionBy(*keys, "month").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    here = points.withColumn("here", F.sum("delta").over(within)).where("asked = 1")
    dead = here.join(carried.withColumnsRenamed({k: f"c_{k}" for k in keys}), _equal(keys, "c_") & F.col("month").eqNullSafe(F.col("m"))).where("here + carried = 0").select(*keys, "t")
    first = records.groupBy(*keys).agg(F.min("b").alias("first"), F.max(F.col("b").isNull()).alias("undated"))
    kind = (
        F.when(F.col("undated").isNull(), "missing")
        .when((F.col("first") > F.col("t")) & ~F.col("undated"), "late").otherwise("deleted")
    )
    return dead.join(first, keys, "left").select(*keys, "t", kind.alias("kind"))


def _equal(keys: list[str], prefix: str) -> Column:
    return reduce(Column.__and__, [F.col(k) == F.col(prefix + k) for k in keys])


def direct_orphans(refs: DataFrame, records: DataFrame, keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """The rows of ``refs`` (row_id, keys, t, ..) to no live record, with kind: ``missing``, ``late`` or ``deleted``.

    ``records`` has (keys, b, e).
    """
    dead = dead_points(refs, records, list(keys)).withColumnsRenamed({k: f"d_{k}" for k in (*keys, "t")})
    return refs.join(dead, _equal(list(keys), "d_") & F.col("t").eqNullSafe(F.col("d_t"))).drop(*[f"d_{k}" for k in (*keys, "t")])


def orphan_rows(tables: dict[str, DataFrame], refs: list[Reference]) -> DataFrame:
    """(ref_table, ref_field, row_id, kind, t) over all references; each table is read once for its references and once as target."""
    aims = sorted({(r.target, r.target_field, r.begin, r.end) for r in refs})
    asked, lived = None, None
    for name in sorted({r.table for r in refs}):
        mine = [(i, r) for i, r in enumerate(refs) if r.table == name]
        for row_id, time in sorted({(r.row_id, r.time) for _, r in mine}):
            same = [(i, r) for i, r in mine if (r.row_id, r.time) == (row_id, time)]
            ids = F.array(*[F.struct(F.lit(i).alias("ref"), F.lit(aims.index((r.target, r.target_field, r.begin, r.end))).alias("aim"), canonical_id(F.col(r.field)).alias("id")) for i, r in same])
            part = tables[name].select(F.col(row_id).cast("bigint").alias("row_id"), F.col(time).alias("t"), F.explode(ids).alias("x")).select("row_id", "t", "x.ref", "x.aim", "x.id").where("id is not null")
            asked = part if asked is None else asked.union(part)
    for name in sorted({a[0] for a in aims}):
        for begin, end in sorted({a[2:] for a in aims if a[0] == name}):
            ids = F.array(*[F.struct(F.lit(i).alias("aim"), canonical_id(F.col(a[1])).alias("id")) for i, a in enumerate(aims) if (a[0], a[2], a[3]) == (name, begin, end)])
            part = tables[name].select(F.col(begin).alias("b"), F.col(end).alias("e"), F.explode(ids).alias("x")).select("x.aim", "x.id", "b", "e").where("id is not null")
            lived = part if lived is None else lived.union(part)
    named = lambda what: F.element_at(F.array(*[F.lit(getattr(r, what)) for r in refs]), F.col("ref") + 1)
    return direct_orphans(asked, lived, ("aim", "id")).select(named("table").alias("ref_table"), named("field").alias("ref_field"), "row_id", "kind", "t")


@dataclass(frozen=True)
class Child:
    """A child's key and the parent's key that it repeats; a child hangs on all parent rows with the key."""

    table: str
    row_id: str
    key: str
    parent: str
    parent_row_id: str
    parent_key: str
    plain: bool = False  # compare the keys as they are, not as ids in any spelling
    time: str | None = None  # the child's own time, for reports


def _links(tables: dict[str, DataFrame], graph: list[Child]) -> DataFrame:
    """(role, edge, table, row_id, k, t): every key of the graph's edges, as child or as parent; each table is read once."""
    ends: dict[tuple[str, str], list[tuple[str, int, str, bool, str | None]]] = {}
    for i, c in enumerate(graph):
        ends.setdefault((c.table, c.row_id), []).append(("child", i, c.key, c.plain, c.time))
        ends.setdefault((c.parent, c.parent_row_id), []).append(("parent", i, c.parent_key, c.plain, None))
    out = None
    for (name, row_id), parts in ends.items():
        when = next((F.col(p[4]) for p in parts if p[4]), F.lit(None)).cast("timestamp_ntz").alias("t")
        keys = F.array(*[F.struct(F.lit(role).alias("role"), F.lit(i).alias("edge"), (F.col(key).cast("string") if plain else canonical_id(F.col(key))).alias("k")) for role, i, key, plain, _ in parts])
        part = tables[name].select(F.lit(name).alias("table"), F.col(row_id).cast("bigint").alias("row_id"), when, F.explode(keys).alias("x"))
        part = part.select("x.role", "x.edge", "table", "row_id", "x.k", "t").where("k is not null")
        out = part if out is None else out.union(part)
    return out


def cascade(tables: dict[str, DataFrame], direct: DataFrame, graph: list[Child]) -> DataFrame:
    """(table, row_id, depth, field, t): depth 0 for direct orphans, n for rows n steps below one.

    ``direct`` has (table, row_id). A child is an inherited orphan when its key is found in its parent
    table and every parent row with the key is an orphan; ``field`` is the key it inherits by and t its own
    time, NULL for direct ones. Rounds go on to a fixpoint, so cycles in the graph end as well.
    """
    frontier = cut(direct.select("table", F.col("row_id").cast("bigint").alias("row_id")).distinct())
    found = [frontier.select("table", "row_id", F.lit(0).alias("depth"), F.lit(None).cast("string").alias("field"), F.lit(None).cast("timestamp_ntz").alias("t"))]
    if not graph:
        return found[0]
    links = stored(_links(tables, graph), "links", ("role",))
    parents, children = links.where("role = 'parent'"), links.where("role = 'child'")
    fields = F.element_at(F.array(*[F.lit(c.key) for c in graph]), F.col("edge") + 1)
    lost: list[DataFrame] = []
    while True:
        # parents lost in this round, by key; only these keys can have become dead
        touched, n = cut_counted(parents.join(frontier, ["table", "row_id"], "left_semi").groupBy("edge", "k").agg(F.count(F.lit(1)).alias("lost")), F.lit(True))
        if not n:
            return reduce(DataFrame.union, found)
        lost.append(touched)
        keys = touched.select("edge", "k")
        all_parents = parents.join(keys, ["edge", "k"], "left_semi").groupBy("edge", "k").agg(F.count(F.lit(1)).alias("all"))
        so_far = reduce(DataFrame.union, lost).join(keys, ["edge", "k"], "left_semi").groupBy("edge", "k").agg(F.sum("lost").alias("lost"))
        dead = all_parents.join(so_far, ["edge", "k"]).where(F.col("lost") == F.col("all")).select("edge", "k")
        hit = children.join(dead, ["edge", "k"], "left_semi").groupBy("table", "row_id").agg(F.min("edge").alias("edge"), F.min("t").alias("t"))
        known = reduce(DataFrame.union, [x.select("table", "row_id") for x in found])
        fresh, n = cut_counted(hit.join(known, ["table", "row_id"], "left_anti").select("table", "row_id", F.lit(len(found)).alias("depth"), fields.alias("field"), "t"), F.lit(True))
        if not n:
            return reduce(DataFrame.union, found)
        found.append(fresh)
        frontier = fresh.select("table", "row_id")


def orphan_report(tables: dict[str, DataFrame], refs: list[Reference], graph: list[Child]) -> DataFrame:
    """(ref_table, ref_field, row_id, kind, t, depth): direct orphans per reference at depth 0, and inherited ones below them.

    An inherited orphan has kind ``inherited``; a record that is a direct orphan by some reference is not
    repeated as an inherited one.
    """
    direct = stored(orphan_rows(tables, refs), "direct")
    found = cascade(tables, direct.select(F.col("ref_table").alias("table"), "row_id"), graph).where("depth > 0")
    return direct.withColumn("depth", F.lit(0)).union(found.select("table", "field", "row_id", F.lit("inherited"), "t", "depth"))
