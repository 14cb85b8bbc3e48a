"""Operators of the core against brute force, and their defined results on odd input."""

import itertools
import os
import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scanloom.functions import bits, naming
from scanloom.functions.ids import canonical_id
from scanloom.functions.layout import frame_count, series_layout
from scanloom.functions.natural import natural_key
from scanloom.operators import checksum, components, hamming_join, ordering, orphans, profile, reconcile, resolve, units, views
from scanloom.sources import config, tabular


def test_bit_scalars():
    assert [bits.allowed_bits(p) for p in (99, 100, 98.5, 101)] == [10, 0, 15, 0]
    assert (bits.band_count(10), bits.band_count(500), bits.band_count(-3)) == (11, 128, 1)
    assert bits.band_bounds(11, 128) == [0, 12, 23, 35, 47, 58, 70, 81, 93, 105, 116, 128]
    for stride in (1, 11):
        masks = bits.scattered_masks(11, stride)
        for lane in range(16):
            assert sum(m[lane] & ((1 << 64) - 1) for m in masks) == (1 << 64) - 1  # disjoint and complete


def codes(n, rng, flips=12):
    base = [rng.getrandbits(1024) for _ in range(n)]
    out = list(base)
    for b in base:
        for _ in range(2):
            c = b
            for p in rng.sample(range(1024), rng.randint(0, flips)):
                c ^= 1 << p
            out.append(c)
    return [f"{c:0256x}" for c in out]


def test_bands_find_every_near_pair(spark):
    rng = random.Random(1)
    rows = list(enumerate(codes(25, rng)))
    df = spark.createDataFrame(rows, "row_id bigint, fp_hex string")
    got = {(r.a, r.b): r.dist for r in hamming_join.near_codes(df, "row_id", "fp_hex", 10).collect()}
    first = {}
    for i, c in rows:
        first.setdefault(c, i)
    want = {}
    for (c, i), (e, j) in itertools.combinations(first.items(), 2):
        d = bin(int(c, 16) ^ int(e, 16)).count("1")
        if d <= 10:
            want[min(i, j), max(i, j)] = d
    assert got == want and want
    _, skipped = hamming_join.candidate_pairs(df.select(F.col("row_id").alias("cid"), F.col("fp_hex").alias("code"), F.lit(1).alias("n")), 11, 1)
    assert skipped.count() > 0


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=20))
def test_components_equal_search(spark, edges):
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b), near.setdefault(b, set()).add(a)
    want, seen = {}, 0
    for n in sorted(near):
        if n not in want:
            seen += 1
            todo = [n]
            while todo:
                x = todo.pop()
                if x not in want:
                    want[x] = seen
                    todo += near[x]
    df = spark.createDataFrame(edges, "a int, b int")
    assert {r.node: r.cluster_id for r in components.components(df).collect()} == want


def test_components_of_a_long_chain(spark):
    df = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert components.components(df).select("cluster_id").distinct().count() == 1


def test_natural_order(spark):
    names = ["a", "10", "9", "b10", "b2", "b1", "img12", "img2b", "img2a", "007", "7x", None, "99999999999999999999999"]
    got = [r.n for r in spark.createDataFrame([(n,) for n in names], "n string").orderBy(natural_key(F.col("n")).asc_nulls_first()).collect()]
    key = lambda s: [(0, int(x), "") if x.isdigit() else (1, 0, x) for x in re.findall(r"\d+|\D+", s)]
    assert got == [None, *sorted((n for n in names if n), key=key)]


def test_layouts(spark):
    rows = [([4, 5], None, "single", 1), ([1, 4, 5], None, "channels_first", 1), ([3, 4, 5], 3, "cine0", 3), ([7, 4, 5], None, "cine0", 7), ([7, 3, 4, 5], None, "cine0", 7), ([3, 7, 4, 5], None, "cine1", 7), ([3, 1, 4, 5], None, "cine1", 1), ([9, 8, 4, 5], 8, "cine1", 8), ([5], None, None, None)]
    df = spark.createDataFrame([(i, s, n) for i, (s, n, *_) in enumerate(rows)], "i int, s array<int>, n int")
    lay = series_layout(F.col("s"), F.col("n"))
    got = df.select("i", lay.alias("l"), frame_count(F.col("s"), lay).alias("c")).orderBy("i").collect()
    assert [(r.l, r.c) for r in got] == [(x, c) for *_, x, c in rows]


def test_names(spark):
    df = spark.createDataFrame([("12-AC-9.tgz", "/s/a_b_12/77.h5", "5_20209_2_0.zip"), ("nohyphen.tgz", "x.h5", "e")], "n string, p string, z string")
    a, b = df.select(naming.archive_ids(F.col("n")).alias("i"), naming.store_ids(F.col("p")).alias("s"), naming.zip_ids(F.col("z")).alias("z")).collect()
    assert (a.i.mrn, a.i.accession) == ("12", "AC-9") and (a.s.institution, a.s.mrn, a.s.accession, a.s.relpath) == ("a_b", "12", "77", "a_b_12/77.h5")
    assert (a.z.eid, a.z.instance) == ("5", "2") and b.i.mrn is None and b.z.instance is None
    assert naming.like_literal("a_b%") == r"a\_b\%" and naming.host_key("a-b") == "a_b"


def test_canonical_ids(spark):
    text = ["Ab-c_1.H5", " abc1 ", "abc1.h5", "", "  ", "NA", "nan", "None", "NULL", None, "-_", "n.h5"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in text], "t string").select(canonical_id(F.col("t"))).collect()]
    assert got == ["abc1"] * 3 + [None] * 8 + ["n"]


def test_order_inside_series(spark):
    df = spark.createDataFrame([("s", i, x) for i, x in enumerate([1.0, 1.0, 2.0, 2.0, 3.0])] + [("t", 0, None), ("t", 1, None), ("u", 0, 1.0)], "k string, i int, loc double")
    got = {r.k: (r.n_frames, r.slice_frames) for r in ordering.slice_boundaries(df, ["k"], F.col("loc"), [F.col("i")]).collect()}
    assert got == {"s": (5, [1, 3]), "t": (2, []), "u": (1, [])}
    pos = {(r.k, r.frame_pos): r.frame_idx for r in ordering.frame_positions(df, ["k"], [F.col("i")]).collect()}
    assert pos == {("s", "first"): 0, ("s", "middle"): 2, ("s", "last"): 4, ("t", "first"): 0, ("t", "middle"): 1, ("u", "first"): 0}
    for bad in ((), ("first", "end")):
        with pytest.raises(ValueError):
            ordering.check_positions(bad)
    folders = spark.createDataFrame([("a", i, 900) for i in range(12)] + [("b", 0, 9000)], "k string, f int, n int")
    kept = ordering.folder_cap(folders, ["k"], [F.col("f")]).collect()
    assert {(r.k, r.f) for r in kept} == {("a", 0), ("a", 1), ("b", 0)}
    assert ordering.strided(df.where("k = 's'"), F.col("i"), 2).count() == 3
    assert ordering.slice_boundaries(df.limit(0), ["k"], F.col("loc"), [F.col("i")]).count() == 0


def test_manifests(spark):
    a = spark.createDataFrame([("x/1", "a"), ("x/2", "b"), ("y/1", None), ("gone", "q")], "file string, checksum string")
    b = spark.createDataFrame([("x/1", "a"), ("x/2", "c"), ("y/1", None), ("added", "q")], "file string, checksum string")
    got = {(r.file, r.status) for r in reconcile.compare_manifests(a, b).collect()}
    assert got == {("x/2", "changed"), ("gone", "removed"), ("added", "added")}
    assert [r.file for r in reconcile.compare_manifests(a, b, missing=False).collect()] == ["x/2"]
    audit = reconcile.audit_counts(a, b, "file").first()
    assert (audit.n_inputs, audit.n_processed, audit.n_incomplete) == (4, 4, 1)


def test_resolution(spark):
    files = spark.createDataFrame([("inst_X/1.h5",), ("inst_a_X/1.h5",), ("inst_Y/2.h5",), ("inst_Y/2.h5",)], "relpath string")
    rows = spark.createDataFrame([(1, "X", "1", "m"), (2, "a_X", "1", "m"), (3, "Y", "2", "m"), (4, "Y", "9", "m"), (5, None, "2", "m"), (6, "Y", "2", None)], "row_id bigint, m string, a string, c string")
    got = {r.row_id: (r.status, r.relpath) for r in resolve.resolve_files(rows, files, "row_id", "m", "a", ["c"]).collect()}
    assert got == {1: ("ambiguous", None), 2: ("found", "inst_a_X/1.h5"), 3: ("found", "inst_Y/2.h5"), 4: ("not_found", None), 5: ("not_found", None), 6: ("skipped_no_id", None)}
    assert resolve.collisions(rows, ["m"]).count() == 3
    with pytest.raises(RuntimeError):
        resolve.guard_collisions(rows, ["m"])


def test_profiles(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "v string")
    assert [(r.v, r.frequency) for r in profile.frequency(df, "v").collect()] == [("b", 2), ("a", 1)]
    assert (None, 1) in [(r.v, r.frequency) for r in profile.frequency(df, "v", nulls=True).collect()]
    n = spark.createDataFrame([(0,), (1,), (1000,), (1001,)], "n int")
    assert [r[0] for r in n.select(profile.chunk_plan(F.col("n"))).collect()] == [[], [1], [1], [1, 1001]]
    assert profile.tag_columns(["x:Tag"]) == {"mrn": "PatientID", "accession": "AccessionNumber", "x": "Tag"}
    assert profile.tag_columns(["mrn:Other"])["mrn"] == "PatientID"
    for bad in ("x", "x:y:z", ":y"):
        with pytest.raises(ValueError):
            profile.tag_columns([bad])
    heads = spark.createDataFrame([("p", 3.0)], "PatientID string, SliceLocation double")
    assert profile.project_tags(heads).first().asDict() == {"mrn": "p", "accession": None, "series_description": None, "frame_loc": "3.0", "scanner": None, "field_strength": None}
    assert profile.sample_rows(df, 2, F.col("v"), 3).collect() == profile.sample_rows(df, 2, F.col("v"), 3).collect()


def test_views(spark):
    s = spark.createDataFrame([(1, "f", "raw1"), (2, "f", "raw2"), (3, "g", "raw2"), (4, "g", "other")], "id int, file string, raw string")
    m = spark.createDataFrame([("raw1", "V", 2), ("raw2", "V", 1), ("other", None, 3)], "raw string, view string, ord int")
    assert {r.id for r in views.map_views(s, m, "raw", ["file"], [F.col("ord")]).collect()} == {2, 3}
    every = views.map_views(s, m, "raw", ["file"], [], first_only=False, views=["V"])
    assert every.count() == 3 and views.view_coverage(every, "file").first().n_files == 2


def test_digests(spark):
    import hashlib

    rows = [("a", 2, b"y"), ("a", 1, b"x"), ("b", 1, None)]
    df = spark.createDataFrame(rows, "k string, i int, d binary")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    got = {r.k: r.digest for r in checksum.series_digest(df, ["k"], ["i"], F.col("d")).collect()}
    assert got == {"a": sha((sha(b"x") + sha(b"y")).encode()), "b": sha(sha(b"").encode())}
    assert {r.k: r.digest for r in checksum.stream_digest(df, ["k"], ["i"], "d").collect()} == {"a": sha(b"xy"), "b": sha(b"")}


def test_csv_keeps_ids(spark, tmp_path):
    (tmp_path / "m.csv").write_bytes("﻿id,name\r\n007,NA\r\n12,\"a,b\"\r\n,None\r\n".encode())
    assert [tuple(r) for r in tabular.read_csv(spark, str(tmp_path / "m.csv")).collect()] == [("007", None), ("12", "a,b"), (None, None)]
    (tmp_path / "b.bulk").write_text("123 20209_2_0\n124 20209_2_0\n")
    assert tabular.read_bulk(spark, str(tmp_path / "b.bulk")).count() == 2
    m = tabular.load_manifest(spark.createDataFrame([("r", "ab")], "relpath string, fp_hex string"), "lab")
    assert m.first().asDict() == {"source": "lab", "relpath": "r", "mrn": "", "accession": "", "series": "", "frame_pos": "", "n_frames": 0, "fp_hex": "ab"}


def test_device_profiles(monkeypatch):
    monkeypatch.delenv("DEVICE_NAME", raising=False)
    assert config.profile_name({"node_": "cluster"}, "node-17") == "cluster" and config.profile_name({}, "my-host") == "my_host"
    monkeypatch.setenv("DEVICE_NAME", "x")
    assert config.profile({"global": {"a": 1}, "devices": {"x": {"a": 2}}}) == {"a": 2}
    monkeypatch.setenv("DEVICE_NAME", "y")
    with pytest.raises(KeyError):
        config.profile({"devices": {}})


# -- orphans ------------------------------------------------------------------------------------------

REF = orphans.Reference("r", "id", "row_id", "t", "x", "id", "b", "e")


def test_orphans_equal_brute_force(spark):
    rng = random.Random(4)
    day = lambda n: f"2024-{1 + n // 28:02d}-{1 + n % 28:02d} 00:00:00"
    ids = ["a", "b", "c", "hot", "hot", "hot", None, "NA", "never"]
    refs = [(i, rng.choice(ids), rng.choice([*map(day, range(0, 200, 7)), None])) for i in range(150)]
    recs = [(rng.choice(ids[:6]), rng.choice([*map(day, range(0, 200, 5)), None]), rng.choice([*map(day, range(0, 200, 9)), None])) for _ in range(12)]
    r = spark.createDataFrame(refs, "row_id bigint, id string, t string").withColumn("t", F.col("t").cast("timestamp_ntz")).withColumn("live", F.lit(1))
    x = spark.createDataFrame(recs, "id string, b string, e string").withColumns({c: F.col(c).cast("timestamp_ntz") for c in "be"})
    got = {q.row_id: q.kind for q in orphans.direct_orphans(orphans.references(r, REF), orphans.targets(x, REF)).collect()}
    want = {}
    for i, k, t in refs:
        if k in (None, "NA"):
            continue
        mine = [(b, e) for k2, b, e in recs if k2 == k]
        if t and any(b and b <= t and (e is None or e > t) for b, e in mine):
            continue
        want[i] = "missing" if not mine else "late" if t and all(b and b > t for b, _ in mine) else "deleted"
    assert got == want and len(set(want.values())) == 3
    none = spark.createDataFrame([], x.schema)
    assert {q.kind for q in orphans.direct_orphans(orphans.references(r, REF), orphans.targets(none, REF)).collect()} == {"missing"}
    assert orphans.direct_orphans(orphans.references(r.limit(0), REF), orphans.targets(x, REF)).count() == 0


def test_cascade(spark):
    a = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B"), (4, None)], "id bigint, k string")
    b = spark.createDataFrame([(1, "A", "x"), (2, "B", "y"), (3, None, "z")], "id bigint, k string, own string")
    c = spark.createDataFrame([(1, "x"), (2, "y")], "id bigint, k string")
    graph = [orphans.Child("b", "id", "k", "a", "id", "k"), orphans.Child("c", "id", "k", "b", "id", "own"), orphans.Child("a", "id", "k", "c", "id", "k")]
    direct = spark.createDataFrame([("a", 1), ("a", 3)], "table string, row_id bigint")
    got = {(r.table, r.row_id): r.depth for r in orphans.cascade({"a": a, "b": b, "c": c}, direct, graph).collect()}
    assert got == {("a", 1): 0, ("a", 3): 0, ("b", 2): 1, ("c", 2): 2}  # A still has a live row 2


def test_cascade_adds_up_losses_of_rounds(spark):
    """The parents of a key that are lost in different rounds, and a cycle."""
    a = spark.createDataFrame([(i, f"a{i - 1}", f"a{i}") for i in range(1, 6)] + [(9, "a5", "a0")], "id bigint, up string, own string")
    b = spark.createDataFrame([(1, "x", 1), (2, "y", 2)], "id bigint, k string, month int")
    p = spark.createDataFrame([(1, "x", "a1"), (2, "x", "a3"), (3, "y", "a2"), (4, "y", None)], "id bigint, own string, up string")
    graph = [orphans.Child("a", "id", "up", "a", "id", "own", plain=True), orphans.Child("p", "id", "up", "a", "id", "own", plain=True), orphans.Child("b", "id", "k", "p", "id", "own", plain=True)]
    direct = spark.createDataFrame([("a", 1)], "table string, row_id bigint")
    got = {(r.table, r.row_id): r.depth for r in orphans.cascade({"a": a, "b": b, "p": p}, direct, graph).collect()}
    assert got == {("a", 1): 0, ("a", 2): 1, ("a", 3): 2, ("a", 4): 3, ("a", 5): 4, ("a", 9): 5, ("p", 1): 1, ("p", 2): 3, ("p", 3): 2, ("b", 1): 4}


# -- units --------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "text, context, want",
    [
        ("1.5", None, None), ("1,5", None, 1500), ("15,000 gauss", None, 1500), ("14,940 G", None, 1494), ("30 000 G", None, 3000), ("1.5E4 gauss", None, 1500), ("1500 MT", None, 1500), ("15 KG", None, 1500),
        ("f0 63.865 mhz", None, 1500), ("127.73 MHz (1H)", None, 3000), ("63866 kHz", None, 1500), ("B0=3T", None, 3000), ("~0.55T", None, 550), ("１．５ Ｔ", None, 1500), ("half a tesla", None, 500),
        ("ONE POINT FIVE T", None, 1500), ("1500000 µT", None, 1500), ("1.5/3", None, None), ("T", None, None), ("nan", None, None), (None, None, None), ("", None, None), ("0", None, None), ("0 T", None, None),
        ("2894", "x [B0:mT]", 2894), ("15", "Model; strength as kGs", 1500), ("15", "Model / kG", 1500), ("5", "rt_pair b0 in kG", 500), ("3", "Great T map", None), ("3", "Model (tesla)", None), ("0.350", None, None), (" 1.5", None, 1500),
    ],
)
def test_field_strengths(units_found, text, context, want):
    assert units_found[text, context] == want


@pytest.fixture(scope="module")
def units_found(spark):
    mark = next(m for m in test_field_strengths.pytestmark if m.name == "parametrize")
    cases = [(a, b) for a, b, _ in mark.args[1]]
    rows = [(i, a, b, None) for i, (a, b) in enumerate(cases)] + [(1000 + i, "1.5 tesla", None, None) for i in range(5)]
    df = spark.createDataFrame(rows, "row_id bigint, v string, scanner string, options string")
    got = {r.row_id: round(r.value) for r in units.common_values(df, "row_id", "v", "scanner", ("scanner",)).where("not plain_number").collect()}
    assert units.common_values(df.limit(0), "row_id", "v", "scanner", ("scanner",)).count() == 0
    return {c: got.get(i) for i, c in enumerate(cases)}


# -- every query against its SQL ------------------------------------------------------------------------

DATA = "/root/testdata/sf0.001"


def _core():
    from scanloom.plans import queries, tables

    return tables.QUERIES | queries.QUERIES, tables.SQL | queries.SQL


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", sorted(_core()[0]))
def test_query_equals_sql(spark, name):
    from tests.compare import same_rows

    queries, sql = _core()
    same_rows(queries[name](spark, DATA), sql.get(name), DATA)
