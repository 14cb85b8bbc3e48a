"""Behaviour of the crosswalk over batches."""

import pytest
from pyspark.sql import functions as F

from scanloom.operators import crosswalk as X

P, S = "Patient ID", "Study ID"
B1 = [("P1", "S1", "r1", 55), ("P1", "S2", "r2", 55), ("P2", "S3", "r3", 62), ("P3", "S4", "r4", 47), ("P3", "S5", "r5", 47), ("P4", "S6", "r6", 70)]
B2 = [("P3", "S7", "r7", 48), ("P4", "S8", "r8", 71), ("P5", "S9", "r9", 33), ("P6", "S10", "r10", 29), ("P6", "S11", "r11", 29)]


def batch(spark, rows):
    return spark.createDataFrame(rows, f"`{P}` string, `{S}` string, Report string, Age int")


@pytest.fixture(scope="module")
def two(spark):
    one, every1 = X.build(batch(spark, B1), None, P, S, "one")
    new, every = X.build(batch(spark, B2), every1, P, S, "two")
    return one, new, every


def test_first_batch(two):
    rows = two[0].collect()
    assert len(rows) == 6 and {r.batch for r in rows} == {"one"}
    by = {}
    for r in rows:
        by.setdefault(r[P], set()).add(r.anon_mrn)
        assert len(r.anon_mrn) == 10 and len(r.anon_accession) == 12 and r.anon_mrn == r.anon_mrn.lower()
    assert all(len(v) == 1 for v in by.values()) and len(set.union(*by.values())) == 4
    assert len({r.anon_accession for r in rows}) == 6


def test_returning_patients(two):
    one, new, every = two
    old = {r[P]: r.anon_mrn for r in one.collect()}
    mine = {r[P]: r.anon_mrn for r in new.collect()}
    assert mine["P3"] == old["P3"] and mine["P4"] == old["P4"] and not {mine["P5"], mine["P6"]} & set(old.values())
    assert every.count() == 11 and new.count() == 5
    counts = X.distinct_counts(every, ["anon_mrn", "anon_accession"]).first()
    assert (counts.n_anon_mrn, counts.n_anon_accession) == (6, 11)


def test_numbers_and_text_are_one_id(spark):
    b1 = spark.createDataFrame([(101, "S1"), (102, "S2")], f"`{P}` int, `{S}` string")
    b2 = spark.createDataFrame([("101", "S3"), ("ABC103", "S4")], f"`{P}` string, `{S}` string")
    _, e1 = X.build(b1, None, P, S)
    _, e2 = X.build(b2, e1, P, S, "b2")
    ids = {r[P]: set() for r in e2.collect()}
    for r in e2.collect():
        ids[r[P]].add(r.anon_mrn)
    assert len(ids["101"]) == 1


def test_salted_ids_repeat_and_collisions_draw_again(spark):
    new = spark.createDataFrame([("a",), ("b",)], "k string")
    first = X.hashed_id(F.lit("a"), "salt", 8)
    taken = spark.range(1).select(F.lit("z").alias("k"), first.alias("o"))
    got = {r.k: r.o for r in X.assign_ids(new, taken, "k", "o", 8, "salt").collect()}
    assert got["a"] != taken.first().o and len(set(got.values())) == 2
    assert got == {r.k: r.o for r in X.assign_ids(new, taken, "k", "o", 8, "salt").collect()}


def test_exhausted_ids_are_an_error(spark):
    new = spark.createDataFrame([(str(i),) for i in range(40)], "k string")
    with pytest.raises(RuntimeError):
        X.assign_ids(new, spark.createDataFrame([], "k string, o string"), "k", "o", 1, "salt", attempts=3)


def test_repeated_scans(spark, two):
    dup = batch(spark, [("P3", "S1", "r", 1)] + B2[1:])
    assert [r[S] for r in X.repeated_rows(dup, two[0], S).collect()] == ["S1"]
    assert X.repeated_rows(batch(spark, B2), two[0], S).count() == 0
    with pytest.raises(RuntimeError):
        X.build(batch(spark, [B1[0], B1[0]]), None, P, S)
    assert X.preview(spark.range(13).withColumn("id", F.lpad(F.col("id").cast("string"), 2, "0")), "id").endswith("(+3 more)")


@pytest.mark.parametrize("rows", [[("P1", "S1", "", 1), (None, "S2", "", 1)], [("P1", None, "", 1)]])
def test_null_ids_are_rejected(spark, rows):
    with pytest.raises(ValueError, match=P if rows[-1][0] is None else S):
        X.build(batch(spark, rows), None, P, S)


def test_validation(spark):
    with pytest.raises(ValueError, match=S):
        X.build(batch(spark, B1).drop(S), None, P, S)
    with pytest.raises(ValueError, match="anon_mrn"):
        X.build(batch(spark, B2), batch(spark, B1), P, S)
    for n in (0, 33):
        with pytest.raises(ValueError):
            X.build(batch(spark, B1), None, P, S, mrn_len=n)
    prior = spark.createDataFrame([("P1", "S1", "a", "x"), ("P1", "S2", "b", "y")], f"`{P}` string, `{S}` string, anon_mrn string, anon_accession string")
    with pytest.raises(RuntimeError):
        X.build(batch(spark, B2), prior, P, S)


def test_sanity(spark):
    bad = spark.createDataFrame([("P1", "aaa"), ("P2", "aaa"), ("P3", "b"), ("P3", "c"), (None, "d")], "l string, r string")
    assert {(r.side, r.id, r.n_partners) for r in X.bijection_faults(bad, "l", "r").collect()} == {("right", "aaa", 2), ("left", "P3", 2)}


def test_prior_without_batch_gets_a_label(spark, two):
    _, every = X.build(batch(spark, B2), two[0].drop("batch"), P, S, "two")
    assert {r.batch for r in every.select("batch").distinct().collect()} == {"prior", "two"}
    assert set(every.columns) >= {P, S, "Report", "Age", "anon_mrn", "anon_accession", "batch"}


def test_the_first_prior_row_counts(spark):
    """Of several prior rows of a key the first in order gives the id, not the smallest id."""
    prior = spark.createDataFrame([("a", "zz", 1), ("a", "bb", 2), ("b", None, 1), ("b", "cc", 3), ("b", "aa", 4)], "k string, o string, row int")
    new = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    got = {r.k: r.o for r in X.assign_ids(new, prior, "k", "o", 8, "salt", [F.col("row")]).collect()}
    assert got["a"] == "zz" and got["b"] == "cc" and len(got["c"]) == 8


def test_a_crosswalk_row_is_taken_as_a_whole(spark):
    from scanloom.operators import resolve

    xw = spark.createDataFrame([("S", "m9", "a1", 1), ("S", "m1", "a9", 2), ("T", None, "a0", 3), ("T", "m2", "a2", 4)], "accession string, anon_mrn string, anon_accession string, row int")
    rows = spark.createDataFrame([(1, "S"), (2, "T"), (3, "U")], "id int, acc string")
    done, left = resolve.anonymised(rows, xw, [(F.col("acc"), "accession")], ["anon_mrn", "anon_accession"], "row")
    assert {(r.id, r.anon_mrn, r.anon_accession) for r in done.collect()} == {(1, "m9", "a1"), (2, "m2", "a2")}
    unordered, _ = resolve.anonymised(rows, xw.drop("row"), [(F.col("acc"), "accession")], ["anon_mrn", "anon_accession"])
    assert {(r.id, r.anon_mrn, r.anon_accession) for r in unordered.collect()} == {(1, "m1", "a9"), (2, "m2", "a2")}
    assert [r.id for r in left.collect()] == [3]
