"""Anonymisation crosswalk: stable ids for patients and scans over batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.anon import check_length, hashed_id, random_id
from ..session import cut, cut_counted

MAX_ATTEMPTS = 1000
PREVIEW = 10


def require_columns(df: DataFrame, columns: list[str], label: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{label} lacks columns: {', '.join(missing)}")


def reject_nulls(df: DataFrame, columns: list[str], label: str) -> None:
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns]).first()
    bad = [c for c in columns if counts[c]]
    if bad:
        raise ValueError(f"{label} has NULL in: {', '.join(bad)}")


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def conflicts(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, n_values) of keys with several values; NULLs are no value."""
    return df.groupBy(key).agg(F.countDistinct(value).alias("n_values")).where("n_values > 1")


def bijection_faults(df: DataFrame, left: str, right: str) -> DataFrame:
    """(side, id, n_partners): ids of either side with more than one partner, checked key by key."""
    def side(a: str, b: str, name: str) -> DataFrame:
        return conflicts(df.where(F.col(f"`{a}`").isNotNull()), a, b).select(F.lit(name).alias("side"), F.col(f"`{a}`").cast("string").alias("id"), F.col("n_values").alias("n_partners"))

    return side(left, right, "left").union(side(right, left, "right"))


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*[F.countDistinct(c).alias(f"n_{c}") for c in columns])


def overlap(new: DataFrame, prior: DataFrame, key: str) -> DataFrame:
    """Distinct keys of the new batch that the prior ones have."""
    return new.select(key).distinct().join(prior.select(key).distinct(), key, "left_semi")


def repeated_rows(new: DataFrame, prior: DataFrame, key: str) -> DataFrame:
    """Rows of the new batch whose key a prior batch has."""
    return new.join(prior.select(key), key, "left_semi")


def preview(df: DataFrame, column: str, n: int = PREVIEW) -> str:
    """The first ids and how many more there are; for messages about anonymous ids only."""
    rows = [r[0] for r in df.select(column).orderBy(column).limit(n + 1).collect()]
    more = df.count() - n if len(rows) > n else 0
    return ", ".join(map(str, rows[:n])) + (f" (+{more} more)" if more else "")


def assign_ids(new: DataFrame, prior: DataFrame, key: str, out: str, length: int, salt: str | None = None, order: list[Column] | None = None, attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """(key, out) for each distinct key of the new batch: the id of the first prior row in ``order``, else a fresh one.

    Fresh ids are salted hashes, or random without a salt. An id that collides with a known or another
    fresh one is drawn again, round by round; after ``attempts`` rounds it is an error. A round is written
    once; random ids are written before they are judged, as a task that runs again would draw others.
    """
    check_length(length)
    known = first_by(prior.where(F.col(out).isNotNull()), [key], order or [F.col(out)]).select(key, out)
    mine = new.select(key).distinct().join(known, key, "left")
    done, open_ = mine.where(F.col(out).isNotNull()), mine.where(F.col(out).isNull()).select(key)
    taken = prior.select(out).where(F.col(out).isNotNull()).distinct()
    for attempt in range(attempts):
        drawn = open_.withColumn(out, hashed_id(F.col(key), salt, length, F.lit(attempt)) if salt is not None else random_id(length))
        drawn = drawn if salt is not None else cut(drawn)
        w = Window.partitionBy(out).orderBy(key)
        ok = F.col("__taken").isNull() & (F.col("__rn") == 1)
        judged = drawn.join(taken.withColumn("__taken", F.lit(1)), out, "left").withColumn("__rn", F.row_number().over(w)).select(key, out, ok.alias("ok"))
        judged, collided = cut_counted(judged, ~F.col("ok"))
        good = judged.where("ok").select(key, out)
        done, taken = done.unionByName(good), taken.union(good.select(out))
        if not collided:
            return done
        open_ = judged.where("not ok").select(key)
    raise RuntimeError(f"no free id of length {length} after {attempts} attempts")


def build(new: DataFrame, prior: DataFrame | None, mrn: str, acc: str, label: str = "batch", mrn_len: int = 10, acc_len: int = 12, salt: str | None = None, order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(new rows with ids, all rows): guards first, then ids, then guards on the result.

    Ids are read as text. Scans keep the id of a prior batch, patients and scans that of their first prior
    row by ``order``, a column of the prior crosswalk that the results leave out; a scan twice in one batch is an error, as
    one scan would have two rows claiming one id. Both results are cut before they are checked, so what
    is checked is what is written.
    """
    check_length(mrn_len), check_length(acc_len)
    require_columns(new, [mrn, acc], "input")
    reject_nulls(new, [mrn, acc], "input")
    text = lambda df: df.withColumns({c: F.col(f"`{c}`").cast("string") for c in (mrn, acc)})
    new = text(new)
    if prior is None:
        prior = new.limit(0).withColumns({"anon_mrn": F.lit(None).cast("string"), "anon_accession": F.lit(None).cast("string")})
    require_columns(prior, [mrn, acc, "anon_mrn", "anon_accession"], "prior")
    prior = text(prior)
    if "batch" not in prior.columns:
        prior = prior.withColumn("batch", F.lit("prior"))
    if conflicts(prior, f"`{mrn}`", "anon_mrn").head(1):
        raise RuntimeError("the prior crosswalk gives one patient several ids")
    if new.groupBy(f"`{acc}`").count().where("count > 1").head(1):
        raise RuntimeError("a scan occurs twice in the new batch")
    first = [F.col("__order")] if order else None
    rank = [F.col(f"`{order}`").alias("__order")] if order else []
    plain = lambda df, c: df.select(F.col(f"`{c}`").alias("k"))
    patients = assign_ids(plain(new, mrn), prior.select(F.col(f"`{mrn}`").alias("k"), "anon_mrn", *rank), "k", "anon_mrn", mrn_len, salt, first)
    scans = assign_ids(plain(new, acc), prior.select(F.col(f"`{acc}`").alias("k"), "anon_accession", *rank), "k", "anon_accession", acc_len, salt, first)
    prior = prior.drop(order) if order else prior
    done = (
        new.join(patients.withColumnRenamed("k", "__m"), F.col(f"`{mrn}`") == F.col("__m")).drop("__m")
        .join(scans.withColumnRenamed("k", "__a"), F.col(f"`{acc}`") == F.col("__a")).drop("__a").withColumn("batch", F.lit(label))
    )
    done = cut(done)
    every = cut(prior.unionByName(done, allowMissingColumns=True))
    for real, anon in ((mrn, "anon_mrn"), (acc, "anon_accession")):
        if bijection_faults(every.select(F.col(f"`{real}`").alias("r"), F.col(anon).alias("a")).distinct(), "r", "a").head(1):
            raise RuntimeError(f"{real} and {anon} are not one to one")
    return done, every
