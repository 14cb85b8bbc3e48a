"""Near-duplicate records with small edits: pigeonhole blocks over bit codes.

Two codes that differ in at most k of their bits agree on at least one of k + 1 disjoint groups of
bits. Codes are joined on (group, bits of the group) and the survivors verified by the exact Hamming
distance, so every pair within the bound is found and none beyond it (``operators.pigeonhole``).

Copies of a code collapse to one representative before the join. Groups are scattered over the code. A
bucket with more than ``HOT_BUCKET`` representatives is split by other partitions of the bits, again
and again while that thins it out: a pair in it must agree on one of those groups too, so a split loses
nothing. No bucket is skipped or capped.

Defined results: rows whose code is NULL, empty, of another width, not hex or all zero take no part;
an empty table gives empty results; extra columns are ignored; repeated rows are rows of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bits
from ..operators.pigeonhole import HOT_BUCKET, lane_table, near_lanes
from ..session import stored


def code_rows(df: DataFrame, id_col: str, code_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(row_id, code binary, kept columns) of the rows with a valid code."""
    return df.where(bits.is_code(F.col(code_col))).select(
        F.col(id_col).alias("row_id"), F.unhex(code_col).alias("code"), *keep
    )


def near_codes(codes: DataFrame, max_bits: int, id_col: str = "cid", code_col: str = "code", hot: int = HOT_BUCKET) -> DataFrame:
    """Pairs (a, b, dist), a < b, of distinct codes within ``max_bits``.

    ``codes`` has one row per distinct code: an id and the code as binary of 128 bytes.
    """
    wide = lane_table(codes.select(F.col(id_col).alias("cid"), F.col(code_col).alias("code")), "cid", "code")
    return near_lanes(stored(wide, "lanes"), max_bits, hot=hot)


def representatives(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(codes, members): distinct codes with cid = their smallest row_id, and the rows with their cid."""
    codes = rows.groupBy("code").agg(F.min("row_id").alias("cid"))
    return codes, rows.join(codes, "code").drop("code")


def near_rows(df: DataFrame, max_bits: int, id_col: str = "row_id", code_col: str = "fp_hex", file_cols: tuple[str, ...] = ("source", "relpath")) -> DataFrame:
    """Pairs (row_id_a, row_id_b) of rows of different files whose codes differ in at most ``max_bits`` bits.

    A file is the exact tuple of ``file_cols``; NULL equals NULL there.
    """
    parts = [*file_cols, *[F.col(c).isNull() for c in file_cols]]
    file_id = F.struct(F.xxhash64(*parts).alias("h"), F.xxhash64(F.lit(1), *parts).alias("g"))  # 128 bits name a file
    rows = code_rows(df, id_col, code_col, file_cols).select("row_id", "code", file_id.alias("fid"))
    codes = stored(rows.groupBy("code").agg(F.min("row_id").alias("cid"), F.count(F.lit(1)).alias("copies")), "codes")
    near = near_codes(codes, max_bits).select("a", "b")
    members = stored(rows.join(codes, "code").select("row_id", "cid", "fid", "copies"), "members")
    left = members.select(F.col("row_id").alias("ra"), F.col("cid").alias("a"), F.col("fid").alias("fa"))
    right = members.select(F.col("row_id").alias("rb"), F.col("cid").alias("b"), F.col("fid").alias("fb"))
    across = near.join(left, "a").join(right, "b").where("fa <> fb")
    copied = members.where("copies > 1")
    within = (
        copied.select(F.col("row_id").alias("ra"), "cid", F.col("fid").alias("fa"))
        .join(copied.select(F.col("row_id").alias("rb"), "cid", F.col("fid").alias("fb")), "cid")
        .where("ra < rb and fa <> fb")
    )
    return across.select("ra", "rb").union(within.select("ra", "rb")).select(
        F.least("ra", "rb").alias("row_id_a"), F.greatest("ra", "rb").alias("row_id_b")
    )


def near_groups(df: DataFrame, max_bits: int, id_col: str = "row_id", code_col: str = "fp_hex") -> DataFrame:
    """(row_id, group_id, n_links) of every row with a valid code.

    Rows are grouped when a chain of codes within ``max_bits`` joins them; group_id is the smallest
    row_id of the group and n_links the number of other codes within the bound. Unlike ``near_rows``
    this never writes a row per pair of copies.
    """
    from .boruvka import components

    rows = code_rows(df, id_col, code_col)
    codes, members = representatives(rows)
    codes = stored(codes, "codes")
    near = stored(near_codes(codes, max_bits).select("a", "b"), "near")
    groups = components(near, "a", "b").select(F.col("node").alias("cid"), F.col("component").alias("g"))
    links = near.select(F.col("a").alias("cid")).union(near.select(F.col("b").alias("cid"))).groupBy("cid").agg(F.count(F.lit(1)).alias("n_links"))
    per_code = codes.select("cid").join(groups, "cid", "left").join(links, "cid", "left")
    return members.join(per_code, "cid").select(
        "row_id", F.coalesce("g", "cid").alias("group_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links")
    )
