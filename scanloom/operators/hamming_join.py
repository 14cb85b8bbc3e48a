"""Near-duplicate codes of the perceptual duplicate report.

Without a bucket limit the pairs come from scattered pigeonhole blocks (see ``pigeonhole``), all of them.
With a limit they come from the report's own contiguous bands, whose buckets over the limit are left out
and reported, and the recall that costs. Identical codes collapse to one representative first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bits
from ..session import stored
from .pigeonhole import lane_table, near_lanes


def valid_codes(df: DataFrame, col: str = "fp_hex", digits: int = 256) -> DataFrame:
    """Rows with a code of full width, in lower case; empty codes drop out."""
    return df.where(F.col(col).rlike(f"^[0-9a-fA-F]{{{digits}}}$")).withColumn(col, F.lower(col))


def guard_width(df: DataFrame, col: str = "fp_hex", digits: int = 256) -> None:
    """An error when some code is hex of another width: such manifests must be made again."""
    other = df.where(F.col(col).rlike("^[0-9a-fA-F]+$") & (F.length(col) != digits))
    n = other.count()
    if n:
        raise ValueError(f"{n} codes are not {digits} hex digits wide")


def bands(df: DataFrame, code: str, n_bands: int, width: int = 128) -> DataFrame:
    """(columns.., band, segment): the byte bands of a hex code."""
    at = bits.band_bounds(n_bands, width)
    cut = F.array(*[F.struct(F.lit(i).alias("band"), F.substring(code, 2 * at[i] + 1, 2 * (at[i + 1] - at[i])).alias("segment")) for i in range(n_bands)])
    return df.withColumn("__b", F.explode(cut)).select(*df.columns, "__b.band", "__b.segment")


def candidate_pairs(codes: DataFrame, n_bands: int, max_bucket: int | None, width: int = 128) -> tuple[DataFrame, DataFrame]:
    """((a, b), skipped buckets) from codes (cid, code, n): pairs that share a band.

    A bucket counts all the copies behind its codes, as the limit is about frames.
    """
    keyed = stored(bands(codes, "code", n_bands, width).select("cid", "n", F.xxhash64("band", "segment").alias("key")), "bands")
    buckets = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("codes"), F.sum("n").alias("frames"))
    skipped = buckets.where(F.col("frames") > max_bucket) if max_bucket is not None else buckets.where("false")
    kept = buckets.where("codes > 1")
    kept = kept.where(F.col("frames") <= max_bucket) if max_bucket is not None else kept
    rows = keyed.join(kept.select("key"), "key")
    pairs = rows.select("key", F.col("cid").alias("a")).join(rows.select("key", F.col("cid").alias("b")), "key").where("a < b")
    return pairs.select("a", "b").distinct(), skipped


def near_codes(rows: DataFrame, id_col: str, code_col: str, max_bits: int, max_bucket: int | None = None, bits_wide: int = bits.CODE_BITS) -> DataFrame:
    """(a, b, dist) of distinct codes within ``max_bits``; a and b are the smallest row ids of the codes."""
    lanes = bits_wide // 64
    codes = rows.groupBy(F.col(code_col).alias("code")).agg(F.min(id_col).alias("cid"), F.count(F.lit(1)).alias("n"))
    if max_bucket is None:
        return near_lanes(stored(lane_table(codes.select("cid", F.unhex("code").alias("code")), "cid", "code", lanes), "lanes"), max_bits)
    codes = stored(codes, "codes")
    pairs, _ = candidate_pairs(codes, bits.band_count(max_bits), max_bucket, bits_wide // 8)
    wide = codes.select("cid", *bits.lanes(F.col("code"), lanes))
    a = wide.select(F.col("cid").alias("a"), *[F.col(f"l{i}").alias(f"a_l{i}") for i in range(lanes)])
    b = wide.select(F.col("cid").alias("b"), *[F.col(f"l{i}").alias(f"b_l{i}") for i in range(lanes)])
    return pairs.join(a, "a").join(b, "b").select("a", "b", bits.distance("a_", "b_", lanes).alias("dist")).where(F.col("dist") <= max_bits)


def skipped_buckets(rows: DataFrame, id_col: str, code_col: str, max_bits: int, max_bucket: int, bits_wide: int = bits.CODE_BITS) -> DataFrame:
    """(unit, status, detail): the buckets that ``near_codes`` with this limit leaves out, as outcomes."""
    codes = rows.groupBy(F.col(code_col).alias("code")).agg(F.min(id_col).alias("cid"), F.count(F.lit(1)).alias("n"))
    _, skipped = candidate_pairs(codes, bits.band_count(max_bits), max_bucket, bits_wide // 8)
    return skipped.select(F.hex("key").alias("unit"), F.lit("bucket_skipped").alias("status"), F.concat(F.col("frames").cast("string"), F.lit(" frames")).alias("detail"))


def near_bit_strings(df: DataFrame, id_col: str, bits_col: str, max_bits: int, width: int = 64) -> DataFrame:
    """(id_a, id_b, dist) of short bit strings within ``max_bits``, by bands cut at bit positions.

    For small tables: where ``max_bits`` is a large share of the width, bands are a few bits wide and nearly
    all rows meet.
    """
    n = max_bits + 1
    at = bits.band_bounds(n, width)
    cut = F.array(*[F.struct(F.lit(i).alias("band"), F.substring(bits_col, at[i] + 1, at[i + 1] - at[i]).alias("segment")) for i in range(n)])
    half = width // 2
    wide = df.select(id_col, F.conv(F.substring(bits_col, 1, half), 2, 10).cast("bigint").alias("h"), F.conv(F.substring(bits_col, half + 1, half), 2, 10).cast("bigint").alias("l"), F.explode(cut).alias("k"))
    wide = stored(wide.select(id_col, "h", "l", "k.band", "k.segment"), "bands")
    a = wide.select(F.col(id_col).alias("id_a"), F.col("h").alias("ha"), F.col("l").alias("la"), "band", "segment")
    b = wide.select(F.col(id_col).alias("id_b"), F.col("h").alias("hb"), F.col("l").alias("lb"), "band", "segment")
    dist = (F.bit_count(F.col("ha").bitwiseXOR(F.col("hb"))) + F.bit_count(F.col("la").bitwiseXOR(F.col("lb")))).cast("int")
    return a.join(b, ["band", "segment"]).where("id_a < id_b").withColumn("dist", dist).where(F.col("dist") <= max_bits).select("id_a", "id_b", "dist").distinct()
