"""Pigeonhole blocks against all pairs, with buckets that splits thin out and buckets that none does."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from scanloom.functions import bits
from scanloom.operators import hamming_join, pigeonhole
from scanloom.session import stored


def codes(seed=5):
    """Unrelated codes, codes alike in most bits (close and not), and a dense cluster of codes all close to each other."""
    rng = random.Random(seed)
    flip = lambda c, k: c ^ sum(1 << p for p in rng.sample(range(1024), k))
    shared, dense = rng.getrandbits(1024), rng.getrandbits(1024)
    out = [rng.getrandbits(1024) for _ in range(40)]
    out += [flip(shared, k) for k in (3, 4, 6, 7, 14, 25, 60, 90) for _ in range(8)]
    out += [flip(dense, k % 5 + 1) for k in range(40)]
    return sorted({*out, 0})


@pytest.mark.parametrize("hot", [1, 5, 1000])
def test_all_pairs(spark, hot):
    known = codes()
    df = spark.createDataFrame([(i, f"{c:0256x}") for i, c in enumerate(known)], "cid bigint, h string")
    wide = stored(df.select("cid", *bits.lanes(F.col("h"))), "lanes")
    want = {(a, b): d for (a, x), (b, y) in itertools.combinations(enumerate(known), 2) if (d := (x ^ y).bit_count()) <= 10}
    got = pigeonhole.near_lanes(wide, 10, hot=hot).collect()
    assert len(got) == len(want) and {(r.a, r.b): r.dist for r in got} == want and len(want) > 700


def test_a_split_thins_unrelated_codes(spark):
    """Codes that agree in one group of bits only share no bucket after the split."""
    rng = random.Random(9)
    mask = sum(1 << (1023 - p) for p in range(1024) if p % 11 == 0)
    same = rng.getrandbits(1024) & mask
    df = spark.createDataFrame([(i, f"{rng.getrandbits(1024) & ~mask | same:0256x}") for i in range(200)], "cid bigint, h string")
    wide = stored(df.select("cid", *bits.lanes(F.col("h"))), "lanes")
    assert pigeonhole.bucket_rows(wide, "cid", 11, hot=5).count() == 0
    assert pigeonhole.bucket_rows(wide, "cid", 11, hot=500).count() == 200


@pytest.mark.parametrize("seed", [1, 2])
def test_mixed_masks_partition_the_bits(seed):
    masks = bits.mixed_masks(11, seed)
    sizes = [sum((m & (1 << 64) - 1).bit_count() for m in row) for row in masks]
    assert sum(sizes) == 1024 and min(sizes) == 93
    for lane in range(bits.LANES):
        assert sum(row[lane] & (1 << 64) - 1 for row in masks) == (1 << 64) - 1


def test_skipped_buckets_are_reported(spark):
    df = spark.createDataFrame([(i, f"{c:0256x}") for i, c in enumerate(codes())], "row_id bigint, fp_hex string")
    got = hamming_join.skipped_buckets(df, "row_id", "fp_hex", 10, 5).collect()
    assert got and {r.status for r in got} == {"bucket_skipped"}
