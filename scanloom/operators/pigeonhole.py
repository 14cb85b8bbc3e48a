"""Pairs of bit codes within a Hamming distance, by pigeonhole blocks.

Two codes that differ in at most k bits agree on at least one of k + 1 disjoint groups of bits. Codes
are joined on (group, bits of the group) and the survivors verified by the exact distance, so every pair
within the bound is found and none beyond it.

Groups are scattered over the code: contiguous bands would put the many codes that agree in a border or
background region into one bucket. A bucket with more than ``HOT_BUCKET`` codes is split again by the
groups of another partition of the bits, which a close pair must agree on too, and so on while a split
at least halves the pairs to verify. A bucket that no split thins out holds codes that really are alike,
and is joined as it is. No bucket is skipped or capped, and each split halves its pairs, so splitting ends.

The exploded keys are written before anything joins them: the planner does not see that an explode
multiplies rows, and would broadcast a side ten times the size it expects.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bits
from ..session import stored

#: Codes in a bucket beyond which it is split again. A setting of speed, not of results.
HOT_BUCKET = 24


def lane_table(codes: DataFrame, id_col: str, code_col: str, lanes: int = bits.LANES) -> DataFrame:
    """(id, l0, l1, ..): binary codes as signed 64-bit lanes, by numpy over Arrow batches; the JVM reads numbers from text only."""
    width = 8 * lanes
    kind = dict(codes.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = batch.column(1).cast(pa.binary(width))
            if not len(code):
                continue
            words = np.frombuffer(code.buffers()[1], np.uint8, offset=code.offset * width, count=len(code) * width).reshape(-1, width).view(">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(words[:, i]) for i in range(lanes)]], names=[id_col, *[f"l{i}" for i in range(lanes)]])

    schema = f"`{id_col}` {kind}, " + ", ".join(f"l{i} bigint" for i in range(lanes))
    return codes.select(id_col, code_col).mapInArrow(run, schema)


def _group_keys(df: DataFrame, id_col: str, masks: list[list[int]], within: Column | None = None) -> DataFrame:
    """(key, id, pre): a row per code and group of bits; ``pre`` is the bucket that is split, or NULL."""
    n = len(masks[0])
    names = [f"l{i}" for i in range(n)]
    pre = (within if within is not None else F.lit(None).cast("bigint")).alias("pre")
    wide = df.select(id_col, pre, *names, F.explode(bits.mask_literal(masks)).alias("m"))
    parts = [F.col("m.block")] + [F.col(c).bitwiseAND(F.col(f"m.m{i}")) for i, c in enumerate(names)]
    if within is not None:
        parts.insert(0, F.col("pre"))
    return wide.select(F.xxhash64(*parts).alias("key"), id_col, "pre")


def shared_keys(keys: DataFrame) -> DataFrame:
    """The rows of ``keys``, which must be a written table, whose key at least two rows have, with their number ``n``."""
    counted = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return keys.join(counted, "key")


def _pairs(n: str) -> Column:
    return F.col(n).cast("double") * (F.col(n) - 1) / 2


def _thinned(shared: DataFrame) -> DataFrame:
    """(pre): the buckets that their split thins out to at most half of the pairs; ``shared`` has (pre, was, key, n)."""
    keys = shared.groupBy("pre", "was", "key").agg(F.first("n").alias("n"))
    sums = keys.groupBy("pre", "was").agg(F.sum(_pairs("n")).alias("after"))
    return sums.where(F.col("after") * 2 <= _pairs("was")).select("pre")


def _lane_count(wide: DataFrame) -> int:
    return sum(c.startswith("l") and c[1:].isdigit() for c in wide.columns)


def split_rows(crowded: DataFrame, wide: DataFrame, id_col: str, blocks: int, hot: int = HOT_BUCKET) -> list[DataFrame]:
    """[(key, id)]: finer buckets for the crowded ones (key, id, n) that keep every pair within the bound together.

    ``crowded`` and ``wide`` are written tables; ``wide`` has the lanes of the ids.
    """
    lanes, ready, level = _lane_count(wide), [], 0
    while crowded.head(1):
        level += 1
        masks = bits.scattered_masks(blocks, blocks, lanes) if level == 1 else bits.mixed_masks(blocks, level, lanes)
        parent = crowded.select(id_col, F.col("key").alias("was_key"), F.col("n").alias("was"))
        keys = _group_keys(parent.join(wide, id_col), id_col, masks, F.col("was_key"))
        keys = stored(keys, "keys")
        shared = shared_keys(keys).join(crowded.groupBy(F.col("key").alias("pre")).agg(F.first("n").alias("was")), "pre")
        shared = stored(shared, "shared")
        # a bucket whose codes share no key of the split has no pair within the bound, and drops out
        thinned = stored(_thinned(shared), "thinned")
        dense = shared.select("pre").distinct().join(thinned, "pre", "left_anti").withColumnRenamed("pre", "key")
        ready.append(crowded.join(dense, "key", "left_semi").select("key", id_col))
        finer = stored(shared.join(thinned, "pre", "left_semi").select("key", id_col, "n"), "finer")
        ready.append(finer.where(F.col("n") <= hot).select("key", id_col))
        crowded = finer.where(F.col("n") > hot)
    return ready


def bucket_rows(wide: DataFrame, id_col: str, blocks: int, hot: int = HOT_BUCKET) -> DataFrame:
    """(key, id): codes that share a key are the ones to compare. ``wide`` has the id and lanes l0, l1, .. and is written."""
    keys = stored(_group_keys(wide, id_col, bits.scattered_masks(blocks, 1, _lane_count(wide))), "keys")
    shared = stored(shared_keys(keys).select("key", id_col, "n"), "shared")
    plain = shared.where(F.col("n") <= hot).select("key", id_col)
    return reduce(DataFrame.union, [plain, *split_rows(shared.where(F.col("n") > hot), wide, id_col, blocks, hot)])


def near_lanes(wide: DataFrame, max_bits: int, id_col: str = "cid", hot: int = HOT_BUCKET) -> DataFrame:
    """Pairs (a, b, dist), a < b, of codes within ``max_bits``; ``wide`` is a written table of an id and lanes."""
    lanes = _lane_count(wide)
    rows = bucket_rows(wide, id_col, bits.band_count(max_bits, 64 * lanes), hot)
    pairs = rows.select("key", F.col(id_col).alias("a")).join(rows.select("key", F.col(id_col).alias("b")), "key").where("a < b").select("a", "b").distinct()
    a = wide.select(F.col(id_col).alias("a"), *[F.col(f"l{i}").alias(f"a_l{i}") for i in range(lanes)])
    b = wide.select(F.col(id_col).alias("b"), *[F.col(f"l{i}").alias(f"b_l{i}") for i in range(lanes)])
    return pairs.join(a, "a").join(b, "b").select("a", "b", bits.distance("a_", "b_", lanes).alias("dist")).where(F.col("dist") <= max_bits)
