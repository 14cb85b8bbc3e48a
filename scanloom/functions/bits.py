"""Bit codes written as hex: lanes, block masks and Hamming distance, all as JVM expressions."""

from __future__ import annotations

import math
import random

from pyspark.sql import Column
from pyspark.sql import functions as F

CODE_BITS = 1024
LANES = CODE_BITS // 64


def allowed_bits(percent: float, code_bits: int = CODE_BITS) -> int:
    """Differing bits that a similarity of ``percent`` allows (99 percent of 1024 bits: 10)."""
    return max(0, math.floor(code_bits * (100 - percent) / 100))


def band_count(bits: int, most: int = 128) -> int:
    """Bands that guarantee one equal band for codes differing in at most ``bits`` bits."""
    return min(max(bits + 1, 1), most)


def band_bounds(bands: int, width: int) -> list[int]:
    """Start positions (and the end) of contiguous bands over ``width`` units."""
    return [round(k * width / bands) for k in range(bands + 1)]


def is_code(text: Column, code_bits: int = CODE_BITS) -> Column:
    """True where ``text`` is a full-width hex code with at least one bit set; NULL text is False."""
    digits = code_bits // 4
    return F.coalesce(text.rlike(f"^[0-9a-fA-F]{{{digits}}}$") & (text != "0" * digits), F.lit(False))


def lane(hex_text: Column, i: int) -> Column:
    """The i-th 64-bit lane of a hex code as a signed long."""
    return F.conv(F.substring(hex_text, 16 * i + 1, 16), 16, -10).cast("bigint")


def lanes(hex_text: Column, n: int = LANES) -> list[Column]:
    return [lane(hex_text, i).alias(f"l{i}") for i in range(n)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def scattered_masks(blocks: int, stride: int = 1, n: int = LANES) -> list[list[int]]:
    """Lane masks of ``blocks`` groups that partition the bits: bit p is in group (p // stride) % blocks.

    Scattered groups sample the whole image. Contiguous bands would put the many codes that agree in a
    border or background region into one bucket; scattered ones only meet when the codes are alike.
    """
    masks = [[0] * n for _ in range(blocks)]
    for p in range(64 * n):
        masks[(p // stride) % blocks][p // 64] |= 1 << (63 - p % 64)
    return [[signed(m) for m in row] for row in masks]


def mixed_masks(blocks: int, seed: int, n: int = LANES) -> list[list[int]]:
    """Lane masks of ``blocks`` groups of nearly equal size that partition the bits in a random order, the same for a seed."""
    masks = [[0] * n for _ in range(blocks)]
    for i, p in enumerate(random.Random(seed).sample(range(64 * n), 64 * n)):
        masks[i % blocks][p // 64] |= 1 << (63 - p % 64)
    return [[signed(m) for m in row] for row in masks]


def mask_literal(masks: list[list[int]]) -> Column:
    """array<struct<block, m0..>> to explode: one row per group."""
    return F.array(*[
        F.struct(F.lit(b).alias("block"), *[F.lit(m).cast("bigint").alias(f"m{i}") for i, m in enumerate(row)])
        for b, row in enumerate(masks)
    ])


def distance(a: str, b: str, n: int = LANES) -> Column:
    """Hamming distance of lanes ``{a}l0..`` and ``{b}l0..``."""
    total = F.bit_count(F.col(f"{a}l0").bitwiseXOR(F.col(f"{b}l0")))
    for i in range(1, n):
        total = total + F.bit_count(F.col(f"{a}l{i}").bitwiseXOR(F.col(f"{b}l{i}")))
    return total.cast("int")
