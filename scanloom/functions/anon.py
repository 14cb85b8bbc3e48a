"""Anonymous ids: random, or salted hashes that repeat."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LEAST, MOST = 1, 32


def check_length(n: int) -> int:
    if not LEAST <= n <= MOST:
        raise ValueError(f"id length {n} is not in {LEAST}..{MOST}")
    return n


def random_id(length: int) -> Column:
    """Random lower-case hex. Not repeatable: cut the plan after use."""
    return F.substring(F.replace(F.uuid(), F.lit("-"), F.lit("")), 1, check_length(length))


def hashed_id(value: Column, salt: str, length: int, attempt: Column | None = None) -> Column:
    """Prefix of a salted SHA-256; later attempts hash another input."""
    again = F.lit("") if attempt is None else F.when(attempt > 0, F.concat(F.lit("#"), attempt.cast("string"))).otherwise("")
    return F.substring(F.sha2(F.concat(F.lit(salt), value.cast("string"), again), 256), 1, check_length(length))
