"""Checksums over ordered parts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def series_digest(df: DataFrame, keys: list[str], order: list[str], payload: Column) -> DataFrame:
    """(keys, n_parts, digest): SHA-256 over the ordered SHA-256 digests of the parts.

    Parts are hashed where they are; only 64 digits and the order travel, so a long series costs a
    shuffle of digests, not of pixels, and they are hashed as they pass. NULL parts hash as empty.
    """
    digits = F.sha2(F.coalesce(payload.cast("binary"), F.lit(b"")), 256)
    return _streamed(df.select(*dict.fromkeys([*keys, *order]), digits.alias("__d")), keys, order, "__d")


def stream_digest(df: DataFrame, keys: list[str], order: list[str], payload: str) -> DataFrame:
    """(keys, digest): SHA-256 over the concatenated raw bytes in order; the form other tools compute.

    The digest of a key is sequential by its definition: one task reads all of a key's bytes.
    """
    return _streamed(df, keys, order, payload).drop("n_parts")


def _streamed(df: DataFrame, keys: list[str], order: list[str], payload: str) -> DataFrame:
    """(keys, n_parts, digest): rows are sorted within partitions and hashed as they pass, so no series is held in memory."""
    types = dict(df.dtypes)
    schema = ", ".join(f"{k} {types[k]}" for k in keys) + ", n_parts bigint, digest string"
    sorted_ = df.select(*keys, *[c for c in order if c not in keys], payload).repartition(*keys).sortWithinPartitions(*keys, *order)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, digest, n = None, None, 0
        for batch in batches:
            out = []
            for row in batch[[*keys, payload]].itertuples(index=False, name=None):
                key, data = row[:-1], row[-1]
                if key != now:
                    if now is not None:
                        out.append((*now, n, digest.hexdigest()))
                    now, digest, n = key, hashlib.sha256(), 0
                n += 1
                if data is not None:
                    digest.update(data.encode() if isinstance(data, str) else bytes(data))
            if out:
                yield pd.DataFrame(out, columns=[*keys, "n_parts", "digest"])
        if now is not None:
            yield pd.DataFrame([(*now, n, digest.hexdigest())], columns=[*keys, "n_parts", "digest"])

    return sorted_.mapInPandas(run, schema)
