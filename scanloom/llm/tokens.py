"""Sizes of texts in tokens of a public byte-level BPE tokenizer, loaded from a folder of vocabularies."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

TOKENIZERS = os.environ.get("SCANLOOM_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
# Fixed value: the published pattern that cuts text into pieces for this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def encoding(path: str):
    """The tokenizer of a rank file; made once per Python worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def counted(docs: DataFrame, keep: tuple[str, ...], text_col: str = "text", path: str = f"{TOKENIZERS}/{VOCABULARY}") -> DataFrame:
    """The columns ``keep`` and ``tokens``, the length of each whole text; NULL text has 0 tokens.

    Special tokens have no meaning in a text: their strings are ordinary text.
    """
    types = dict(docs.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in keep] + ["tokens bigint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(path).encode_ordinary
        for batch in batches:
            sizes = [len(encode(t)) if t else 0 for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(sizes, pa.int64())], names=[*keep, "tokens"])

    return docs.select(docs[text_col].alias("__text"), *keep).mapInArrow(run, schema)
