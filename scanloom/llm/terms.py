"""Frequency of every distinct term, and marks for the too rare and too common.

Equal texts are counted once with their number of rows and weight, and each task adds up what it has of
a term before anything is shuffled by term. Terms get dense ids from a global sorted dictionary. Encoded
occurrences are sorted by id inside each task and accumulate into count arrays of one block of ids at a
time, full ones where most of the block occurs and else arrays of the ids that do; the arrays are then
summed by identifier range. So what is shuffled are arrays over blocks of the vocabulary, not
occurrences, never larger than the counts in them, and a term in every row is no hot key.

Defined results: NULL text is no record; empty text is a record without terms; NULL weights count 0;
repeated rows all count; an empty table gives no terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import places
from ..session import stored

#: Ids per block of the count arrays, and the share of them that must occur for a full array.
BLOCK = 4096
FULL_SHARE = 0.75
TERM = r"[\p{L}\p{Nd}]+"
ARRAYS = "block bigint, at array<int>, rows array<bigint>, occ array<bigint>, weight array<bigint>"


def dictionary(terms: DataFrame) -> DataFrame:
    """(term, tid): dense ids 0.. in the order of the terms, without a single-task sort."""
    return places(terms.select("term").distinct(), [F.col("term")], "tid").withColumn("tid", F.col("tid") - 1)


class _Blocks:
    """Count arrays of one block at a time; rows and arrays must come in the order of their blocks."""

    def __init__(self) -> None:
        self.now, self.total = -1, np.zeros((3, BLOCK), np.int64)
        self.done: list[tuple] = []

    def open(self, block: int) -> None:
        if block != self.now:
            self.close()
            self.now = block

    def close(self) -> None:
        used = np.flatnonzero(self.total[1])
        if len(used):
            full = len(used) >= FULL_SHARE * BLOCK
            part = self.total.copy() if full else self.total[:, used]
            self.done.append((self.now, None if full else used.astype(np.int32), *part))
            self.total[:] = 0

    def taken(self) -> list[tuple]:
        out, self.done = self.done, []
        return out


def _accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (tid, rows, occ, weight) in the order of tid to arrays per block; ``at`` is NULL for full ones."""
    blocks = _Blocks()

    def out() -> pa.RecordBatch:
        done = blocks.taken()
        kinds = [pa.int64(), pa.list_(pa.int32()), *[pa.list_(pa.int64())] * 3]
        return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], k) for i, k in enumerate(kinds)], names=["block", "at", "rows", "occ", "weight"])

    for batch in batches:
        tid = batch.column("tid").to_numpy(zero_copy_only=False)
        values = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("rows", "occ", "weight")])
        edges = np.flatnonzero(np.diff(tid // BLOCK)) + 1
        for a, b in zip([0, *edges], [*edges, len(tid)]):
            if a < b:
                blocks.open(int(tid[a] // BLOCK))
                for k in range(3):
                    np.add.at(blocks.total[k], tid[a:b] % BLOCK, values[k, a:b])
        if blocks.done:
            yield out()
    blocks.close()
    if blocks.done:
        yield out()


def _sum_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums the arrays of equal blocks, which come in order, to rows (tid, rows, occ, weight); one block is held at a time."""
    blocks = _Blocks()

    def out() -> Iterator[pa.RecordBatch]:
        for block, at, *counts in blocks.taken():
            used = np.flatnonzero(counts[1]) if at is None else at
            kept = [c[used] for c in counts] if at is None else counts
            yield pa.RecordBatch.from_arrays([pa.array(block * BLOCK + used.astype(np.int64)), *map(pa.array, kept)], names=["tid", "rows", "occ", "weight"])

    for batch in batches:
        for i, b in enumerate(batch.column("block").to_pylist()):
            blocks.open(b)
            at = batch.column("at")[i]
            where = at.values.to_numpy() if at.is_valid else slice(None)
            for k, c in enumerate(("rows", "occ", "weight")):
                blocks.total[k][where] += batch.column(c)[i].values.to_numpy()
            yield from out()
    blocks.close()
    yield from out()


def term_counts(df: DataFrame, text_col: str, weight_col: str) -> DataFrame:
    """(term, n_rows, n_occurrences, weight) over all rows, terms being runs of letters and digits in lower case."""
    texts = (
        df.where(F.col(text_col).isNotNull())
        .groupBy(F.lower(F.col(text_col)).alias("text"))
        .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col(weight_col).cast("bigint")), F.lit(0)).alias("w"))
    )
    terms = F.array_sort(F.regexp_extract_all("text", F.lit(TERM), F.lit(0)))
    # equal terms lie together once sorted: where a term begins, and how far it goes, however long the text
    begins = F.filter(F.sequence(F.lit(0), F.size("terms") - 1), lambda i: (i == 0) | (F.get("terms", i) != F.get("terms", i - 1)))
    once = F.transform("begins", lambda i, j: F.struct(F.get("terms", i).alias("term"), (F.coalesce(F.get("begins", j + 1), F.size("terms")) - i).cast("bigint").alias("k")))
    found = (
        texts.select("n", "w", terms.alias("terms")).where(F.size("terms") > 0).select("n", "w", "terms", begins.alias("begins")).select("n", "w", F.explode(once).alias("x"))
        .groupBy(F.col("x.term").alias("term"), F.spark_partition_id().alias("part"))
        .agg(F.sum("n").alias("rows"), F.sum(F.col("n") * F.col("x.k")).alias("occ"), F.sum(F.col("w") * F.col("x.k")).alias("weight"))
    )
    found = stored(found, "terms")
    ids = dictionary(found)
    encoded = found.join(ids, "term").select("tid", "rows", "occ", "weight")
    arrays = encoded.sortWithinPartitions("tid").mapInArrow(_accumulate, ARRAYS)
    summed = arrays.repartitionByRange("block").sortWithinPartitions("block").mapInArrow(_sum_sorted, "tid bigint, rows bigint, occ bigint, weight bigint")
    return summed.join(ids, "tid").select("term", F.col("rows").alias("n_rows"), F.col("occ").alias("n_occurrences"), "weight")


def marked_terms(df: DataFrame, text_col: str, weight_col: str, min_rows: int = 3, min_weight: int = 20, common_share: float = 0.1) -> DataFrame:
    """(term, n_rows, n_occurrences, weight, mark) with mark ``rare``, ``common`` or NULL.

    ``common`` is measured against the rows with non-NULL text.
    """
    records = df.select(F.count(F.col(text_col))).first()[0]
    mark = F.when((F.col("n_rows") < min_rows) | (F.col("weight") < min_weight), "rare").when(F.col("n_rows") > records * common_share, "common")
    return term_counts(df, text_col, weight_col).withColumn("mark", mark)
