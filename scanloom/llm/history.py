"""Deduplicating new batches against all history: a pivot-distance table.

Each accepted code is stored once with its distances to fixed pivots, taken over disjoint segments of
the bits and over the whole code. Codes within k bits are, by the pigeonhole principle, equal on one of
k + 1 segments; there, by the triangle inequality, their distances to every pivot are equal too, and
over the whole code their distances to a pivot differ by at most k. So whole-code distances to the first
pivot are cut into bands 2k + 1 wide, and a probe at distance d looks only into the at most two bands
that reach into [d - k, d + k], there only at the rows with its own distances on one of the segments: a
range join, by bands, whose exact range test follows. What remains is verified by the true distance, and
the accepted codes of a batch are appended.

The table of distances is narrow and laid out for that join: bucketed by (segment distances, band), so a
batch never shuffles the history, and sorted by whole-code distance, so row groups out of the batch's
range are not read. Codes are kept apart, bucketed by id, and joined for candidates only. A folder per
batch makes appending idempotent.

Crowded cells of the table are split by other partitions of the bits while that thins them out, as in
``operators.pigeonhole``; none is skipped.

Defined results: rows with an invalid code (NULL, empty, another width, not hex, all zero) or a NULL
batch are never a case and never accepted. Rows of one batch are not compared with each other.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import bits
from ..functions.ids import canonical_id
from ..operators.pigeonhole import HOT_BUCKET, lane_table, split_rows
from ..session import cut, remove, scratch_path, stored
from .hamming_groups import code_rows

#: Pivots per table. Eight 7-bit distances and the segment fill one long.
PIVOTS = 8
PIVOT_SEED = 20240229
WIDTH = bits.CODE_BITS // 8


def pivot_codes(n: int = PIVOTS, seed: int = PIVOT_SEED) -> np.ndarray:
    """The fixed pivots as (n, lanes) unsigned 64-bit words."""
    return np.random.default_rng(seed).integers(0, 1 << 64, size=(n, bits.LANES), dtype=np.uint64)


def segment_masks(segments: int) -> np.ndarray:
    return np.array(bits.scattered_masks(segments), dtype=np.int64).view(np.uint64)


def pivot_keys(words: np.ndarray, pivots: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per code the packed (segment, distances to the pivots) keys, and the whole-code distance to pivot 0."""
    keys = np.empty((len(words), len(masks)), np.int64)
    whole = np.zeros(len(words), np.int64)
    for s, mask in enumerate(masks):
        key = np.full(len(words), s, np.int64)
        for p, pivot in enumerate(pivots):
            d = np.bitwise_count((words ^ pivot) & mask).sum(axis=1, dtype=np.int64)
            if p == 0:
                whole += d
            key = (key << 7) | np.minimum(d, 127)
        keys[:, s] = key
    return keys, whole


def _words(codes: pa.Array) -> np.ndarray:
    """Binary codes as rows of unsigned 64-bit words."""
    code = codes.cast(pa.binary(WIDTH))
    words = np.frombuffer(code.buffers()[1], np.uint8, offset=code.offset * WIDTH, count=len(code) * WIDTH)
    return words.reshape(-1, WIDTH).view(">u8").astype(np.uint64)


def pivot_table(codes: DataFrame, max_bits: int) -> DataFrame:
    """(key, cid, d0): one row per code (cid, code) and segment.

    The distances are numpy kernels over Arrow batches: unrolled as expressions they would exceed what
    the JVM compiles.
    """
    pivots, masks = pivot_codes(), segment_masks(bits.band_count(max_bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, whole = pivot_keys(_words(batch.column("code")), pivots, masks)
            rep = np.repeat(np.arange(len(keys)), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), batch.column("cid").take(pa.array(rep)), pa.array(whole[rep].astype(np.int32))], names=["key", "cid", "d0"])

    return codes.select("cid", "code").mapInArrow(run, "key bigint, cid bigint, d0 int")


def _cell(band: Column) -> Column:
    return F.xxhash64("key", band.cast("int"))


def _verified(pairs: DataFrame, left: DataFrame, right: DataFrame, max_bits: int) -> DataFrame:
    """Pairs (a, b) whose true distance is within the bound."""
    a = left.select(F.col("cid").alias("a"), F.col("code").alias("ca"))
    b = right.select(F.col("cid").alias("b"), F.col("code").alias("cb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = np.bitwise_count(_words(batch.column(2)) ^ _words(batch.column(3))).sum(axis=1) <= max_bits
                yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(near)) for i in range(2)], names=["a", "b"])

    return pairs.join(a, "a").join(b, "b").select("a", "b", "ca", "cb").mapInArrow(run, "a bigint, b bigint")


def _within(young: DataFrame, old: DataFrame, max_bits: int, key: str) -> DataFrame:
    """(a, b): rows of one key whose whole-code distances to the first pivot are within the bound of each other."""
    a = young.select(key, F.col("cid").alias("a"), F.col("d0").alias("da"))
    b = old.select(key, F.col("cid").alias("b"), F.col("d0").alias("db"))
    return a.join(b, key).where(F.abs(F.col("da") - F.col("db")) <= max_bits).select("a", "b")


class History:
    """The accepted codes under ``path``: bucketed Parquet tables of pivot distances and of codes, a folder per batch.

    A batch sees the batches before it only and writes its own folders anew, so one that runs again after a
    failure gives the same result and leaves nothing twice. The number of buckets is fixed when the history
    begins and should suit what it will grow to; by default it is the session's shuffle partitions, but at
    most four per core. ``close`` forgets the tables, not their files.
    """

    TABLES = {"pivots": ("cell BIGINT, cid BIGINT, d0 INT", "cell", "d0"), "codes": ("cid BIGINT, code BINARY", "cid", "cid")}

    def __init__(self, spark: SparkSession, path: str, max_bits: int = 10, buckets: int | None = None, hot: int = HOT_BUCKET):
        self.spark, self.path, self.max_bits, self.hot = spark, path.rstrip("/"), max_bits, hot
        self.width = 2 * max_bits + 1
        begun = self._known_buckets()
        self.buckets = begun or buckets or min(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
        self.names = {t: f"history_{t}_{hashlib.md5(self.path.encode()).hexdigest()}" for t in self.TABLES}
        for t, (columns, by, order) in self.TABLES.items():
            spark.sql(f"DROP TABLE IF EXISTS {self.names[t]}")
            spark.sql(
                f"CREATE TABLE {self.names[t]} ({columns}, first_batch BIGINT) USING PARQUET PARTITIONED BY (first_batch)"
                f" CLUSTERED BY ({by}) SORTED BY ({order}) INTO {self.buckets} BUCKETS LOCATION '{self._folder(t)}'"
            )
            if begun:
                spark.sql(f"MSCK REPAIR TABLE {self.names[t]}")

    def _folder(self, name: str) -> str:
        return f"{self.path}/{name}-{self.buckets}"

    def _known_buckets(self) -> int | None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
        return next((int(n.split("-")[1]) for n in names if n.startswith("pivots-")), None)

    def _before(self, name: str, batch_no: int) -> DataFrame:
        return self.spark.table(self.names[name]).where(F.col("first_batch") < batch_no)

    def _of_before(self, name: str, past: DataFrame, keys: DataFrame) -> DataFrame:
        """The rows of ``past``, a part of the table ``name``, whose key is among ``keys``, found where they lie.

        The keys go to as many partitions as there are buckets: of two sides laid out by the key the planner
        shuffles the one with fewer partitions, and that is the history where shuffles have more than its buckets.
        """
        by = self.TABLES[name][1]
        return past.join(keys.select(by).repartition(self.buckets, by).distinct(), by, "left_semi")

    def _has_before(self, batch_no: int) -> bool:
        parts = self.spark.sql(f"SHOW PARTITIONS {self.names['codes']}").collect()  # one row per batch
        return any(int(p[0].split("=")[1]) < batch_no for p in parts)

    def _write(self, name: str, rows: DataFrame, batch_no: int) -> None:
        by = self.TABLES[name][1]
        view = f"appended_{uuid.uuid4().hex}"
        rows.repartition(self.buckets, by).createOrReplaceTempView(view)
        columns = ", ".join(c.split()[0] for c in self.TABLES[name][0].split(", "))
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.names[name]} PARTITION (first_batch = {int(batch_no)}) SELECT {columns} FROM {view}")
        self.spark.catalog.dropTempView(view)

    def close(self) -> None:
        for name in self.names.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def candidates(self, codes: DataFrame, probes: DataFrame, batch_no: int, reach: tuple[int, int]) -> DataFrame:
        """Pairs (a, b) of a batch's code and a code of the history that no pivot tells apart; ``reach`` bounds the probes' d0."""
        k = self.max_bits
        past = self._before("pivots", batch_no).where(F.col("d0").between(reach[0] - k, reach[1] + k))
        bands = F.array_distinct(F.array(F.floor((F.col("d0") - k) / self.width), F.floor((F.col("d0") + k) / self.width)))
        asked = probes.select("key", "cid", "d0", F.explode(bands).alias("band")).select(_cell(F.col("band")).alias("cell"), "cid", "d0")
        met = stored(self._of_before("pivots", past, asked).select("cell", "cid", "d0"), "met")
        crowded = met.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > self.hot)
        young, old, more = asked, met, None
        if crowded.head(1):
            crowded = stored(crowded, "crowded")
            more = self._split(codes, asked, met, crowded, batch_no)
            old = met.join(crowded, "cell", "left_anti")
        pairs = _within(young, old, k, "cell")
        return (pairs if more is None else pairs.union(more)).distinct()

    def _split(self, codes: DataFrame, asked: DataFrame, met: DataFrame, crowded: DataFrame, batch_no: int) -> DataFrame:
        """The pairs of crowded cells, by the finer buckets they are split into."""
        rows = met.withColumn("old", F.lit(True)).union(asked.withColumn("old", F.lit(False)))
        rows = stored(rows.join(crowded, "cell").select(F.col("cell").alias("key"), "cid", "d0", "old", "n"), "rows")
        ids = rows.select("cid", "d0", "old").distinct()
        kept = self._of_before("codes", self._before("codes", batch_no), ids).select("cid", "code")
        wide = stored(lane_table(codes.join(ids, "cid", "left_semi").select("cid", "code").union(kept), "cid", "code"), "lanes")
        parts = [finer.join(ids, "cid") for finer in split_rows(rows.select("key", "cid", "n"), wide, "cid", bits.band_count(self.max_bits), self.hot)]
        both = reduce(DataFrame.union, [x.select("key", "cid", "d0", "old") for x in parts])
        return _within(both.where("not old"), both.where("old"), self.max_bits, "key")

    def check(self, batch: DataFrame, batch_no: int, id_col: str = "row_id", code_col: str = "fp_hex") -> DataFrame:
        """(row_id, is_case) of the batch's valid rows; the rows that are no case become part of the history."""
        return self.check_codes(code_rows(batch, id_col, code_col), batch_no)

    def check_codes(self, rows: DataFrame, batch_no: int) -> DataFrame:
        """``check`` of rows (row_id, code) of a table."""
        codes = stored(rows.groupBy("code").agg(F.min("row_id").alias("cid")).select("cid", "code"), "batch")
        seen = Observation()
        probes = stored(pivot_table(codes, self.max_bits).observe(seen, F.min("d0").alias("low"), F.max("d0").alias("high")), "probes")
        low, high = seen.get["low"], seen.get["high"]
        if low is None or not self._has_before(batch_no):
            near = codes.select("cid").limit(0)
        else:
            pairs = self.candidates(codes, probes, batch_no, (low, high))
            near = cut(_verified(pairs, codes, self._before("codes", batch_no), self.max_bits).select(F.col("a").alias("cid")).distinct())
        self._write("codes", codes.join(near, "cid", "left_anti"), batch_no)
        own = probes.join(near, "cid", "left_anti").select(_cell(F.floor(F.col("d0") / self.width)).alias("cell"), "cid", "d0")
        self._write("pivots", own, batch_no)
        hit = codes.join(near, "cid", "left_semi").select("code", F.lit(True).alias("hit"))
        out = cut(rows.join(hit, "code", "left").select("row_id", F.coalesce("hit", F.lit(False)).alias("is_case")))
        for done in (codes, probes, near):  # the history and the answer are written; else they pile up batch by batch
            remove(done)
        return out


def batch_cases(df: DataFrame, batch_col: str, max_bits: int, id_col: str = "row_id", code_col: str = "fp_hex", hot: int = HOT_BUCKET) -> DataFrame:
    """(row_id) of the rows that repeat a row accepted from an earlier batch.

    The rows are written once, a folder per batch, and the batches go through a ``History`` of their own,
    oldest first; each reads its own folder and the tables of the history.
    """
    spark = df.sparkSession
    rows = code_rows(df.where(F.col(batch_col).isNotNull()), id_col, code_col, (batch_col,))
    rows = stored(rows.select("row_id", "code", F.col(batch_col).cast("bigint").alias("batch")), "batches", ("batch",))
    batches = sorted(r["batch"] for r in rows.select("batch").distinct().collect())  # one number per batch
    kept = History(spark, scratch_path(spark, "history"), max_bits, hot=hot)
    found = [kept.check_codes(rows.where(F.col("batch") == b).select("row_id", "code"), b).where("is_case").select("row_id") for b in batches]
    kept.close()
    return reduce(DataFrame.union, found) if found else rows.select("row_id")


def repeated_ids(df: DataFrame, batch_col: str, id_col: str, value_col: str) -> DataFrame:
    """(row_id) of rows whose id, spelling apart, an earlier batch has. NULL ids and batches are no case."""
    ids = df.select(F.col(id_col).alias("row_id"), canonical_id(F.col(value_col)).alias("v"), F.col(batch_col).alias("batch")).where("v is not null and batch is not null")
    first = ids.groupBy("v").agg(F.min("batch").alias("first"))
    return ids.join(first, "v").where("batch > first").select("row_id")
