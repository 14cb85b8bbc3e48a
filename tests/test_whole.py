"""The core does the whole job: no row is left out for the size of the input."""

import os
import random
import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from scanloom.operators import ordering
from scanloom.plans import dedup, tables
from tests.compare import same_rows

DATA = "/root/testdata"


def _key(name):
    return [(0, int(r), "") if r.isdigit() else (1, 0, r) for r in re.findall(r"[0-9]+|[^0-9]+", name)]


def test_place_of_every_name(spark, tmp_path):
    names = [f"view {i}" for i in range(200)] + ["", " 7", "7", "07", "a" + "9" * 25, "a1" + "0" * 25, "a" + "0" * 30 + "8", "b" + "1" * 40 + "x"]
    shuffled = random.Random(3).sample(names * 2, 2 * len(names))
    pq.write_table(pa.table({"series_description": [*shuffled, None]}), f"{tmp_path}/metadata_catalog.parquet")
    got = {r.series_description: r.place for r in tables.QUERIES["natural_places"](spark, str(tmp_path)).collect()}
    assert got == {n: i + 1 for i, n in enumerate(sorted(names, key=lambda n: (_key(n), n)))}
    same_rows(tables.QUERIES["natural_places"](spark, str(tmp_path)), tables.SQL["natural_places"], str(tmp_path))


def test_places_over_partitions(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(5000).withColumn("x", F.pmod(F.xxhash64("id"), F.lit(10**9)))
        placed = ordering.places(df, [F.col("x"), F.col("id")])
        assert placed.rdd.getNumPartitions() > 1
        got = {r.id: r.place for r in placed.collect()}
        assert got == {r.id: i + 1 for i, r in enumerate(sorted(df.collect(), key=lambda r: (r.x, r.id)))}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.skipif(not os.path.isdir(f"{DATA}/sf0.1"), reason="no test data")
def test_places_of_the_catalog(spark):
    found = tables.QUERIES["natural_places"](spark, f"{DATA}/sf0.1")
    names = set(pq.read_table(f"{DATA}/sf0.1/metadata_catalog.parquet", columns=["series_description"]).column(0).to_pylist()) - {None}
    assert found.count() == len(names) > 100
    same_rows(found, tables.SQL["natural_places"], f"{DATA}/sf0.1")


def test_pairs_of_more_than_10000_sources(spark):
    n, rng = 10_050, random.Random(11)
    columns = "source string, relpath string, mrn string, accession string, series string, frame_pos string, n_frames int, fp_hex string"
    series = ("m", "a", "x", "first", 1)
    codes = [f"{rng.getrandbits(1024):0256x}" for _ in range(n + 1)]
    manifest = spark.createDataFrame([(f"s{i}", f"f{i}", *series, codes[i]) for i in range(n)], columns)
    reference = spark.createDataFrame([("old", f"r{i}", *series, codes[i]) for i in range(n + 1)] + [("older", "q", *series, codes[n])], columns)
    duplicates, _ = dedup.report(manifest, reference, min_series=1)
    got = {(r.source_a, r.file_a, r.source_b, r.file_b) for r in duplicates.collect()}
    assert got == {("old", f"r{i}", f"s{i}", f"f{i}") for i in range(n)}


def test_repeats_of_every_batch(spark, tmp_path):
    ids = [("A1", 0), ("B1", 1), ("A1", 1), ("B1", 2), ("C1", 4), ("C1", 4), ("C1", 11), (None, 5), (None, 6), ("A1", None), ("D1", 3), ("A1", 3)]
    pq.write_table(pa.table({"row_id": list(range(len(ids))), "batch_no": [b for _, b in ids], "anon_accession": [x for x, _ in ids]}), f"{tmp_path}/copy_crosswalk.parquet")
    found = tables.QUERIES["scan_repeats"](spark, str(tmp_path))
    assert sorted(r.row_id for r in found.collect()) == [2, 3, 6, 11]
    same_rows(found, tables.SQL["scan_repeats"], str(tmp_path))


def test_sized_frames_equal_brute_force(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(64)], i % 3) for i in range(30)]
    kinds = pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("label", pa.int32())])
    pq.write_table(pa.table({c: [r[k] for r in rows] for k, c in enumerate(kinds.names)}, kinds), f"{tmp_path}/embeddings.parquet")
    stored = pq.read_table(f"{tmp_path}/embeddings.parquet").column("embedding").to_pylist()

    def at(line, k):  # bilinear between the centres of 8 samples at place k of 12
        x = (k + 0.5) * 8 / 12
        near = [(max(0.0, 1 - abs(j + 0.5 - x)), v) for j, v in enumerate(line)]
        return sum(w * v for w, v in near) / sum(w for w, _ in near)

    def fitted(plane):
        wide = [[at(plane[r * 8 : r * 8 + 8], k) for k in range(12)] for r in range(8)]
        tall = [[at([row[c] for row in wide], k) for c in range(12)] for k in range(12)]
        return [tall[r][c] for r in range(2, 11) for c in range(2, 11)]  # 9 of 12; the odd pixel goes off the first side

    want = {}
    for label in range(3):
        planes = [fitted([int((x + 2) * 1000) for x in stored[i]]) for i, _, k in rows if k == label]
        low, high = min(map(min, planes)), max(map(max, planes))
        want |= {(f"view_{label}", n): [(x - low) / (high - low) * 255 for x in p] for n, p in enumerate(planes)}
    got = {(r.series, r.frame_idx): r for r in tables.QUERIES["preprocess_sized"](spark, str(tmp_path)).collect()}
    assert got.keys() == want.keys() and {(r.h, r.w) for r in got.values()} == {(9, 9)}
    for key, r in got.items():
        assert all(x <= v + 0.01 and v <= x + 1.01 for x, v in zip(bytes.fromhex(r.pixels), want[key]))
